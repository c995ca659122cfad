"""Words of Arrow text columns as numpy arrays: where they lie, and 64-bit hashes of them."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that one numpy step works on; a longer text is a step of its own. Steps take some 50 to 100 times
#: that memory in every Python worker, and workers keep it.
PIECE = 1 << 19

#: The low 0 to 8 bytes of a word of memory.
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_HALF = np.uint64(32)


def pieces(texts: pa.Array, size: int = PIECE) -> Iterator[pa.Array]:
    """Slices of a column with about ``size`` bytes each, one row at least; null texts as empty ones."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) if len(texts) else []
    row = 0
    while row < len(texts):
        before = ends[row - 1] if row else 0
        stop = max(int(np.searchsorted(ends, before + size, "right")), row + 1)
        yield texts.slice(row, stop - row)
        row = stop


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large_string column without nulls, and its offsets into them (one more than rows)."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def windows_of_8(data: np.ndarray) -> np.ndarray:
    """The little-endian number in the 8 bytes from each position on; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits of 64-bit numbers."""
    values = (values ^ (values >> _HALF)) * _ODD
    return (values ^ (values >> _HALF)) * _ODD


def hash_spans(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hashes of byte spans: equal spans have equal ones."""
    eight = windows_of_8(data)
    hashes = mix(length.astype(np.uint64) + np.uint64(seed + 1))
    hashes = mix(hashes ^ (eight[start] & LOW_BYTES[np.minimum(length, 8)]))
    rest, at = np.flatnonzero(length > 8), 8
    while rest.size and at < 64:
        lane = eight[start[rest] + at] & LOW_BYTES[np.minimum(length[rest] - at, 8)]
        hashes[rest] = mix(hashes[rest] ^ lane)
        at += 8
        rest = rest[length[rest] > at]
    if rest.size:
        whole = data.tobytes()
        hashes[rest] = [xxhash.xxh64_intdigest(whole[s : s + n], seed) for s, n in zip(start[rest], length[rest])]
    return hashes


@dataclass
class Words:
    """``first[i]`` to ``first[i + 1]`` are the words of row i."""

    data: np.ndarray
    start: np.ndarray
    length: np.ndarray
    first: np.ndarray

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, seed: int = 0) -> np.ndarray:
        return hash_spans(self.data, self.start, self.length, seed)


def split(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> Words:
    """Runs of bytes outside ``gap`` (a flag for each byte value), never across rows."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64))
    solid = ~gap[data]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    opens[edge] = solid[edge]
    closes = solid.copy()
    closes[:-1] &= ~solid[1:]
    closes[edge - 1] = solid[edge - 1]
    start = np.flatnonzero(opens)
    return Words(data, start, np.flatnonzero(closes) + 1 - start, np.searchsorted(start, offsets))


def words(texts: pa.Array) -> Words:
    """White-space separated words of a large_string column without nulls."""
    return split(*raw(texts), ASCII_SPACE)


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of ``values[first[i] : first[i + 1]]`` for each i, zero where that is empty."""
    out = np.zeros((len(first) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(np.diff(first))
    if full.size:
        out[full] = np.add.reduceat(values, first[full], axis=0)
    return out
