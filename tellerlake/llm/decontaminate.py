"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a benchmark question keeps its template when its
parameters are changed. Windows of ``WINDOW`` template tokens of documents are hash-joined with those of
the benchmark items. A document leaks an item if windows at about one alignment hold ``COVERAGE`` of the
item's tokens, and the slots are consistent: equal values of the item stand against equal values of the
text. Alignments count as one where they are equal, or, for words added or left out, in one of two bands of
``BAND`` shifts that overlap by half.

Windows of placeholders only would meet in every table of numbers: they are hashed by their values, and only
items that have no others look for them. Items of ``SHORTEST`` to ``WINDOW`` - 1 tokens are sought as whole
sentences, with their own values.

Before the join, documents drop windows that can't match by a table of ``FILTER_BITS`` flags, whose size
does not depend on the benchmark: a benchmark too large for it lets more through, and the join decides.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.llm.tables import flagged, flags, store, table
from tellerlake.llm.words import hash_spans, mix, pieces, raw

WINDOW = 5
COVERAGE = 0.8
BAND = 16
SHORTEST = 3
FILTER_BITS = 22

#: Words that are units when a number stands before them.
UNITS = (
    "mm cm dm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram kilograms"
    " ton tons tonne tonnes lb lbs pound pounds oz ounce ounces ml cl l liter liters litre litres gallon"
    " gallons pint pints cup cups s sec second seconds min minute minutes h hr hour hours day days week weeks"
    " month months year years percent degree degrees dollar dollars euro euros cent cents usd eur gbp meter"
    " meters metre metres kilometer kilometers kilometre kilometres mph kmh watt watts volt volts kb mb gb tb"
).split()

_LETTER, _DIGIT = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_KIND[48:58] = _DIGIT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STOP = np.zeros(256, bool)
_STOP[list(b".!?\n\r:")] = True
_NUMBER, _NAME, _UNIT = (np.uint64(k) for k in (101, 102, 103))


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    length = np.array([len(w.encode()) for w in words])
    return hash_spans(data, np.cumsum(length) - length, length)


_UNIT_HASHES = _hash_words(UNITS)


def templates(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a piece: its template tokens, the value in each slot (zero for others), where sentences begin, rows' bounds.

    Tokens are runs of letters or of digits, the latter with points and commas inside. A name is a
    capitalised word that does not begin a sentence; names in a row are one slot, as are a number's
    digits. Words in capitals are read in lower case.
    """
    data, offsets = raw(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(len(offsets), np.int64)
    kind = _KIND[data]
    point = np.flatnonzero((data[1:-1] == 46) | (data[1:-1] == 44)) + 1
    point = point[(kind[point - 1] == _DIGIT) & (kind[point + 1] == _DIGIT)]
    kind[point] = _DIGIT
    opens = np.ones(len(data), bool)
    opens[1:] = kind[1:] != kind[:-1]
    opens[offsets[(offsets > 0) & (offsets < len(data))]] = True
    start = np.flatnonzero(opens)
    length = np.diff(np.append(start, len(data)))
    full = kind[start] > 0
    start, length = start[full], length[full]
    lower = _LOWER[data]
    accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    lower[accented] += 0x20  # capitals of Latin-1
    changed = lower != data
    first = np.searchsorted(start, offsets)
    row_start = np.zeros(len(start) + 1, bool)
    row_start[first] = True
    row_start = row_start[:-1]

    hashes = hash_spans(lower, start, length)
    number = kind[start] == _DIGIT
    stops = np.concatenate([[0], np.cumsum(_STOP[data])])
    gap = np.zeros(len(start), bool)
    gap[1:] = stops[start[1:]] > stops[start[:-1] + length[:-1]]
    gap |= row_start
    capital = changed[start] | ((data[start] == 0xC3) & changed[np.minimum(start + 1, len(data) - 1)])
    capitals = np.concatenate([[0], np.cumsum(changed)])
    shouted = capitals[start + length] - capitals[start] > 1
    name = capital & ~shouted & ~gap & ~number
    unit = np.zeros(len(start), bool)
    after = np.flatnonzero(number[:-1] & ~row_start[1:]) + 1
    unit[after] = np.isin(hashes[after], _UNIT_HASHES)

    tokens = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, mix(hashes))))
    slots = np.where(number | unit | name, hashes | np.uint64(1), np.uint64(0))
    joined = np.zeros(len(start), bool)
    joined[1:] = name[1:] & name[:-1] & ~row_start[1:]
    if joined.any():
        keep = np.flatnonzero(~joined)
        slots = np.where(name[keep], np.add.reduceat(slots, keep) | np.uint64(1), slots[keep])
        tokens, gap, first = tokens[keep], gap[keep], np.searchsorted(keep, first)
    return tokens, slots, gap, first


def _starts(n_tokens: int, first: np.ndarray, size: int) -> np.ndarray:
    """Where windows of ``size`` tokens begin that stay in their row."""
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return np.flatnonzero(rows[: max(n_tokens - size + 1, 0)] == rows[size - 1 :])


def _hashes(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    total = np.full(len(at), size, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + mix(values[at + k])
    return mix(total)


def _cut(tokens: np.ndarray, slots: np.ndarray, gap: np.ndarray, first: np.ndarray, items: bool):
    """Windows of a piece, as (begin, size, hash): of items those to look for, of texts all they might meet."""
    at = _starts(len(tokens), first, WINDOW)
    filled = np.concatenate([[0], np.cumsum(slots != 0)])
    bare = filled[at + WINDOW] - filled[at] == WINDOW
    owner = np.searchsorted(first, at, "right") - 1
    worded = np.bincount(owner[~bare], minlength=len(first) - 1) > 0
    by_value = at[bare & ~(items & worded[owner])]
    found = [
        (at[~bare], WINDOW, _hashes(tokens, at[~bare], WINDOW)),
        (by_value, WINDOW, _hashes(slots, by_value, WINDOW) + np.uint64(1)),
    ]
    ends = np.append(gap, True)
    ends[first] = True
    for size in range(SHORTEST, WINDOW):
        at = _starts(len(tokens), first, size)
        at = at[ends[at] & ends[at + size]]
        if items:
            at = at[np.diff(first)[np.searchsorted(first, at, "right") - 1] == size]
        found.append((at, size, _hashes(tokens, at, size)))
    return found


def windows(texts: DataFrame, keys: list[str], wanted: np.ndarray | None = None) -> DataFrame:
    """(keys, hash, position, tokens, slots) for each window of ``texts`` (keys, text).

    ``slots`` has the value of each token's slot or zero. Without ``wanted`` the texts are items, and
    ``tokens`` counts those of the row that lie in a window; with it they are documents, of which only
    windows are given whose leading hash bits it flags.
    """
    kinds = ", ".join(f"{k} {texts.schema[k].dataType.simpleString()}" for k in keys)
    names = [*keys, "hash", "position", "tokens", "slots"]

    def cut(batches):
        for batch in batches:
            row = 0
            for piece in pieces(batch.column(len(keys))):
                tokens, slots, gap, first = templates(piece)
                found = _cut(tokens, slots, gap, first, wanted is None)
                covered = np.zeros(len(tokens) + 1, np.int64)
                for at, size, _ in found if wanted is None else ():
                    np.add.at(covered, at, 1)
                    np.add.at(covered, at + size, -1)
                count = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
                count = count[first[1:]] - count[first[:-1]]
                for at, size, hashes in found:
                    if wanted is not None:
                        hit = np.flatnonzero(wanted[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
                        at, hashes = at[hit], hashes[hit]
                    owner = np.searchsorted(first, at, "right") - 1
                    values = slots[at[:, None] + np.arange(size)].view(np.int64)
                    ends = pa.array(np.arange(len(at) + 1) * size, pa.int32())
                    yield pa.record_batch(
                        [
                            *(batch.column(k).take(pa.array(row + owner)) for k in range(len(keys))),
                            pa.array(hashes.view(np.int64)),
                            pa.array((at - first[owner]).astype(np.int32)),
                            pa.array(count[owner].astype(np.int32)),
                            pa.ListArray.from_arrays(ends, pa.array(values.ravel())),
                        ],
                        names=names,
                    )
                row += len(piece)

    cast = texts.select(*keys, F.col("text").cast("string"))
    return cast.mapInArrow(cut, f"{kinds}, hash long, position int, tokens int, slots array<long>")


def _flags(hashes: DataFrame) -> np.ndarray:
    """Which leading bits occur among the hashes."""
    leading = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    seen = hashes.select(leading.alias("bits")).distinct().toArrow().to_pandas().bits.to_numpy(np.int64)
    flags = np.zeros(1 << FILTER_BITS, bool)
    flags[seen] = True
    return flags


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, text_key, item_id, coverage, verbatim) for each document and item it leaks.

    ``coverage`` is the share of the item's tokens at the best alignment, ``verbatim`` whether all slots
    hold the item's own values there. ``text_key`` is xxhash64 of the text, which tells rows apart that
    share an id or have none. A word more or less hides at most four tokens at an end of the item, so items
    of 20 tokens on are found whatever that word, shorter ones unless it is next to an end. Items under three
    template tokens are too short to tell and never match; null or empty texts and items give nothing, nor
    do empty tables; texts of any length are read to their end; repeated rows count once; other columns are
    ignored.
    """
    items = windows(benchmark.select("item_id", "text"), ["item_id"]).selectExpr(
        "item_id", "hash", "position AS item_position", "tokens AS item_tokens", "slots AS item_slots"
    )
    keyed = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("text_key"), "text")
    met = windows(keyed, ["doc_id", "text_key"], _flags(items)).drop("tokens").join(items, "hash")
    shift, pairs = "(position - item_position)", "FILTER(ARRAYS_ZIP(item_slots, slots), p -> p.item_slots != 0)"
    bands = f"ARRAY(3 * {shift}, 3 * FLOOR({shift} / {BAND}) + 1, 3 * FLOOR({shift} / {BAND} + 0.5) + 2)"
    aligned = met.selectExpr(
        "doc_id", "text_key", "item_id", "item_tokens", f"EXPLODE({bands}) AS band", f"{pairs} AS pairs",
        "SEQUENCE(item_position, item_position + SIZE(item_slots) - 1) AS held", "SIZE(item_slots) AS size",
    )
    held = aligned.groupBy("doc_id", "text_key", "item_id", "band").agg(
        F.expr("SIZE(ARRAY_DISTINCT(FLATTEN(COLLECT_SET(held)))) / MAX(item_tokens)").alias("coverage"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
        F.min("size").alias("size"),
    )
    consistent = (
        held.where(F.col("coverage") >= coverage)
        .where("SIZE(pairs) = SIZE(ARRAY_DISTINCT(pairs.item_slots))")
        .withColumn("verbatim", F.expr("FORALL(pairs, p -> p.item_slots = p.slots)"))
        .where(f"verbatim OR size = {WINDOW}")
    )
    return consistent.groupBy("doc_id", "text_key", "item_id").agg(
        F.max("coverage").alias("coverage"), F.max("verbatim").alias("verbatim")
    )


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that leak an item; columns unchanged.

    Texts move only where a table of flags of fixed size can't rule out that they leak.
    """
    bad = store(leaks(docs, benchmark).select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key")).distinct())
    key = F.xxhash64(F.col("text").cast("string"))
    may_leak = flagged(key, flags(bad, "_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (key == F.col("_key"))
    return docs.where(may_leak).join(bad, same, "left_anti").unionByName(docs.where(~may_leak))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")
