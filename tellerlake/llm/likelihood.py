"""Scoring texts by masked pseudo-likelihood.

A network sees up to three words on either side of a word, never the word itself, and predicts it; the
log-probabilities it gives all words of a text, added up, are the text's score. Words are the commonest
of the whole corpus by exact count, and others by a hash into ``TAIL`` units. The output is factored: a
class of units first, then the unit in its class, so a word costs two small softmaxes.

Training is data-parallel over all texts and predicts every word of them once: a hash of the word and its
place deals it to one of the rounds. In each round every task starts from the same weights, masks the round's
words in its texts, takes AdaGrad steps to predict them, and hands in its weights, which are averaged by the
number of words they saw. Counts and weights are added up by Spark; the driver only gets
the commonest words and one set of averaged weights.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.llm.tables import discard, store, table
from tellerlake.llm.words import mix, pieces, words

CLASSES = 64
UNITS = CLASSES * 64
TAIL = 1024
#: The unit beside the ends of a text.
NOTHING = UNITS
REACH = 3
DIM = 32
ROUNDS = 2
BATCH = 2048
RATE = 0.1
#: Words scored at once, and rows from which a unit's slopes are added up by themselves: they decide the time only.
SCORED = 4096
DEEP = 24
#: Floats hold the exponents of logits between this and its negative, and a row's sum of them.
SAFE = 80
_OFFSETS = [*range(-REACH, 0), *range(1, REACH + 1)]


@dataclass
class Model:
    """``common`` has the hashes of the commonest words in order, ``unit`` the unit of each."""

    common: np.ndarray
    unit: np.ndarray
    weights: dict[str, np.ndarray]


def _search(common: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """``np.searchsorted(common, hashes)``. Hashes are spread evenly, so their upper bits tell nearly where."""
    bounds = np.searchsorted(common, np.arange(1 << 16, dtype=np.uint64) << np.uint64(48))
    at = bounds[(hashes >> np.uint64(48)).astype(np.int64)]
    ended = np.append(common, np.uint64(2**64 - 1))
    rest = np.flatnonzero(ended[at] < hashes)
    while rest.size:
        at[rest] += 1
        rest = rest[ended[at[rest]] < hashes[rest]]
    return at


def _units(hashes: np.ndarray, common: np.ndarray, unit: np.ndarray) -> np.ndarray:
    tail = UNITS - TAIL + (mix(hashes) % np.uint64(TAIL)).astype(np.int64)
    if not len(common):
        return tail
    at = np.minimum(_search(common, hashes), len(common) - 1)
    return np.where(common[at] == hashes, unit[at], tail)


def _counts(docs: DataFrame) -> DataFrame:
    """(word, n): how often each word occurs, words by their hash."""

    def count(batches):
        for batch in batches:
            found = [words(piece).hashes() for piece in pieces(batch.column(0))]
            keys, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64),) * 2
            yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    texts = docs.select(F.col("text").cast("string"))
    return texts.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _start(common: np.ndarray, unit: np.ndarray, n: np.ndarray, tail: np.ndarray, seed: int = 0) -> dict:
    """Small random weights, and biases that make every context give the units' own frequencies."""
    random = np.random.default_rng(seed)
    share = np.full(UNITS, 0.5)
    share[unit] += n
    share[UNITS - TAIL :] += tail
    share = share.reshape(CLASSES, -1)
    near = lambda *shape: random.normal(0, 0.1, shape).astype(np.float32)
    embed = near(UNITS + 1, DIM)
    embed[NOTHING] = 0
    return {
        "embed": embed,
        "inner": near(len(_OFFSETS) * DIM, DIM),
        "inner_bias": np.zeros(DIM, np.float32),
        "outer": near(DIM, CLASSES) / 10,
        "outer_bias": np.log(share.sum(axis=1) / share.sum()).astype(np.float32),
        "leaf": near(CLASSES, DIM, UNITS // CLASSES) / 10,
        "leaf_bias": np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32),
    }


def _padded(units: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The units with ``REACH`` times ``NOTHING`` around each text, and the place of each there."""
    place = np.arange(len(units)) + REACH * np.repeat(np.arange(1, len(first)), np.diff(first))
    padded = np.full(len(units) + REACH * len(first), NOTHING, np.int64)
    padded[place] = units
    return padded, place


def _context(padded: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The units around each place, by offset; ``NOTHING`` beyond the ends of its text."""
    around = np.empty((len(place), len(_OFFSETS)), np.int64)
    for k, offset in enumerate(_OFFSETS):
        around[:, k] = padded.take(place + offset)
    return around


def _exp(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The exponents, in place, and their sum in each row."""
    np.exp(logits, out=logits)
    return logits, logits @ np.ones(logits.shape[1], logits.dtype)


def _shift(logits: np.ndarray) -> None:
    """Bring the highest logit of each row to zero, in place, unless floats hold all exponents as they are."""
    if not (-SAFE < logits.min(initial=0) and logits.max(initial=0) < SAFE):
        logits -= logits.max(axis=1, keepdims=True)


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Shares that add up to one in each row, in place."""
    _shift(logits)
    shares, total = _exp(logits)
    shares /= total[:, None]
    return shares


def _log_shares(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of each row the logarithm of the share that the softmax gives the column ``at``; the logits are used up."""
    _shift(logits)
    own = logits[np.arange(len(at)), at]
    return own - np.log(_exp(logits)[1])


def _class_spans(classes: np.ndarray) -> list[tuple[int, int, int]]:
    """Each class that occurs among sorted ones, with its first place and the one after its last."""
    bounds = np.searchsorted(classes, np.arange(CLASSES + 1)).tolist()
    return [(c, low, high) for c, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])) if low < high]


def _sums_of_units(flat: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The units that occur in ``flat``, and of each the sum of its rows of ``values``.

    Units with most rows come first, so the next row of each is added to the head of the sums: a step for each row
    of a unit, of all units at once. Those with more than ``DEEP`` rows are summed one by one.
    """
    counts = np.bincount(flat, minlength=UNITS + 1)
    # Bytes are sorted fastest; counts they can't tell apart are of units that are summed one by one.
    rows = np.argsort((255 - np.minimum(counts, 255)).astype(np.uint8), kind="stable")[: np.count_nonzero(counts)]
    counts = counts[rows]
    place = np.empty(UNITS + 1, np.uint16)
    place[rows] = np.arange(len(rows))
    order = np.argsort(place[flat], kind="stable")
    first = np.cumsum(counts) - counts
    deep = int(np.searchsorted(-counts, -DEEP))
    out = np.empty((len(rows), values.shape[1]), values.dtype)
    for k, (low, n) in enumerate(zip(first[:deep].tolist(), counts[:deep].tolist())):
        np.add.reduce(values.take(order[low : low + n], axis=0), axis=0, out=out[k])
    if deep < len(rows):
        first, counts, sums = first[deep:], counts[deep:], out[deep:]
        np.take(values, order[first], axis=0, out=sums)
        # How many units have more than k rows.
        more = np.searchsorted(-counts, -np.arange(1, counts[0])).tolist()
        for k, n in enumerate(more, 1):
            sums[:n] += values.take(order[first[:n] + k], axis=0)
    return rows, out


def _move(weights: np.ndarray, squares: np.ndarray, slope: np.ndarray) -> None:
    """One AdaGrad step of one array, in place; the slope is used up."""
    step = np.square(slope)
    squares += step
    np.sqrt(squares, out=step)
    np.divide(slope, step, out=slope)
    slope *= RATE
    weights -= slope


def _step(w: dict, squares: dict, units: np.ndarray, around: np.ndarray) -> None:
    """One AdaGrad step on a batch of masked words and what stands around them."""
    # By class, so each class has its rows side by side.
    n, per_class = len(units), UNITS // CLASSES
    order = np.argsort((units // per_class).astype(np.uint8), kind="stable")
    units, around, every = units[order], around[order], np.arange(n)
    classes, place = units // per_class, units % per_class
    spans = _class_spans(classes)
    seen = w["embed"].take(around.ravel(), axis=0).reshape(n, -1)
    hidden = seen @ w["inner"]
    hidden += w["inner_bias"]
    np.tanh(hidden, out=hidden)
    error = hidden @ w["outer"]
    error += w["outer_bias"]
    _softmax(error)
    error[every, classes] -= 1
    error /= n
    slopes = {"outer": hidden.T @ error, "outer_bias": error.sum(axis=0)}
    own = np.empty((n, per_class), np.float32)
    for c, low, high in spans:
        np.matmul(hidden[low:high], w["leaf"][c], out=own[low:high])
    own += w["leaf_bias"].take(classes, axis=0)
    _softmax(own)
    own[every, place] -= 1
    own /= n
    back, into = error @ w["outer"].T, np.empty_like(hidden)
    slopes["leaf"], slopes["leaf_bias"] = np.zeros_like(w["leaf"]), np.zeros_like(w["leaf_bias"])
    ones = np.ones(n, np.float32)
    for c, low, high in spans:
        mine = own[low:high]
        np.matmul(hidden[low:high].T, mine, out=slopes["leaf"][c])
        np.matmul(ones[low:high], mine, out=slopes["leaf_bias"][c])
        np.matmul(mine, w["leaf"][c].T, out=into[low:high])
    back += into
    np.square(hidden, out=hidden)
    np.subtract(1, hidden, out=hidden)
    back *= hidden
    slopes["inner"], slopes["inner_bias"] = seen.T @ back, back.sum(axis=0)
    into = (back @ w["inner"].T).reshape(-1, DIM)
    for name, slope in slopes.items():
        _move(w[name], squares[name], slope)
    # Only units that stand around a word move; others have no slope.
    rows, slope = _sums_of_units(around.ravel(), into)
    slope[rows == NOTHING] = 0
    weights, held = w["embed"].take(rows, axis=0), squares["embed"].take(rows, axis=0)
    _move(weights, held, slope)
    w["embed"][rows], squares["embed"][rows] = weights, held


def _flat(weights: dict) -> np.ndarray:
    return np.concatenate([v.ravel() for v in weights.values()])


def _shaped(flat: np.ndarray, like: dict) -> dict:
    bounds = np.cumsum([0, *(v.size for v in like.values())])
    parts = (flat[a:b] for a, b in zip(bounds[:-1], bounds[1:]))
    return {k: p.reshape(v.shape).astype(np.float32) for (k, v), p in zip(like.items(), parts)}


def _turns(hashes: np.ndarray, first: np.ndarray, rounds: int) -> np.ndarray:
    """The round, of ``rounds``, that predicts each word."""
    spot = np.arange(len(hashes), dtype=np.uint64) - np.repeat(first[:-1], np.diff(first)).astype(np.uint64)
    return (mix(hashes + mix(spot)) % np.uint64(rounds)).astype(np.int64)


def _round(docs: DataFrame, model: Model, turn: int, rounds: int) -> dict:
    """The weights after every task has trained on the words of its texts that round ``turn`` predicts."""

    def train(batches):
        weights = {k: v.copy() for k, v in model.weights.items()}
        squares = {k: np.full_like(v, 1e-6) for k, v in weights.items()}
        saw, held_units, held_around = 0, [], []
        for batch in batches:
            for piece in pieces(batch.column(0)):
                found = words(piece)
                hashes = found.hashes()
                units = _units(hashes, model.common, model.unit)
                at = np.flatnonzero(_turns(hashes, found.first, rounds) == turn)
                held_units.append(units[at])
                padded, place = _padded(units, found.first)
                held_around.append(_context(padded, place[at]))
                if sum(map(len, held_units)) >= BATCH:
                    units, around = np.concatenate(held_units), np.concatenate(held_around)
                    whole = len(units) // BATCH * BATCH
                    for low in range(0, whole, BATCH):
                        _step(weights, squares, units[low : low + BATCH], around[low : low + BATCH])
                    saw, held_units, held_around = saw + whole, [units[whole:]], [around[whole:]]
        units = np.concatenate([np.zeros(0, np.int64), *held_units])
        if len(units):
            _step(weights, squares, units, np.concatenate(held_around))
        saw += len(units)
        flat = _flat(weights) if saw else np.zeros(0)
        for low in range(0, len(flat), 50_000):
            part = flat[low : low + 50_000].astype(float)
            slots = pa.array(np.arange(low, low + len(part), dtype=np.int32))
            yield pa.record_batch([slots, pa.array(part * saw), pa.array(np.full(len(part), float(saw)))], names=["slot", "value", "saw"])

    texts = docs.select(F.col("text").cast("string"))
    given = texts.mapInArrow(train, "slot int, value double, saw double").groupBy("slot")
    found = given.agg((F.sum("value") / F.sum("saw")).alias("value")).toArrow().to_pandas()  # a row for each weight
    if not len(found):
        return model.weights
    flat = np.zeros(len(found))
    flat[found.slot] = found.value
    return _shaped(flat, model.weights)


def fit(docs: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model of all texts of ``docs``."""
    counted = store(_counts(docs))
    most = UNITS - TAIL
    top = counted.orderBy(F.desc("n"), "word").limit(most).toArrow().to_pandas()
    total = counted.agg(F.sum("n")).first()[0] or 0
    discard(counted)
    order = np.argsort(top.word.to_numpy(np.int64).view(np.uint64))
    common = top.word.to_numpy(np.int64).view(np.uint64)[order]
    tail = np.full(TAIL, max(total - top.n.sum(), 0) / TAIL)
    model = Model(common, order.astype(np.int64), {})
    model.weights = _start(common, model.unit, top.n.to_numpy(float)[order], tail)
    for turn in range(rounds):
        model.weights = _round(docs, model, turn, rounds)
    return model


def log_probabilities(units: np.ndarray, first: np.ndarray, weights: dict) -> np.ndarray:
    """Of each word the log-probability that both its sides give it."""
    out, per_class = np.zeros(len(units)), UNITS // CLASSES
    inner = weights["inner"].reshape(len(_OFFSETS), DIM, DIM)
    tables = [weights["embed"] @ m for m in inner]
    padded, spot = _padded(units, first)
    for low in range(0, len(units), SCORED):
        at = np.arange(low, min(low + SCORED, len(units)))
        at = at[np.argsort((units[at] // per_class).astype(np.uint8), kind="stable")]
        own, around = units[at], _context(padded, spot[at])
        hidden = tables[0].take(around[:, 0], axis=0)
        for k in range(1, len(tables)):
            hidden += tables[k].take(around[:, k], axis=0)
        hidden += weights["inner_bias"]
        np.tanh(hidden, out=hidden)
        classes, place = own // per_class, own % per_class
        logits = hidden @ weights["outer"]
        logits += weights["outer_bias"]
        leaf = np.empty((len(own), per_class), np.float32)
        for c, start, stop in _class_spans(classes):
            np.matmul(hidden[start:stop], weights["leaf"][c], out=leaf[start:stop])
        leaf += weights["leaf_bias"].take(classes, axis=0)
        out[at] = _log_shares(logits, classes) + _log_shares(leaf, place).astype(float)
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, words, log_likelihood, per_word) of every row.

    A text that is null or has no words scores zero in all three. Rows without doc_id are scored like
    others, repeated rows stay, an empty table gives no rows, other columns are ignored.
    """
    kind = pa.struct([("words", pa.int64()), ("log_likelihood", pa.float64()), ("per_word", pa.float64())])

    @F.arrow_udf("words long, log_likelihood double, per_word double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            counts, sums = [np.zeros(0, np.int64)], [np.zeros(0)]
            for piece in pieces(texts):
                found = words(piece)
                each = log_probabilities(_units(found.hashes(), model.common, model.unit), found.first, model.weights)
                run = np.concatenate([[0.0], np.cumsum(each)])
                counts.append(np.diff(found.first))
                sums.append(run[found.first[1:]] - run[found.first[:-1]])
            n, total = np.concatenate(counts), np.where(np.concatenate(counts) > 0, np.concatenate(sums), 0.0)
            columns = [pa.array(n), pa.array(total), pa.array(total / np.maximum(n, 1))]
            yield pa.StructArray.from_arrays(columns, fields=list(kind))

    return docs.select("doc_id", scored(F.col("text").cast("string")).alias("s")).select("doc_id", "s.*")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs))
