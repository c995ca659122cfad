"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network.

A word's vector is the sum of the index vectors of its neighbours over the whole corpus; an index vector
has a few entries of +1 or -1 at places that a hash picks. Words are hashed into a fixed number of
buckets, so each task adds up one small table and the sums, whole numbers, are the same in any order.

A document is pooled into the mean of its word vectors, their spread, and how far each lies from the one
before it, which tells repetition. The network is fitted on a bounded sample of labelled rows
(``SAMPLE`` of each class), a fifth of which calibrates its temperature instead.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.llm.samples import bounded, labelled
from tellerlake.llm.tables import held_out, store, table
from tellerlake.llm.words import Words, hash_spans, mix, pieces, raw, sums

BUCKETS = 1 << 14
DIM = 32
ENTRIES = 2
WINDOW = 2
HIDDEN = 32
SAMPLE = 10_000
THRESHOLD = 0.3
EPOCHS = 40

#: Kinds of bytes: white space, letters (all beyond ASCII count as such), digits, signs.
_KIND = np.full(256, 3, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
#: The bucket of words in capitals, which are read for their form.
_CAPITALS = 0


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the runs of letters, digits or signs, and the rows' bounds in them."""
    data, offsets = raw(texts)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = _KIND[data]
    opens = np.ones(len(data), bool)
    opens[1:] = kind[1:] != kind[:-1]
    opens[offsets[(offsets > 0) & (offsets < len(data))]] = True
    start = np.flatnonzero(opens)
    length = np.diff(np.append(start, len(data)))
    full = kind[start] > 0
    start, length = start[full], length[full]
    words = Words(data, start, length, np.searchsorted(start, offsets))
    buckets = (hash_spans(data, start, length) % np.uint64(BUCKETS - 1)).astype(np.int64) + 1
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    buckets[(length > 1) & (upper[start + length] - upper[start] == length)] = _CAPITALS
    return buckets, words.first


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of each bucket's index vector."""
    random = mix(np.arange(BUCKETS * ENTRIES, dtype=np.uint64) + np.uint64(7)).reshape(BUCKETS, ENTRIES)
    return (random >> np.uint64(40)).astype(np.int64) % DIM, 1.0 - 2.0 * (random & np.uint64(1)).astype(float)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The vectors of all buckets from every row of ``docs``, centred, of length one."""

    def gather(batches):
        place, sign = _index_vectors()
        total = np.zeros(BUCKETS * DIM)
        for batch in batches:
            for piece in pieces(batch.column(0)):
                buckets, first = _tokens(piece)
                rows = np.repeat(np.arange(len(piece)), np.diff(first))
                for step in range(1, WINDOW + 1):
                    near = np.flatnonzero(rows[step:] == rows[:-step])
                    left, right = buckets[near], buckets[near + step]
                    for k in range(ENTRIES):
                        total += np.bincount(left * DIM + place[right, k], sign[right, k], BUCKETS * DIM)
                        total += np.bincount(right * DIM + place[left, k], sign[left, k], BUCKETS * DIM)
        table = total.astype(np.int64).reshape(BUCKETS, DIM)
        used = np.flatnonzero(table.any(axis=1))
        columns = [pa.array(used), *(pa.array(table[used, k]) for k in range(DIM))]
        yield pa.record_batch(columns, names=["bucket", *(f"v{k}" for k in range(DIM))])

    names = [f"v{k}" for k in range(DIM)]
    found = docs.select(F.col("text").cast("string")).mapInArrow(gather, "bucket long, " + ", ".join(f"{v} long" for v in names))
    found = found.groupBy("bucket").agg(*(F.sum(v).alias(v) for v in names)).toArrow().to_pandas()
    vectors = np.zeros((BUCKETS, DIM))
    vectors[found.bucket] = found[names]
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    vectors[found.bucket] -= vectors[found.bucket].mean(axis=0) if len(found) else 0
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _pool(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean, spread and mean step of the word vectors of each row of a piece; zeros for no words."""
    buckets, first = _tokens(texts)
    count = np.maximum(np.diff(first), 1)[:, None].astype(np.float32)
    found = vectors[buckets]
    steps = np.zeros_like(found)
    np.abs(np.subtract(found[1:], found[:-1], out=steps[1:]), out=steps[1:])
    begins = first[:-1][np.diff(first) > 0]
    steps[begins] = 0
    mean, step = sums(found, first) / count, sums(steps, first) / count
    spread = np.sqrt(np.maximum(sums(found * found, first) / count - mean * mean, 0))
    return np.concatenate([mean, spread, step], axis=1)


def pooled(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(doc_id, pool) of every row; a text without words, or null, has a pool of zeros."""

    @F.arrow_udf("array<float>")
    def pool(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = np.concatenate([_pool(p, vectors) for p in pieces(texts)] or [np.zeros((0, 3 * DIM))])
            ends = pa.array(np.arange(len(texts) + 1) * 3 * DIM, pa.int32())
            yield pa.ListArray.from_arrays(ends, pa.array(found.ravel(), pa.float32()))

    return docs.select("doc_id", pool(F.col("text").cast("string")).alias("pool"))


@dataclass
class Network:
    """Standardises, passes a tanh layer and a logistic one; ``temperature`` divides the logit."""

    centre: np.ndarray
    scale: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: float
    temperature: float

    def logits(self, pools: np.ndarray) -> np.ndarray:
        hidden = np.tanh((pools - self.centre) / self.scale @ self.inner + self.inner_bias)
        return hidden @ self.outer + self.outer_bias

    def scores(self, pools: np.ndarray) -> np.ndarray:
        return _logistic(self.logits(pools) / self.temperature)


def _logistic(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits, -40, 40)))


def _temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """Of a range of temperatures the one that makes the truth likeliest."""
    choices = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
    signed = np.where(truth > 0, logits, -logits)
    return float(choices[np.argmin([np.logaddexp(0, -signed / t).sum() for t in choices])])


def train(pools: np.ndarray, truth: np.ndarray, weights: np.ndarray, seed: int = 0) -> Network:
    """Fit by Adam on four fifths of the rows, and the temperature on the rest.

    Without rows every score is a half; with rows of one class it nears that class's.
    """
    random = np.random.default_rng(seed)
    width = pools.shape[1]
    net = Network(
        pools.mean(axis=0) if len(pools) else np.zeros(width),
        np.maximum(pools.std(axis=0), 1e-3) if len(pools) else np.ones(width),
        random.normal(0, width**-0.5, (width, HIDDEN)),
        np.zeros(HIDDEN),
        np.zeros(HIDDEN),
        0.0,
        1.0,
    )
    order = random.permutation(len(pools))
    spare, used = order[: len(order) // 5], order[len(order) // 5 :]
    inputs = (pools - net.centre) / net.scale
    weights = weights / max(weights.mean(), 1e-9) if len(weights) else weights
    values = [net.inner, net.inner_bias, net.outer, np.zeros(1)]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    turn = 0
    for _ in range(EPOCHS):
        random.shuffle(used)
        for at in range(0, len(used), 256):
            batch = used[at : at + 256]
            x = inputs[batch]
            hidden = np.tanh(x @ values[0] + values[1])
            error = (_logistic(hidden @ values[2] + values[3]) - truth[batch]) * weights[batch] / len(batch)
            back = error[:, None] * values[2] * (1 - hidden**2)
            slopes = [x.T @ back + 1e-4 * values[0], back.sum(axis=0), hidden.T @ error, error.sum(keepdims=True)]
            turn += 1
            for value, slope, (one, two) in zip(values, slopes, moments):
                one += 0.1 * (slope - one)
                two += 0.001 * (slope**2 - two)
                value -= 0.003 * (one / (1 - 0.9**turn)) / (np.sqrt(two / (1 - 0.999**turn)) + 1e-8)
    net.outer_bias = float(values[3][0])
    if len(spare):
        net.temperature = _temperature(net.logits(pools[spare]), truth[spare])
    return net


def fit(pools: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Network:
    """The network of a sample of ``pools`` (doc_id, pool) with labels."""
    rows = bounded(labelled(pools, labels, label), labels, label, {0: sample, 1: sample}).toArrow().to_pandas()
    rows["order"] = [tuple(pool) for pool in rows.pool]
    rows = rows.sort_values(["doc_id", "order", "label"])  # the order of arrival is chance
    truth = rows.label.to_numpy(float)
    counts = dict(labels.where(F.col(label).isNotNull()).groupBy((F.col(label) != 0).cast("int")).count().collect())
    taken = {k: max((truth == k).sum(), 1) for k in (0, 1)}
    weights = np.where(truth > 0, counts.get(1, 0) / taken[1], counts.get(0, 0) / taken[0])
    values = np.stack(rows.pool.to_list()).astype(float) if len(rows) else np.zeros((0, 3 * DIM))
    return train(values, truth, weights)


def score(pools: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """``pools`` with ``score`` and ``predicted`` in place of the pool."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for found in batches:
            values = found.flatten().to_numpy(zero_copy_only=False).reshape(len(found), -1).astype(float)
            yield pa.array(net.scores(values) if len(found) else [], pa.float64())

    rest = [c for c in pools.columns if c != "pool"]
    return pools.select(*rest, scored("pool").alias("score")).selectExpr(
        "*", f"CAST(score >= {threshold} AS INT) AS predicted"
    )


def classify(docs: DataFrame, labels: DataFrame, trains, label: str = "quality") -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs`` (doc_id, text).

    Labels are learned from rows where the column ``trains`` over doc_id holds. Texts that are empty or
    null have the score of a document without words. Rows without doc_id are scored and never learned
    from; repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    pools = store(pooled(docs, word_vectors(docs)))
    net = fit(pools.where(trains), labels.where(trains), label)
    return score(pools, net)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = held_out(F.col("doc_id"), 5, 0)
    found = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")
