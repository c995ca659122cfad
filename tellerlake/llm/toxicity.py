"""Toxicity: bags of subwords, averaged, under a linear softmax that is trained together with them.

A word is the bag of its byte n-grams, with marks at its ends, so a misspelling never seen shares most
of its vectors with the word it hides. The embeddings of a window's words are averaged and classified;
a document is as toxic as its most toxic window, so that one insult in a long text counts as much as in
a short one. n-grams are hashed into a fixed number of buckets.

Fitted on a bounded sample of labelled documents (``SAMPLE`` of each class, texts up to ``LONGEST``
bytes). Which window of a toxic document is the toxic one is not labelled: the first choice holds the
word that tells the classes apart best, later ones are the model's own. Clean documents give their most
suspect windows and others at random. Scoring covers every window of every text.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.llm.samples import bounded, labelled
from tellerlake.llm.tables import held_out, table
from tellerlake.llm.words import ASCII_SPACE, LOW_BYTES, hash_spans, mix, pieces, raw, split, sums, windows_of_8

BUCKETS = 1 << 18
DIM = 8
NGRAMS = (3, 4, 5, 6, 7)
#: Words of the windows: one word may be the insult by itself, or a phrase of harmless ones.
WIDTHS = (1, 2, 4, 8)
SAMPLE = 3_000
LONGEST = 1 << 16
THRESHOLD = 0.3
ROUNDS = 3
STEPS = 150
BATCH = 512
RATE = 0.5
#: Keeps subwords that a batch hardly holds from moving far.
EASE = 1e-9

#: Marks that are stripped from the ends of words.
_EDGE = np.zeros(256, bool)
_EDGE[list(b".,;:!?\"'()[]{}")] = True


@dataclass
class Model:
    """``logit[bucket]`` is the embedding of an n-gram times the difference of the softmax's two columns."""

    logit: np.ndarray
    slope: float
    shift: float


def _words(texts: pa.Array):
    """Lower-case words of a piece without marks at their ends; a line break follows each text."""
    joined = pc.binary_join_element_wise(pc.utf8_lower(texts), pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
    words = split(*raw(joined), ASCII_SPACE)
    start, length = words.start, words.length
    for _ in range(4):
        front = (length > 1) & _EDGE[words.data[start]]
        start, length = start + front, length - front
        length = length - ((length > 1) & _EDGE[words.data[start + length - 1]])
    words.start, words.length = start, length
    return words


def _grams(words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, bucket) of all subwords, size by size: n-grams with end marks, then whole words."""
    if not len(words.start):
        return
    change = np.zeros(len(words.data) + 1, np.int8)
    change[words.start] += 1
    change[words.start + words.length] -= 1
    inside = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
    plain = np.where(inside, words.data, np.uint8(32))
    eight = windows_of_8(np.concatenate([[np.uint8(32)], plain, [np.uint8(32)]]))
    owner = np.cumsum(change[:-1] > 0) - 1
    whole = inside.copy()
    for n in NGRAMS:
        if n > 3:
            whole = whole[:-1] & inside[n - 3 :]
        middle = np.flatnonzero(whole)
        values = (eight[middle] & LOW_BYTES[n]) + np.uint64(n << 56)
        yield owner[middle], (mix(values) >> np.uint64(20)).astype(np.int64) % BUCKETS
    hashes = hash_spans(plain, words.start, words.length, seed=1)
    yield np.arange(len(words.start)), (hashes >> np.uint64(20)).astype(np.int64) % BUCKETS


def _word_logits(words, logit: np.ndarray) -> np.ndarray:
    """Of each word the mean logit of its subwords."""
    n = len(words.start)
    total, count = np.zeros(n), np.zeros(n)
    for owner, bucket in _grams(words):
        total += np.bincount(owner, logit[bucket], n)
        count += np.bincount(owner, minlength=n)
    return total / np.maximum(count, 1)


def _windows(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of the windows at every word of each text (one for a short text), and the rows' bounds."""
    length = np.diff(first)
    count = np.where(length > 0, np.maximum(length - width + 1, 1), 0)
    bounds = np.concatenate([[0], np.cumsum(count)])
    begin = np.arange(bounds[-1]) - np.repeat(bounds[:-1], count) + np.repeat(first[:-1], count)
    return begin, np.minimum(begin + width, np.repeat(first[1:], count)), bounds


def _window_logits(words, logit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(begin, end, logit, rows' bounds) of the windows of each width."""
    run = np.concatenate([[0.0], np.cumsum(_word_logits(words, logit))])
    for width in WIDTHS:
        begin, end, bounds = _windows(words.first, width)
        yield begin, end, (run[end] - run[begin]) / np.maximum(end - begin, 1), bounds


def _text_logits(texts: pa.Array, logit: np.ndarray) -> np.ndarray:
    """The logit of each text's most toxic window; the mildest possible for a text without words."""
    out = np.full(len(texts), -np.inf)
    for _, _, found, bounds in _window_logits(_words(texts), logit):
        full = np.flatnonzero(np.diff(bounds))
        if full.size:
            out[full] = np.maximum(out[full], np.maximum.reduceat(found, bounds[full]))
    return out


def _worst(texts: pa.Array, logit: np.ndarray, random) -> tuple[list, np.ndarray, list]:
    """Of each text with words: its most suspect window, that one's logit, and two windows at random."""
    worst, logits, others = [], [], []
    for piece in pieces(texts):
        words = _words(piece)
        widths = list(_window_logits(words, logit))
        whole = words.data.tobytes()

        def window(begin, end):
            return whole[words.start[begin] : words.start[end - 1] + words.length[end - 1]].decode("utf-8", "replace")

        for row in range(len(piece)):
            best = None
            for begin, end, found, bounds in widths:
                low, high = bounds[row], bounds[row + 1]
                if low < high:
                    at = low + int(found[low:high].argmax())
                    if best is None or found[at] > best[0]:
                        best = found[at], begin[at], end[at]
            if best is not None:
                worst.append(window(*best[1:]))
                logits.append(best[0])
                pair = []
                for _ in range(2):
                    begin, end, _, bounds = widths[random.integers(len(widths))]
                    at = random.integers(bounds[row], bounds[row + 1])
                    pair.append(window(begin[at], end[at]))
                others.append(pair)
    return worst, np.array(logits), others


def _telling(texts: pa.Array, truth: np.ndarray) -> np.ndarray:
    """Of each subword how surely toxic documents hold it more often: its log-likelihood ratio, or zero."""
    held, row = np.zeros((2, BUCKETS)), 0
    for piece in pieces(texts):
        words = _words(piece)
        owners = words.rows()
        grams = [(owners[word], bucket) for word, bucket in _grams(words)]
        for low in range(0, len(piece), 64):
            seen = np.zeros((64, BUCKETS), bool)
            for owner, bucket in grams:
                some = slice(*np.searchsorted(owner, [low, low + 64]))
                seen[owner[some] - low, bucket[some]] = True
            for k in (0, 1):
                rows = np.flatnonzero(truth[row + low : row + min(low + 64, len(piece))] == k)
                held[k] += seen[rows].sum(axis=0)
        row += len(piece)
    count = np.array([[(truth == 0).sum()], [(truth == 1).sum()]])
    rate = held.sum(axis=0) / count.sum()

    def part(seen, expected):
        return seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9))

    ratio = 2 * sum(part(held, count * rate) + part(count - held, count * (1 - rate)))
    return np.where(held[1] > count[1] * rate, ratio, 0)


class _Bags:
    """Windows as bags of subwords: a subword weighs 1 / (words of the window * subwords of its word)."""

    def __init__(self, windows: list):
        words = _words(pa.array(windows, pa.large_string()))
        owner, bucket = (np.concatenate(x) for x in zip(*_grams(words)))
        order = np.argsort(owner, kind="stable")
        owner, self.bucket = owner[order], bucket[order]
        per_word, per_window = np.bincount(owner), np.diff(words.first)
        self.weight = (1.0 / (per_word * np.repeat(per_window, per_window))).astype(np.float32)[owner]
        self.first = np.concatenate([[0], np.cumsum(per_word)])[words.first]

    def take(self, windows: np.ndarray):
        size = np.diff(self.first)[windows]
        bounds = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(bounds[-1]) + np.repeat(self.first[windows] - bounds[:-1], size)
        return self.bucket[at], self.weight[at], bounds


def _fresh(random) -> dict:
    values = [random.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32), random.normal(0, 0.5, (DIM, 2)), np.zeros(2)]
    return {"values": values, "squares": [np.full_like(values[0], EASE), np.full_like(values[1], 1e-6), np.full_like(values[2], 1e-6)]}


def _descend(bags: _Bags, target: np.ndarray, state: dict, random) -> None:
    """Steps of AdaGrad on batches of windows; only embeddings that a batch holds move."""
    (embed, outer, bias), (embed2, outer2, bias2) = state["values"], state["squares"]
    for _ in range(STEPS):
        part = random.integers(0, len(target), BATCH)
        bucket, weight, bounds = bags.take(part)
        window = np.repeat(np.arange(BATCH), np.diff(bounds))
        hidden = sums(embed[bucket] * weight[:, None], bounds)
        logits = hidden @ outer + bias
        chance = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = chance / chance.sum(axis=1, keepdims=True)
        error[np.arange(BATCH), target[part]] -= 1
        error /= BATCH
        back = (error @ outer.T).astype(np.float32)
        used, place = np.unique(bucket, return_inverse=True)
        slope = np.stack([np.bincount(place, weight * back[window, k], len(used)) for k in range(DIM)], axis=1)
        embed2[used] += slope**2
        embed[used] -= RATE * slope / np.sqrt(embed2[used])
        for value, square, slope in ((outer, outer2, hidden.T @ error), (bias, bias2, error.sum(axis=0))):
            square += slope**2
            value -= RATE / 10 * slope / np.sqrt(square)


def _logit_table(state: dict) -> np.ndarray:
    embed, outer, bias = state["values"]
    return (embed @ (outer[:, 1] - outer[:, 0]) + bias[1] - bias[0]).astype(np.float32)


def _platt(logits: np.ndarray, truth: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make the truth likeliest, a little smoothed."""
    spread = max(logits.std(), 1e-6)
    x, middle = (logits - logits.mean()) / spread, logits.mean()
    a, b = 1.0, 0.0
    for _ in range(500):
        error = (1 / (1 + np.exp(-np.clip(a * x + b, -30, 30))) - truth) * weights / weights.sum()
        a, b = a - 1.0 * ((error * x).sum() + 1e-3 * a), b - 1.0 * error.sum()
    return a / spread, b - a * middle / spread


def train(texts: list, truth: np.ndarray, rates: tuple[float, float], seed: int = 0) -> Model:
    """The model of sample texts; ``rates`` are the numbers of all labels 0 and 1.

    Without texts of both classes every text scores the share of toxic labels (a half without labels).
    """
    share = (rates[1] + 0.5) / (sum(rates) + 1)
    if len(set(truth)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 1.0, float(np.log(share / (1 - share))))
    random = np.random.default_rng(seed)
    column = pc.fill_null(pa.array(texts, pa.large_string()), "")
    worded = np.array([bool(t and t.split()) for t in texts])
    taken = truth[worded]
    if len(set(taken)) < 2:
        return train([], taken, rates)
    logit, hard = _telling(column, truth), []
    for _ in range(ROUNDS):
        worst, _, others = _worst(column, logit, random)
        hard += [w for w, t in zip(worst, taken) if not t]
        toxic = [w for w, t in zip(worst, taken) if t]
        clean = [*hard, *(w for pair, t in zip(others, taken) if not t for w in pair)]
        # as many draws of toxic windows as of clean ones, about
        again = max(len(clean) // (2 * len(toxic)), 1)
        state = _fresh(random)
        _descend(_Bags(toxic * again + clean), np.repeat([1, 0], [len(toxic) * again, len(clean)]), state, random)
        logit = _logit_table(state)
    _, found, _ = _worst(column, logit, random)
    weights = np.where(taken > 0, rates[1] / max(taken.sum(), 1), rates[0] / max((1 - taken).sum(), 1))
    return Model(logit, *map(float, _platt(found, taken, weights)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    short = docs.select("doc_id", F.col("text").cast("string")).where(F.octet_length("text") <= LONGEST)
    rows = bounded(labelled(short, labels, label), labels, label, {0: sample, 1: sample}).toArrow().to_pandas()
    rows = rows.sort_values(["doc_id", "text", "label"])  # the order of arrival is chance
    counts = dict(labels.where(F.col(label).isNotNull()).groupBy((F.col(label) != 0).cast("int")).count().collect())
    return train(rows.text.to_list(), rows.label.to_numpy(float), (counts.get(0, 0), counts.get(1, 0)))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` in place of the text; a text without words scores zero."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            logits = np.concatenate([_text_logits(p, model.logit) for p in pieces(texts)] or [np.zeros(0)])
            chance = 1 / (1 + np.exp(-np.clip(model.slope * np.maximum(logits, -1e9) + model.shift, -40, 40)))
            yield pa.array(np.where(np.isfinite(logits), chance, 0.0), pa.float64())

    rest = [c for c in docs.columns if c != "text"]
    return docs.select(*rest, scored(F.col("text").cast("string")).alias("score")).selectExpr(
        "*", f"CAST(score >= {threshold} AS INT) AS predicted"
    )


def classify(docs: DataFrame, labels: DataFrame, trains, label: str = "toxic") -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs`` (doc_id, text).

    Labels are learned from rows where the column ``trains`` over doc_id holds. Texts that are empty or
    null score zero. Rows without doc_id are scored and never learned from; repeated rows stay; an empty
    table gives no rows; other columns are ignored.
    """
    model = fit(docs.where(trains), labels.where(trains), label)
    return score(docs.select("doc_id", "text"), model)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = held_out(F.col("doc_id"), 4, 2)
    found = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")
