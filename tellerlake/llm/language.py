"""Language identification of mixed texts: script ranges, then Viterbi over per-word scores.

Every word is scored under every language by its byte trigrams. Languages that the script of a word
rules out are no candidates for it. The best sequence of labels pays a penalty for each switch, so a
stray word does not break a span, and a passage in another language becomes a span of its own.

The trigram counts come from all labelled rows. Trigrams are hashed into a fixed number of buckets, so
what reaches the driver is bounded by languages times buckets.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.llm.tables import held_out, table
from tellerlake.llm.words import pieces, raw, split, sums

BUCKETS = 1 << 16
SWITCH_PENALTY = 12.0
SMOOTHING = 0.1
#: A language is a candidate for a script that holds this share of its words.
SCRIPT_SHARE = 0.001

#: Scripts by first code point, from the Unicode block chart.
SCRIPT_STARTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "burmese"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1780, "khmer"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "han"),
    (0x3130, "hangul"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"),
    (0xF900, "han"), (0xFB50, "arabic"), (0xFE00, "other"), (0x20000, "han"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, name in SCRIPT_STARTS))
_STARTS = np.array([at for at, _ in SCRIPT_STARTS])
_SCRIPT_OF_RANGE = np.array([SCRIPTS.index(name) for _, name in SCRIPT_STARTS])

#: Bytes outside words: all of ASCII but letters. Other bytes belong to letters, or to marks that no
#: language's trigrams know.
_GAP = np.ones(256, bool)
_GAP[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass
class Model:
    """``scores[bucket, k]`` is the log-probability of a trigram under language k; ``allowed[script, k]``
    whether language k is written in the script."""

    languages: list[str]
    scores: np.ndarray
    allowed: np.ndarray


def _scripts(words) -> np.ndarray:
    """The script of each word's first character beyond ASCII, or Latin."""
    data = words.data.astype(np.int64)
    wide = np.concatenate([np.flatnonzero(data >= 0xC0), [len(data)]])
    at = wide[np.searchsorted(wide, words.start)]
    found = np.flatnonzero(at < words.start + words.length)
    p, scripts = at[found], np.zeros(len(words.start), np.int64)
    lead, tail = data[p], [data[np.minimum(p + k, len(data) - 1)] & 0x3F for k in (1, 2, 3)]
    two, three = (lead & 0x1F) << 6 | tail[0], (lead & 0x0F) << 12 | tail[0] << 6 | tail[1]
    four = (lead & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]
    code = np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four))
    scripts[found] = _SCRIPT_OF_RANGE[np.searchsorted(_STARTS, code, "right") - 1]
    return scripts


def _trigrams(texts: pa.Array):
    """The words of a piece, the buckets of its trigrams, and where each word's trigrams begin.

    A word of n bytes has n trigrams, one around each byte; the bytes beside the word count as spaces.
    """
    data, offsets = raw(pc.utf8_lower(texts))
    words = split(data, offsets, _GAP)
    if not len(words.start):
        return words, np.zeros(0, np.int64), np.zeros(1, np.int64)
    row = np.zeros(len(data), bool)
    row[offsets[(offsets > 0) & (offsets < len(data))]] = True
    plain = np.where(_GAP[data], np.uint8(32), data).astype(np.uint32)
    before = np.concatenate([[np.uint32(32)], plain[:-1]])
    before[row] = 32
    after = np.concatenate([plain[1:], [np.uint32(32)]])
    after[np.flatnonzero(row) - 1] = 32
    mixed = (before | plain << np.uint32(8) | after << np.uint32(16)) * np.uint32(0x9E3779B1)
    inside = plain != 32
    first = np.concatenate([[0], np.cumsum(words.length)])
    return words, (mixed >> np.uint32(16))[inside].astype(np.int64), first


def fit(labelled: DataFrame) -> Model:
    """Count the trigrams and scripts of all rows of (text, lang) whose lang is not null."""

    def count(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).dictionary_encode()
            codes, row = langs.indices.to_numpy(), 0
            for piece in pieces(batch.column(0)):
                words, buckets, first = _trigrams(piece)
                of_word = codes[row + words.rows()]
                row += len(piece)
                scripts, of_gram = _scripts(words), np.repeat(of_word, words.length)
                for code in np.unique(of_word):
                    lang = langs.dictionary[int(code)].as_py()
                    total = counts.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                    total[:BUCKETS] += np.bincount(buckets[of_gram == code], minlength=BUCKETS)
                    total[BUCKETS:] += np.bincount(scripts[of_word == code], minlength=len(SCRIPTS))
        for lang, total in counts.items():
            slots = np.flatnonzero(total)
            yield pa.record_batch(
                [pa.array([lang] * len(slots), pa.string()), pa.array(slots), pa.array(total[slots])],
                names=["lang", "slot", "n"],
            )

    rows = labelled.where("lang IS NOT NULL").select("text", F.col("lang").cast("string"))
    counted = rows.mapInArrow(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    found = counted.toArrow().to_pandas()
    languages = sorted(found.lang.unique())
    counts = np.zeros((BUCKETS + len(SCRIPTS), len(languages)))
    counts[found.slot, [languages.index(x) for x in found.lang]] = found.n
    grams, scripts = counts[:BUCKETS] + SMOOTHING, counts[BUCKETS:]
    allowed = scripts > SCRIPT_SHARE * scripts.sum(axis=0)
    allowed[~allowed.any(axis=1)] = True
    return Model(languages, np.log(grams / grams.sum(axis=0)).astype(np.float32), allowed)


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word. ``first`` bounds the words of each text, as in ``Words``.

    All texts of a piece take their n-th word in the same step, the longest texts in front.
    """
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, length = first[:-1][order], length[order]
    longest = int(length[0]) if len(length) else 0
    live = np.searchsorted(-length, -np.arange(longest), "left")  # texts with more than t words
    best_from = np.zeros(len(scores), np.int16)
    switched = np.zeros(scores.shape, bool)
    prior = np.zeros((len(length), scores.shape[1]), np.float32)
    ends = np.zeros(len(length), np.int64)
    for t in range(longest):
        n = live[t]
        at, prior = begin[:n] + t, prior[:n]
        if t:
            top = prior.max(axis=1, keepdims=True) - np.float32(penalty)
            best_from[at] = prior.argmax(axis=1)
            switched[at] = leave = top > prior
            prior = np.where(leave, top, prior)
        prior = prior + scores[at]
        ends[:n] = prior.argmax(axis=1)
    labels, state = np.zeros(len(scores), np.int64), ends.copy()
    for t in range(longest - 1, -1, -1):
        n = live[t]
        at = begin[:n] + t
        labels[at] = state[:n]
        if t:
            state[:n] = np.where(switched[at, state[:n]], best_from[at], state[:n])
    return labels


def _scored(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of a column: their scores under each language, their lengths, and the rows' bounds."""
    scores, lengths, counts = [], [], []
    for piece in pieces(texts):
        words, buckets, first = _trigrams(piece)
        scripts = _scripts(words)
        candidates = np.flatnonzero(model.allowed[np.unique(scripts)].any(axis=0))
        found = np.full((len(words.start), len(model.languages)), -1e4, np.float32)
        found[:, candidates] = sums(model.scores[:, candidates][buckets], first)
        found[~model.allowed[scripts]] = -1e4
        scores.append(found)
        lengths.append(words.length)
        counts.append(np.diff(words.first))
    return np.concatenate(scores), np.concatenate(lengths), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def _identify(texts: pa.Array, model: Model, penalty: float) -> pa.StructArray:
    """The struct of ``identify`` for one piece."""
    if not model.languages:
        none, empty = pa.array([0.0] * len(texts)), pa.array([[]] * len(texts), pa.list_(pa.string()))
        return pa.StructArray.from_arrays(
            [pa.array(["und"] * len(texts)), none, empty, empty.cast(pa.list_(pa.int32()))], fields=list(_RESULT)
        )
    scores, lengths, first = _scored(texts, model)
    labels = viterbi(scores, first, penalty)
    count = len(model.languages)
    rows = np.repeat(np.arange(len(texts)), np.diff(first))
    weight = np.bincount(rows * count + labels, lengths, len(texts) * count).reshape(len(texts), count)
    lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
    names = np.array([*model.languages, "und"], object)
    score = np.where(lettered, weight.max(axis=1) / np.maximum(weight.sum(axis=1), 1), 0.0)
    opens = np.ones(len(labels), bool)
    opens[1:] = (labels[1:] != labels[:-1]) | (rows[1:] != rows[:-1])
    opens &= lettered[rows]
    spans = np.flatnonzero(opens)
    bounds = pa.array(np.searchsorted(spans, first), pa.int32())
    sizes = np.minimum(np.append(spans[1:], len(labels)), first[rows[spans] + 1]) - spans
    return pa.StructArray.from_arrays(
        [
            pa.array(names[np.where(lettered, weight.argmax(axis=1), -1)], pa.string()),
            pa.array(score, pa.float64()),
            pa.ListArray.from_arrays(bounds, pa.array(names[labels[spans]], pa.string())),
            pa.ListArray.from_arrays(bounds, pa.array(sizes, pa.int32())),
        ],
        fields=list(_RESULT),
    )


_RESULT = pa.struct(
    [
        ("lang_pred", pa.string()),
        ("score", pa.float64()),
        ("span_langs", pa.list_(pa.string())),
        ("span_words", pa.list_(pa.int32())),
    ]
)


def identify(docs: DataFrame, model: Model, penalty: float = SWITCH_PENALTY, into: str = "__language") -> DataFrame:
    """``docs`` with one more column: struct<lang_pred, score, span_langs, span_words>.

    ``lang_pred`` holds most letters of the text, ``score`` is its share of them; the two lists give the
    languages and lengths, in words, of the spans in order. A text that is null or has no letter gets
    ``und``, zero and no spans, as does every text if nothing was learned. Ties go to the first language
    by name. Rows, other columns and repeated rows stay as they are.
    """
    @F.arrow_udf("lang_pred string, score double, span_langs array<string>, span_words array<int>")
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        size = (64 << 20) // max(4, len(model.languages))
        for texts in batches:
            done = [_identify(piece, model, penalty) for piece in pieces(texts, size)]
            yield pa.concat_arrays(done) if done else pa.array([], _RESULT)

    return docs.withColumn(into, label(F.col("text").cast("string")))


def learned(docs: DataFrame) -> Model:
    """The model of the rows of documents that are not held out. Without doc_id a row's remainder is unknown, so
    that it may be held out: nothing is learned from it."""
    return fit(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 5, 0)).select("text", "lang"))


def with_language(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text has no letter, ``lang`` filled in where it is null.

    A text that is null, empty or without a letter has no language and goes, whatever was learned. Where ``lang`` is
    null, the language that holds most of the text takes its place; if nothing was learned it stays null. Stated
    languages stay as they are, repeated rows stay repeated, an empty table stays empty, texts of any length are read
    whole, and all columns stay, whatever their names.
    """
    found = _free_name(docs, "__language")
    rows = identify(docs.where(F.col("text").cast("string").rlike(r"\p{L}")), learned(docs), into=found)
    told = F.nullif(F.col(f"{found}.lang_pred"), F.lit("und")).cast(docs.schema["lang"].dataType)
    return rows.withColumn("lang", F.coalesce(F.col("lang"), told)).select(*(F.col(f"`{c}`") for c in docs.columns))


def _free_name(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learned(docs)
    found = identify(docs.select("doc_id", "text", held_out(F.col("doc_id"), 5, 0).alias("held_out")), model)
    return found.select("doc_id", "held_out", "__language.*")
