"""Line dedup by exact set-similarity join.

A line is the set of its words. Two lines match if the Jaccard similarity of their sets is at least 0.8,
and a line goes if any earlier line (by doc_id, then position) matches it.

Lines with equal sets meet first; what remains are distinct sets, each standing at its first line, so
copies never multiply. The words of a set are ordered by rarity, and only prefixes are posted: two sets
that match share a word of both prefixes. Pairs that meet at a word must pass the length filter, the
positional filter, and a parity filter: of 64 word classes (256 for long lines) a set keeps whether it
holds an odd number, and each class that differs stands for a word that only one set has. Pairs that
pass are verified on the words themselves.

One match is enough for a line to go, so a group of thousands of similar lines needs no pair of each two.
At its rarest common words, or at the commonest it posts if none is common, each set first meets a few leaders,
the earliest sets there; what matches one goes.
The join then leaves out pairs of which both are gone, which is all but a few of such a group's.

Rarity comes from counts of all words, added up in a fixed number of buckets. Any order keeps the join
exact; a bucket counted once proves that its word occurs nowhere else, and needs no posting. Texts move
only where a line of theirs must be verified or goes, as far as a table of flags of fixed size tells.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.llm.tables import discard, flagged, flags, may_hold, release, store, table, unpacked
from tellerlake.llm.words import mix, pieces, raw, words

#: Similarity as a fraction.
SIMILAR = (4, 5)
#: The table of rarities has a byte for each of so many buckets; with more words than buckets, rare words
#: look commoner than they are, and more pairs meet.
BUCKET_BITS = 22
#: Sets of fewer words match equal ones only, at a similarity of 0.8.
LEAST = 4
#: Longs of the wide parity, which sets from ``LONG`` words on have; sets up to ``SHORT`` have the narrow one.
#: Of two sets of similar size both have one of them.
WIDE = 4
LONG = 96
SHORT = 120
_WIDE = [f"wide{k}" for k in range(WIDE)]
#: Six levels a doubling: words that occur 512 times or more are common. A set meets the leaders, ``LEADERS`` a
#: word, of ``LED_BY`` common words, or of one other; which of them only decides how many pairs the join still
#: has to make.
LEVELS = 6
COMMON_LEVEL = LEVELS * 9
LEADERS = 8
LED_BY = 2


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def rarity(docs: DataFrame) -> np.ndarray:
    """A level from 0 to 255 for each bucket, higher for commoner words; 0 for words that occur once."""

    def count(batches):
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for piece in pieces(batch.column(0)):
                np.add.at(total, _buckets(words(piece).hashes()), 1)
        used = np.flatnonzero(total)
        for at in range(0, len(used), 100_000):
            some = used[at : at + 100_000]
            yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(count, "bucket int, n long")
    found = counted.groupBy("bucket").agg(F.sum("n").alias("n")).where("n > 1")
    level = F.least(F.floor(LEVELS * F.log2("n")), F.lit(255)).cast("short").alias("level")
    found = found.select("bucket", level).toArrow()
    levels = np.zeros(1 << BUCKET_BITS, np.uint8)  # what came is a row for each bucket at most
    levels[found.column("bucket").to_numpy()] = found.column("level").to_numpy()
    return levels


@dataclass
class _Lines:
    """The lines of a piece that have words: row, number, first and last byte, size, key, parity, where
    their prefixes lie, and how many common words end each."""

    row: np.ndarray
    line: np.ndarray
    start: np.ndarray
    end: np.ndarray
    size: np.ndarray
    key: np.ndarray
    parity: np.ndarray
    wide: list
    skip: np.ndarray
    prefix: np.ndarray
    first: np.ndarray
    common: np.ndarray


def _in_order(hashes: np.ndarray, level: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The order by group, level and hash, from one sort of all three packed where they fit."""
    if group[-1] < 1 << 24:
        packed = group.astype(np.uint64) << np.uint64(40) | level.astype(np.uint64) << np.uint64(32) | hashes >> np.uint64(32)
        order = np.argsort(packed)
        packed, sorted_ = packed[order], hashes[order]
        if not ((packed[1:] == packed[:-1]) & (sorted_[1:] != sorted_[:-1])).any():
            return order
    return np.lexsort((hashes, level, group))


def _lines(texts: pa.Array, levels: np.ndarray, narrow: bool = False) -> _Lines:
    found = words(texts)
    hashes, rows = found.hashes(), found.rows()
    breaks = np.concatenate([[0], np.cumsum(found.data == 10)])
    offsets = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
    line = breaks[found.start] - breaks[offsets[rows]]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (line[1:] != line[:-1])
    group = np.cumsum(fresh) - 1
    level = levels[_buckets(hashes)]
    order = _in_order(hashes, level, group) if len(group) else np.zeros(0, np.int64)
    hashes, level, group = hashes[order], level[order], group[order]
    once = np.ones(len(hashes), bool)
    once[1:] = (group[1:] != group[:-1]) | (hashes[1:] != hashes[:-1])
    hashes, level, group = hashes[once], level[once], group[once]
    begin = np.searchsorted(group, np.arange(fresh.sum() + 1))
    size = np.diff(begin)
    if not len(size):
        none = np.zeros(0, np.int64)
        return _Lines(*[none] * 7, [none] * WIDE, none, none.astype(np.int32), np.zeros(1, np.int64), none)
    key = mix(np.add.reduceat(mix(hashes ^ np.uint64(0xA5A5)), begin[:-1]) + size.astype(np.uint64)).view(np.int64)
    end = (found.start + found.length)[np.append(fresh[1:], True)]
    if narrow:
        return _Lines(rows[fresh], line[fresh], found.start[fresh], end, size, key, *[None] * 6)
    top, base = SIMILAR
    length = np.where(size >= LEAST, size - -(-top * size // base) + 1, 0)
    place = np.arange(len(hashes)) - np.repeat(begin[:-1], size)
    posted = (place < np.repeat(length, size)) & (level > 0)
    count = np.add.reduceat(posted, begin[:-1])
    common = np.add.reduceat(posted & (level >= COMMON_LEVEL), begin[:-1])
    mixed = mix(hashes)
    parity = np.bitwise_xor.reduceat(np.uint64(1) << (mixed >> np.uint64(58)), begin[:-1])
    place, bit = mixed >> np.uint64(50), np.uint64(1) << ((mixed >> np.uint64(44)) & np.uint64(63))
    wide = [
        np.bitwise_xor.reduceat(np.where(place % np.uint64(WIDE) == k, bit, np.uint64(0)), begin[:-1]).view(np.int64)
        for k in range(WIDE)
    ]
    parity[size > SHORT] = 0
    for part in wide:
        part[size < LONG] = 0
    return _Lines(
        rows[fresh], line[fresh], found.start[fresh], end, size, key, parity.view(np.int64), wide, length - count,
        hashes[posted].astype(np.uint32).view(np.int32), np.concatenate([[0], np.cumsum(count)]), common,
    )


def all_lines(docs: DataFrame, levels: np.ndarray, narrow: bool = False) -> DataFrame:
    """A row for each line of ``docs`` (doc_id, text_key, text) that has words; ``narrow`` without what
    the join needs. Words of the prefix are hashes of 32 bits: a clash costs a comparison, no more."""

    def cut(batches):
        for batch in batches:
            row = 0
            for piece in pieces(batch.column(2)):
                x = _lines(piece, levels, narrow)
                at = pa.array(row + x.row)
                row += len(piece)
                columns = {
                    "doc_id": batch.column(0).take(at),
                    "text_key": batch.column(1).take(at),
                    "line": pa.array(x.line.astype(np.int32)),
                    "set_key": pa.array(x.key),
                }
                if not narrow:
                    columns |= {
                        "n": pa.array(x.size.astype(np.int32)),
                        "parity": pa.array(x.parity),
                        **{f"wide{k}": pa.array(x.wide[k]) for k in range(WIDE)},
                        "skip": pa.array(x.skip.astype(np.int32)),
                        "prefix": pa.ListArray.from_arrays(pa.array(x.first.astype(np.int32)), pa.array(x.prefix)),
                        "common": pa.array(x.common.astype(np.int32)),
                    }
                yield pa.record_batch(columns)

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key long, line int, set_key long"
    wide = ", ".join(f"{w} long" for w in _WIDE)
    return docs.mapInArrow(
        cut, schema if narrow else f"{schema}, n int, parity long, {wide}, skip int, prefix array<int>, common int"
    )


def _overlap(one: str, two: str) -> str:
    """SQL: how many words similar sets of these sizes share at least."""
    top, base = SIMILAR
    return f"CEIL({top} * ({one}.n + {two}.n) / {top + base})"


def _may_match(one: str, two: str) -> str:
    """SQL: whether the length, positional and parity filters let a pair of postings pass."""
    top, base = SIMILAR
    overlap = _overlap(one, two)
    most = f"{one}.n + {two}.n - 2 * {overlap}"
    return (
        f"{top} * {one}.n <= {base} * {two}.n AND {top} * {two}.n <= {base} * {one}.n"
        f" AND LEAST({one}.place, {two}.place) + LEAST({one}.n - {one}.place, {two}.n - {two}.place) >= {overlap}"
        f" AND ({one}.n > {SHORT} OR {two}.n > {SHORT} OR BIT_COUNT({one}.parity ^ {two}.parity) <= {most})"
        f" AND ({one}.n < {LONG} OR {two}.n < {LONG} OR {_wide_apart(one, two)} <= {most})"
    )


def _wide_apart(one: str, two: str) -> str:
    return " + ".join(f"BIT_COUNT({one}.{w} ^ {two}.{w})" for w in _WIDE)


def _words_of(docs: DataFrame, levels: np.ndarray, asked: DataFrame) -> DataFrame:
    """(set_key, w): the distinct words of each set in ``asked`` (set_key), from some line that has them."""
    marks = flags(asked, "set_key")

    def cut(batches):
        found = unpacked(marks)
        for batch in batches:
            for piece in pieces(batch.column(0)):
                x, data = _lines(piece, levels, narrow=True), raw(piece)[0]
                keys, at = np.unique(x.key, return_index=True)
                hit = may_hold(keys, found)
                texts = [data[x.start[i] : x.end[i]].tobytes() for i in at[hit]]
                yield pa.record_batch([pa.array(keys[hit]), pa.array(texts, pa.binary()).cast(pa.string())], names=["set_key", "t"])

    lines = docs.select("text").mapInArrow(cut, "set_key long, t string").join(asked, "set_key", "left_semi")
    lines = lines.groupBy("set_key").agg(F.min("t").alias("t"))
    return lines.selectExpr("set_key", "ARRAY_DISTINCT(SPLIT(t, r'[ \\t\\x0B\\f\\r]+')) AS w")


def _similar(pairs: DataFrame, word_sets: DataFrame) -> DataFrame:
    """The stored pairs (later, earlier) whose sets are similar. Only words of sets in them move."""
    top, base = SIMILAR
    second = word_sets.selectExpr("set_key AS earlier", "w AS w2").join(pairs.select("earlier").distinct(), "earlier", "left_semi")
    both = pairs.join(word_sets.selectExpr("set_key AS later", "w AS w1"), "later").join(second, "earlier")
    return both.where(f"{top + base} * SIZE(ARRAY_INTERSECT(w1, w2)) >= {top} * (SIZE(w1) + SIZE(w2))").select("later", "earlier")


def _placed(met: DataFrame, sets: DataFrame) -> DataFrame:
    """Candidate pairs (one, two, apart) as stored pairs (later, earlier, apart)."""
    places = sets.select("set_key", "at")
    pairs = met.join(places.toDF("one", "at1"), "one").join(places.toDF("two", "at2"), "two")
    return store(pairs.selectExpr("IF(at1 > at2, one, two) AS later", "IF(at1 > at2, two, one) AS earlier", "apart"))


def _best(pairs: DataFrame) -> DataFrame:
    """Each later set with the candidate whose parities differ least, which nearly always matches."""
    return pairs.groupBy("later").agg(F.min(F.struct("apart", "earlier")).alias("b")).select("later", "b.earlier")


def _word_sets(pairs: DataFrame, docs: DataFrame, levels: np.ndarray) -> DataFrame:
    asked = store(pairs.select("later").union(pairs.select("earlier")).toDF("set_key").distinct())
    found = store(_words_of(docs, levels, asked))
    discard(asked)
    return found


def _led(sets: DataFrame, docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """(set_key) of sets that match a leader at a word of theirs; each is held against one."""
    posted = ["set_key", "at", "n", "parity", *_WIDE]
    ends = "SIZE(prefix) - GREATEST(common, 1)"
    tail = f"POSEXPLODE(SLICE(prefix, {ends} + 1, LEAST(GREATEST(common, 1), {LED_BY}))) AS (k, word)"
    postings = sets.where("SIZE(prefix) > 0").selectExpr(*posted, f"skip + {ends} AS before", tail)
    postings = postings.selectExpr("word", *posted, "before + k AS place")
    slot = F.pmod(F.xxhash64("set_key"), F.lit(LEADERS))
    first = F.min(F.struct("at", *(c for c in posted if c != "at"), "place")).alias("s")
    leaders = postings.groupBy("word", slot.alias("slot")).agg(first).select("word", "s.*")
    met = postings.alias("p").join(leaders.alias("o"), "word").where(f"o.at < p.at AND {_may_match('p', 'o')}")
    apart = f"BIT_COUNT(p.parity ^ o.parity) + {_wide_apart('p', 'o')} AS apart"
    best = store(_best(met.selectExpr("p.set_key AS later", "o.set_key AS earlier", apart)))
    release(docs.sparkSession)
    word_sets = _word_sets(best, docs, levels)
    led = store(_similar(best, word_sets).select(F.col("later").alias("set_key")))
    for used in (best, word_sets):
        discard(used)
    release(docs.sparkSession)
    return led


def _gone(met: DataFrame, led: DataFrame, sets: DataFrame, docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """(set_key) of the sets that match an earlier one: those led, and of candidate pairs (one, two, apart)
    all others. Only sets whose best candidate does not match meet their other candidates."""
    known = led.select(F.col("set_key").alias("later"))
    all_pairs = _placed(met, sets)
    pairs = store(all_pairs.join(known, "later", "left_anti"))
    release(docs.sparkSession)
    word_sets = _word_sets(pairs, docs, levels)
    best = store(_best(pairs))
    first = store(_similar(best, word_sets).select("later"))
    rest = pairs.join(first, "later", "left_anti").join(best, ["later", "earlier"], "left_anti")
    rest = store(rest.select("later", "earlier"))
    found = first.union(_similar(rest, word_sets).select("later").distinct()).union(known)
    gone = store(found.toDF("set_key"))
    for used in (all_pairs, pairs, word_sets, best, first, rest):
        discard(used)
    release(docs.sparkSession)
    return gone


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, text) of the rows that take part. The key tells rows apart that share an id."""
    text = F.col("text").cast("string")
    return docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64(text).alias("text_key"), text.alias("text"))


def later_matches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, lines) of each document that loses lines: the numbers, from 0, of those."""
    keyed = _keyed(docs)
    levels = rarity(keyed)
    at = F.struct("doc_id", "text_key", "line").alias("at")
    leader = F.min(F.struct(at, "n", "parity", *_WIDE, "skip", "prefix", "common")).alias("s")
    sets = store(all_lines(keyed, levels).groupBy("set_key").agg(leader).select("set_key", "s.*"))
    release(docs.sparkSession)
    led = _led(sets, keyed, levels)
    posted = ["set_key", "n", "parity", *_WIDE, "led"]
    posting = sets.where("SIZE(prefix) > 0").join(led.withColumn("led", F.lit(True)), "set_key", "left")
    postings = posting.selectExpr(*posted, "skip", "POSEXPLODE(prefix) AS (k, word)")
    postings = postings.selectExpr("word", *posted, "skip + k AS place")
    fresh = "p.set_key < o.set_key AND (p.led IS NULL OR o.led IS NULL)"
    met = postings.alias("p").join(postings.alias("o"), "word").where(f"{fresh} AND {_may_match('p', 'o')}")
    apart = f"BIT_COUNT(p.parity ^ o.parity) + {_wide_apart('p', 'o')} AS apart"
    gone = _gone(met.selectExpr("p.set_key AS one", "o.set_key AS two", apart).distinct(), led, sets, keyed, levels)
    standing = sets.join(gone.withColumn("gone", F.lit(True)), "set_key", "left").selectExpr("set_key", "at AS stands", "gone")
    lines = all_lines(keyed, levels, narrow=True)
    removed = lines.join(standing, "set_key").where("gone OR STRUCT(doc_id, text_key, line) != stands")
    out = store(removed.groupBy("doc_id", "text_key").agg(F.collect_set("line").alias("lines")))
    for used in (sets, led, gone):
        discard(used)
    return out


def drop_later(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` with the lines left out of the texts; rows and other columns as they were."""
    columns = docs.columns
    keyed = docs.withColumn("__key", F.xxhash64(F.col("text").cast("string")))
    marks = flags(removed, "text_key")
    touched = keyed.where(flagged("__key", marks)).drop("__key")
    gone = removed.selectExpr("doc_id AS __doc", "text_key AS __key", "lines AS __lines")
    same = (F.col("doc_id") == F.col("__doc")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__key"))
    joined = touched.join(gone, same, "left")
    kept = F.expr("ARRAY_JOIN(FILTER(SPLIT(text, '\n'), (t, i) -> NOT ARRAY_CONTAINS(__lines, i)), '\n')")
    text = F.when(F.col("__lines").isNull(), F.col("text")).otherwise(kept)
    changed = joined.withColumn("text", text).select(*(F.col(f"`{c}`") for c in columns))
    same = keyed.where(~flagged("__key", marks)).select(*(F.col(f"`{c}`") for c in columns))
    return changed.unionByName(same)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) without the lines that match an earlier one.

    Lines end at line breaks; those without words stay and match nothing. Documents that lose all lines
    have an empty text. Rows without doc_id or with a null text take no part and stay as they are. Equal
    rows with one doc_id are the same lines, so they don't remove one another's. An empty table stays
    empty. All columns stay.
    """
    return drop_later(docs, later_matches(docs))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = later_matches(docs)
    before = docs.withColumn("lines", F.size(F.split("text", "\n")))
    kept = drop_later(before, removed).select(
        "doc_id", "lines", F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).alias("lines_kept"),
        F.xxhash64("text").alias("text_hash"),
    )
    return kept
