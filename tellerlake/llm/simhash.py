"""SimHash near-duplicates: meet-in-the-middle ball hashing.

Two fingerprints at most 2r bits apart have a common variant at most r bits from each. Every distinct
fingerprint therefore emits its variants, equal variants meet in a shuffle, and what met is verified.
Distinct fingerprints around one variant are few (65 for r = 1), whatever the data: no group is large.
Copies share a fingerprint, so they never multiply.
"""

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tellerlake.llm.components import connected
from tellerlake.llm.tables import store, table

BITS = 64
SEED = 42


def fingerprint(text: bytes, words: int) -> int:
    """The SimHash of one text, as a signed 64-bit number."""
    tokens = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = list(itertools.accumulate(len(t) + 1 for t in tokens))
    starts = [0, *ends[:-1]]
    last = max(len(tokens) - words + 1, 1)
    stops = (e - 1 for e in ends[min(words, len(tokens)) - 1 :])
    pieces = map(joined.__getitem__, map(slice, starts[:last], stops))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, itertools.repeat(SEED)), np.uint64, last)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, last, 100_000):
        bits = np.unpackbits(hashes[at : at + 100_000].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > last, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; a text that is null or has no word gets zero."""

    def prints(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            found = [0 if t is None else fingerprint(t, words) for t in (x.as_py() for x in texts)]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(prints, f"doc_id {kind}, fp long")


def _masks(radius: int) -> list[int]:
    """Every way to flip up to ``radius`` of the bits, as signed numbers."""
    flips = (c for r in range(radius + 1) for c in itertools.combinations(range(BITS), r))
    return [m - (1 << BITS) * (m >> (BITS - 1)) for m in (sum(1 << i for i in c) for c in flips)]


def links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """(fp, root) edges that connect exactly the fingerprints connected by links of ``distance`` bits.

    Around one variant each member is linked with the smallest fingerprint there that it verifies
    against. For an even distance, all members of a variant's ball are within the distance of one
    another, so one root a ball loses no connection. An odd distance d emits the ball of (d + 1) / 2
    from one side and of (d - 1) / 2 from the other, and each meeting is verified by itself.
    """
    inner, outer = distance // 2, (distance + 1) // 2
    distinct = prints.select("fp").distinct()

    def ball(radius):
        masks = F.explode(F.array(*map(F.lit, _masks(radius)))).alias("mask")
        return distinct.select("fp", masks).selectExpr("fp", "fp ^ mask AS variant")

    if inner == outer:
        met = ball(inner).withColumn("root", F.min("fp").over(Window.partitionBy("variant")))
    else:
        met = ball(outer).join(ball(inner).withColumnRenamed("fp", "root"), "variant")
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("root"))) <= distance
    return met.where((F.col("fp") != F.col("root")) & close).select("fp", "root").distinct()


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that links of ``distance`` bits or fewer reach. Repeated
    rows stay repeated. Texts without a word have fingerprint zero and are linked like any other. A row
    without doc_id links others, but can't name a group: a group of such rows only has a null one. An
    empty table gives no rows; other columns of ``docs`` are ignored.
    """
    prints = store(fingerprints(docs, words))
    groups = connected(links(prints, distance)).toDF("fp", "component")
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = store(first.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp")))
    least = named.where("component != fp OR first IS NOT NULL").groupBy("component")
    least = least.agg(F.min("first").alias("component_id"))
    of_print = named.join(least, "component", "left").select("fp", "component_id")
    return prints.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest doc_id; columns unchanged.

    Of repeated rows with that id one stays. Rows without an id can't be named by a group and stay.
    """
    found = near_duplicates(docs, words, distance)
    first = found.where("doc_id = component_id").selectExpr("doc_id AS _first").distinct()
    named = docs.where("doc_id IS NOT NULL").join(first, F.col("doc_id") == F.col("_first"), "left_semi")
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy("doc_id"))
    one = named.withColumn("_turn", turn).where("_turn = 1").drop("_turn")
    return one.unionByName(docs.where("doc_id IS NULL"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, distance=2)
