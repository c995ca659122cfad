"""Mixing sources to target weights by Pfair scheduling.

Documents of a component (a named source, or all others together) form blocks. A block gets a release
time and a deadline from its component's weight: block j of weight w may not come before slot floor(j/w)
and must come before slot ceil((j+1)/w). Earliest deadline first on one resource meets all of them, so
after any number of slots every component is less than one block away from its share.

Weights are whole shares of a period; the schedule repeats with it, so only one period is computed, on
the driver, of ``MOST_SLOTS`` at most. All else is arithmetic on a document's number in its component.
Every document comes once. A component that is used up leaves its slots empty, and the others go on in
their proportions.
"""

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tellerlake.llm.tables import table

MOST_SLOTS = 100_000
BUCKET_ROWS = 20_000
BLOCK_ROWS = 50
#: The component of all sources that have no share of their own, and of documents without source.
OTHER = ""
#: Shares of a thousand slots.
SHARES = {
    "src0": 200, "src1": 120, "src2": 100, "src3": 90, "src5": 80, "src8": 70, "src9": 60, OTHER: 280,
}


def period(shares: dict[str, int]) -> list[tuple[str, int, int]]:
    """(component, block, slot) over one period, earliest deadline first among the released blocks."""
    total = sum(shares.values())
    if not 0 < total <= MOST_SLOTS or min(shares.values()) < 0:
        raise ValueError(f"shares must be whole numbers from 0 on that add up to 1 to {MOST_SLOTS}")
    waiting = [(0, name, 0) for name, share in sorted(shares.items()) if share]
    ready: list[tuple[int, str, int]] = []
    slots = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, name, block = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(block + 1) * total // shares[name]), name, block))
        _, name, block = heapq.heappop(ready)
        slots.append((name, block, slot))
        if block + 1 < shares[name]:
            heapq.heappush(waiting, ((block + 1) * total // shares[name], name, block + 1))
    return slots


def mix(docs: DataFrame, shares: dict[str, int], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with ``component``, ``block``, ``release``, ``deadline``, ``slot`` and ``place`` in the block.

    Reading by (slot, place) gives the mixture. ``shares`` maps sources to whole numbers and must give
    ``OTHER`` one, so that every document has a component. Within a component documents come in the
    order of a hash of their id, or of their text if they have none; repeated rows each have a place. An
    empty table gives no rows. Columns of ``docs`` with the names above are replaced.
    """
    if not shares.get(OTHER):
        raise ValueError("documents of unnamed sources need a share")
    spark, total = docs.sparkSession, sum(shares.values())
    own = ["component", "block", "release", "deadline", "slot", "place"]
    docs = docs.drop(*own)
    named = [s for s, share in shares.items() if share]
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64(F.col("text").cast("string"))) \
        if "text" in docs.columns else F.xxhash64("doc_id")
    component = F.when(F.col("source").isin(named), F.col("source")).otherwise(F.lit(OTHER))
    buckets = -(-docs.count() // BUCKET_ROWS) or 1
    keyed = docs.withColumns({"component": component, "__key": key})
    keyed = keyed.withColumn("__bucket", F.pmod("__key", F.lit(buckets)).cast("int"))
    counts = keyed.groupBy("component", "__bucket").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy("component").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("component", "__bucket", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    turn = F.row_number().over(Window.partitionBy("component", "__bucket").orderBy("__key", "doc_id"))
    numbered = keyed.withColumn("__turn", turn).join(offsets, ["component", "__bucket"])

    number = F.col("__offset") + F.col("__turn") - 1
    share = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))[F.col("component")].cast("long")
    placed = numbered.withColumns({"__number": number, "__share": share}).selectExpr(
        "*", f"__number DIV {block_rows} AS block", f"CAST(__number % {block_rows} AS INT) AS place"
    )
    # one row for each slot of a period: MOST_SLOTS at most
    slots = F.broadcast(
        spark.createDataFrame(period(shares), "component string, __turn_block long, __slot long").withColumnRenamed(
            "component", "__component"
        )
    )
    found = placed.join(
        slots, (F.col("component") == F.col("__component")) & (F.col("block") % F.col("__share") == F.col("__turn_block"))
    )
    return found.selectExpr(
        *(f"`{c}`" for c in docs.columns),
        "component",
        "block",
        f"block * {total} DIV __share AS release",
        f"((block + 1) * {total} + __share - 1) DIV __share AS deadline",
        f"block DIV __share * {total} + __slot AS slot",
        "place",
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source"), SHARES)
