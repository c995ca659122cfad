"""Connected components by alternating large and small stars.

Kiveris et al., Connected Components in MapReduce and Beyond (2014). Each round hangs every node below
the smallest node it can see; the edges become stars in a number of rounds that grows with the
logarithm of the graph. Minima are aggregated before they move, and the joins are plain, so adaptive
execution splits a node with very many neighbours.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.llm.tables import discard, store


def _large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour above a node moves to the smallest node around it."""
    around = edges.union(edges.selectExpr("low AS high", "high AS low")).toDF("node", "other")
    least = around.groupBy("node").agg(F.min("other").alias("least"))
    moved = around.where("other > node").join(least, "node")
    return moved.selectExpr("other AS high", "LEAST(node, least) AS low").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its lower neighbours move to the smallest of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    moved = edges.join(least, "high").where("low > least").selectExpr("low AS high", "least AS low")
    return moved.union(least.selectExpr("high", "least AS low")).distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node reachable.

    Loops, repeated and reversed edges are allowed; edges with a null end are left out; no edges give
    no rows.
    """
    a, b = edges.columns
    edges = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
    now = store(edges.distinct())
    before, signature = None, _signature(now)
    while signature != before:
        after = store(_small_star(_large_star(now)))
        discard(now)
        now, before, signature = after, signature, _signature(after)
    roots = now.selectExpr("low AS node", "low AS component").distinct()
    return now.selectExpr("high AS node", "low AS component").union(roots)
