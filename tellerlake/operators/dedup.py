"""Keep one row per key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most significant first; together they order every copy of a row (fixed values).
RECENCY = ("_ingestion_ts", "_batch_id", "_source_file", "_source_row_number")


def latest_by_key(df: DataFrame, key: str) -> DataFrame:
    """The most recently ingested row of each non-null key.

    Filtering ``row_number`` to 1 lets Spark keep only one row per key in every map task before
    the shuffle, so a key with very many copies sends one row per task, not all of them. The hash
    in front changes no group: business ids share their first bytes, on which Spark's sort
    compares first, and a hash tells them apart there.
    """
    order = ", ".join(f"{name} DESC NULLS LAST" for name in RECENCY if name in df.columns)
    return (
        df.filter(f"{key} IS NOT NULL")
        .withColumn("_copy", F.expr(f"ROW_NUMBER() OVER (PARTITION BY XXHASH64({key}), {key} ORDER BY {order})"))
        .filter("_copy = 1")
        .drop("_copy")
    )


def absent_from(incoming: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key the existing table lacks; existing rows win."""
    return incoming.join(existing.select(key), key, "left_anti")


def append_new(incoming: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Existing rows followed by the incoming rows with new keys."""
    return existing.unionByName(absent_from(incoming, existing, key), allowMissingColumns=True)
