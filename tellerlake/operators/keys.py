"""Surrogate keys and id ranges."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.functions import ids

# Hex digits of the digest that names a numbering bucket: 16 ** 3 = 4,096 buckets.
BUCKET_DIGITS = 3


def highest(table: DataFrame, key_column: str) -> Column:
    """Highest key in use, 0 for an empty table, as a scalar subquery of the enclosing frame."""
    return table.agg(F.expr(f"COALESCE(MAX({key_column}), 0L)")).scalar()


def number_rows(rows: DataFrame, natural_key: str, key_column: str, start: Column | None = None) -> DataFrame:
    """Give every row the next dense key after ``start``; the natural key must be unique.

    Rows are numbered inside digest buckets of equal expected size, on top of the running total
    of the bucket counts. The order (bucket, natural key) is a property of the data alone, so a
    retried or recomputed task hands out the same keys, and no task sees all the rows. The totals
    are at most 16 ** BUCKET_DIGITS rows, which bounds both the broadcast and their window.
    """
    digest = f"SUBSTRING(MD5(CAST({natural_key} AS BINARY)), 1, {BUCKET_DIGITS}) AS _bucket"
    offsets = (
        rows.groupBy(F.expr(digest))
        .agg(F.expr("COUNT(*) AS _size"))
        .selectExpr("_bucket", "SUM(_size) OVER (ORDER BY _bucket) - _size AS _offset")
    )
    numbered = (
        rows.drop(key_column)
        .selectExpr("*", digest)
        .join(F.broadcast(offsets), "_bucket")
        .selectExpr("*", f"ROW_NUMBER() OVER (PARTITION BY _bucket ORDER BY {natural_key}) + _offset AS {key_column}")
        .drop("_bucket", "_offset")
    )
    return numbered if start is None else numbered.withColumn(key_column, F.col(key_column) + start)


def assign_keys(rows: DataFrame, natural_key: str, key_column: str, taken: int = 0) -> DataFrame:
    """Number the rows whose key is still null, above the highest key; keyed rows pass unchanged.

    ``taken`` is the highest key ever given out, which rows that are not among these may hold. ``rows``
    is read several times, so callers pass a stored frame.
    """
    keyed = rows.filter(f"{key_column} IS NOT NULL")
    fresh = rows.filter(f"{key_column} IS NULL")
    start = F.greatest(highest(rows, key_column), F.lit(taken))
    numbered = number_rows(fresh, natural_key, key_column, start)
    return keyed.unionByName(numbered.select(*rows.columns))


def next_id_number(table: DataFrame, id_column: str) -> DataFrame:
    """One row: the number the next business id takes (1 for an empty table)."""
    return table.agg(F.expr(f"COALESCE(MAX({ids.id_number(id_column)}), 0L) + 1 AS next_number"))
