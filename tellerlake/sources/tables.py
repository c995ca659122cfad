"""Parquet tables of the layers.

Bronze and silver are plain directories. Gold tables are replaced or extended one committed version
at a time: a version is written to its own directory and becomes visible when its row is appended
to the ``commits`` table, so a run that dies half way leaves nothing behind that readers see, and
the path being read is never overwritten.
"""

import datetime
import logging

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tellerlake import schemas
from tellerlake.operators.dedup import absent_from
from tellerlake.session import empty_frame, path_exists, small_frame

log = logging.getLogger(__name__)

BRONZE_REJECTS = "rejects"

COMMITS = "table_name string, version long, batch_id string, n_rows long, max_key long, watermark date, source long"


def read_if_present(
    spark: SparkSession, path: str, schema: StructType | str | None = None, warn: bool = True
) -> DataFrame | None:
    """A Parquet table, or None, by default with a warning, when its directory does not exist."""
    if not path_exists(spark, path):
        if warn:
            log.warning("table not found, skipping: %s", path)
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_bronze(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All batches of a bronze table, ``date`` and ``batch`` taken from the directories."""
    return spark.read.schema(schemas.bronze_schema(table)).parquet(f"{root}/{table}")


def append_bronze(rows: DataFrame, root: str, table: str, batch_id: str) -> int | None:
    """Add one batch in a directory of its own under its ingestion date; returns its rows.

    A batch that is already there is left alone and gives None; its directory tells, no data is read for that.
    Day and batch are constants, and nothing stands between them and the write: Spark then sorts no rows by directory.
    The rows are counted from the files' footers.
    """
    path = f"{root}/{table}"
    batch = schemas.text_literal(batch_id)
    existing = read_if_present(rows.sparkSession, path, schemas.bronze_schema(table), warn=False)
    if existing is not None and not existing.filter(f"batch = {batch}").isEmpty():
        log.warning("batch %s of %s is already loaded", batch_id, table)
        return None
    rows.selectExpr("*", f"{batch} AS batch").write.mode("append").partitionBy("date", "batch").parquet(path)
    return read_bronze(rows.sparkSession, root, table).filter(f"batch = {batch}").count()


def store_rejects(rejects: DataFrame, root: str, batch_id: str) -> None:
    """Keep the malformed records of one raw table and batch, replacing those of an earlier attempt."""
    stamped = rejects.selectExpr("*", f"{schemas.text_literal(batch_id)} AS batch")
    write = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    write.partitionBy("table_name", "batch").parquet(f"{root}/{BRONZE_REJECTS}")


def append_new_ids(incoming: DataFrame, path: str, key: str | None = None, fresh: bool = False) -> int:
    """Add the rows whose key the table lacks; rows already there win. Returns how many were added.

    Without a key, or when starting ``fresh``, the table is replaced.
    """
    existing = None if fresh or key is None else read_if_present(incoming.sparkSession, path, warn=False)
    taken = Observation()
    if existing is not None:
        incoming = absent_from(incoming, existing, key)
    mode = "overwrite" if existing is None else "append"
    incoming.observe(taken, F.expr("COUNT(*) AS n_rows")).write.mode(mode).parquet(path)
    return taken.get["n_rows"]


def overwrite(
    df: DataFrame,
    path: str,
    *measures: str,
    partitions: tuple[str, ...] = (),
    hidden: tuple[str, ...] = (),
    dynamic: bool = False,
) -> dict:
    """Replace a table; returns its row count and further aggregates, taken during the write.

    ``measures`` are SQL aggregates with an alias and may use ``hidden`` columns, which are not
    written. ``dynamic`` replaces only the partitions that occur in ``df``.
    """
    taken = Observation()
    counted = df.observe(taken, F.expr("COUNT(*) AS n_rows"), *(F.expr(m) for m in measures)).drop(*hidden)
    writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)
    return taken.get


def balanced(df: DataFrame, *partitions: str) -> DataFrame:
    """Rows gathered by their output partition before a partitioned write.

    Adaptive execution splits large partitions and merges small ones, so each directory gets a few
    files of a good size instead of one per task.
    """
    return df.hint("rebalance", *partitions)


def commits(spark: SparkSession, root: str) -> DataFrame:
    found = read_if_present(spark, f"{root}/commits", COMMITS, warn=False)
    return empty_frame(spark, COMMITS) if found is None else found


def last_commit(spark: SparkSession, root: str, table: str) -> Row | None:
    """The newest committed version of a gold table."""
    mine = commits(spark, root).filter(f"table_name = '{table}'")
    return mine.orderBy(F.desc("version")).first()


def holds_batch(spark: SparkSession, root: str, table: str, batch_id: str) -> bool:
    """Whether any commit of the table, not only the last, is of the batch."""
    mine = commits(spark, root).filter(f"table_name = '{table}' AND batch_id = {schemas.text_literal(batch_id)}")
    return not mine.isEmpty()


def commit(
    spark: SparkSession,
    root: str,
    table: str,
    version: int,
    batch_id: str,
    n_rows: int = 0,
    max_key: int | None = None,
    watermark: datetime.date | None = None,
    source: int | None = None,
) -> None:
    """Make a version visible; ``source`` is the snapshot of the layer below that it was made from."""
    row = [(table, version, batch_id, n_rows, max_key, watermark, source)]
    small_frame(spark, row, COMMITS).write.mode("append").parquet(f"{root}/commits")


def read_version(spark: SparkSession, root: str, table: str, version: int, schema: StructType) -> DataFrame:
    """Exactly one version of a table that is replaced as a whole."""
    return spark.read.schema(schema).parquet(f"{root}/{table}/version={version}")


def read_up_to(spark: SparkSession, root: str, table: str, version: int, schema: StructType) -> DataFrame:
    """All versions up to one of a table that only grows; later, uncommitted ones are pruned."""
    stored = StructType([*schema.fields, StructField("version", LongType())])
    found = read_if_present(spark, f"{root}/{table}", stored, warn=False)
    if found is None:
        return empty_frame(spark, schema)
    return found.filter(f"version <= {version}").select(*schema.names)
