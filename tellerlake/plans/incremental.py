"""Silver transactions, facts' feed and account snapshots kept up to date batch by batch.

A merge reads the bronze batches that no commit has taken, the key blocks that their ids fall in, and the months that
they change. Nothing else is read or written, so a day costs what arrived on it, not what came before.
"""

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tellerlake import schemas
from tellerlake.functions import bands
from tellerlake.operators import changes, silver
from tellerlake.session import empty_frame, materialise
from tellerlake.sources import slices, tables
from tellerlake.sources.slices import Run

log = logging.getLogger(__name__)

TRANSACTIONS, KEYS, CHANGES = "transactions", "transaction_keys", "transaction_changes"
SORTED_BY = ("account_id", "transaction_date", "transaction_time")


def _typed(spark: SparkSession) -> DataFrame:
    """Typed transactions of an empty bronze table, for their schema."""
    return silver.typed_transactions(empty_frame(spark, schemas.bronze_schema("transactions")))


def stored_schema(spark: SparkSession) -> StructType:
    empty = _typed(spark)
    kinds = {"daily_txn_count": "BIGINT", "daily_spend_total": schemas.MONEY.simpleString()}
    velocity = (f"CAST(NULL AS {kind}) AS {name}" for name, kind in kinds.items())
    return silver.flagged(empty).selectExpr("*", *velocity).schema


def read_transactions(
    spark: SparkSession, root: str, only: list[str] | None = None, snapshot: int | None = None
) -> DataFrame:
    """Silver transactions, of all months or some: rows without a positive amount are kept for velocity only."""
    return slices.read(spark, root, TRANSACTIONS, stored_schema(spark), only, snapshot).filter("amount > 0")


def read_changes(spark: SparkSession, root: str, snapshot: int) -> DataFrame:
    """What the run of that snapshot changed."""
    schema = empty_frame(spark, changes.CHANGE_COLUMNS).schema
    return slices.read(spark, root, CHANGES, schema, [str(snapshot)], snapshot)


def changed_transactions(spark: SparkSession, root: str, since: int, now: int) -> DataFrame:
    """Silver transactions, as of snapshot ``now``, that snapshots after ``since`` added or changed."""
    found = [read_changes(spark, root, number) for number in range(since + 1, now + 1)]
    if not found:
        return read_transactions(spark, root, only=[])
    changed = reduce(DataFrame.union, found)
    rows = read_transactions(spark, root, _values(changed, "month"), now)
    return rows.join(changed.select("transaction_id").distinct(), "transaction_id", "left_semi")


def _values(df: DataFrame, *columns: str) -> list[str]:
    """Distinct values of slice columns: as many as there are slices."""
    return sorted({row[0] for c in columns for row in df.select(c).distinct().collect() if row[0] is not None})


def merge_transactions(
    spark: SparkSession,
    bronze: str,
    root: str,
    batch_id: str,
) -> dict[str, int]:
    """Merge the bronze batches that are not in yet into the silver table; returns rows added and changed.

    The result has the rows of a full rebuild. Copies that say what the held row says leave it alone, lineage
    included. Batches must come in order of ingestion: one older than what is merged makes the table be rebuilt.
    """
    if slices.holds(spark, root, batch_id):
        log.info("batch %s is already merged", batch_id)
        return {"inserted": 0, "updated": 0}
    taken, mark = slices.batches(spark, root)
    found = tables.read_if_present(spark, f"{bronze}/{TRANSACTIONS}", schemas.bronze_schema(TRANSACTIONS))
    if found is None:
        return {"inserted": 0, "updated": 0}
    # On the directories' column: the files of batches that were taken are not listed for the scan.
    pending = found.filter(~F.col("batch").isin(sorted(taken))) if taken else found
    span = pending.agg(F.expr("MIN(_ingestion_ts) AS low"), F.expr("MAX(_ingestion_ts) AS high")).first()
    names = _values(pending, "batch")
    rebuild = mark is not None and span.low is not None and span.low <= mark
    if rebuild:
        log.warning("batches %s are older than what is merged: rebuilding", names)
        pending = found

    run = Run(spark, root, batch_id)
    staged = f"{root}/staging"
    incoming = materialise(changes.with_digest(silver.typed_transactions(pending)), f"{staged}/incoming")
    blocks = _values(incoming.selectExpr(f"{changes.block_of()} AS block"), "block")
    key_schema = empty_frame(spark, changes.KEY_COLUMNS).schema
    only = [] if rebuild else blocks
    held = slices.read(spark, root, KEYS, key_schema, only)
    changed = materialise(changes.changes(incoming, held), f"{staged}/changed")
    declined = F.expr(f"COUNT_IF({bands.is_declined('status')}) AS declined")
    counts = changed.groupBy("outcome").agg(F.expr("COUNT(*) AS n_rows"), declined).collect()
    counted = {row.outcome: row.n_rows for row in counts}
    if counted:
        rate = sum(row.declined for row in counts) / sum(counted.values()) * 100
        log.info("%s: %s, declined %.1f%%", batch_id, counted, rate)

    typed_columns = _typed(spark).columns
    if counted or rebuild:
        months = _values(changed, "month", "old_month")
        if rebuild:
            months = sorted({*months, *slices.current(spark, root, TRANSACTIONS)})
            blocks = sorted({*blocks, *slices.current(spark, root, KEYS)})
        stored = slices.read(spark, root, TRANSACTIONS, stored_schema(spark), [] if rebuild else months)
        rows = changes.merged(stored, changed, typed_columns)
        run.replace(rows, TRANSACTIONS, changes.month_of(), months, SORTED_BY)
        touched = blocks if rebuild else _values(changed.selectExpr(f"{changes.block_of()} AS block"), "block")
        keys = changes.merged_keys(slices.read(spark, root, KEYS, key_schema, [] if rebuild else touched), changed)
        run.replace(keys, KEYS, changes.block_of(), touched)
        columns = [part.split()[0] for part in changes.CHANGE_COLUMNS.split(", ")]
        run.replace(changed.select(*columns), CHANGES, f"'{run.snapshot}'", [])
    run.commit(mark=max(filter(None, (span.high, mark)), default=None), taken=names)
    return {"inserted": counted.get(changes.NEW, 0), "updated": counted.get(changes.CHANGED, 0)}
