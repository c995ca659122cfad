"""What a batch changes in a table that keeps the latest copy of each key, and what follows for its days."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.functions import ids
from tellerlake.operators import silver
from tellerlake.operators.velocity import day_totals, with_totals

#: Ids of one block of the key table: what a lookup of any one of them reads.
BLOCK_IDS = 1 << 20
#: Blocks of ids that end in no number.
OTHER_BLOCKS = 1024

NEW, CHANGED = "new", "changed"
LINEAGE = ("_ingestion_ts", "_batch_id")
KEY_COLUMNS = "transaction_id string, digest string, month string, account_id string, transaction_date date"
CHANGE_COLUMNS = (
    "transaction_id string, outcome string, month string, account_id string, transaction_date date,"
    " old_month string, old_account_id string, old_transaction_date date"
)


def month_of(day: str = "transaction_date") -> str:
    """Slice of a dated row."""
    return f"COALESCE(DATE_FORMAT({day}, 'yyyy-MM'), 'undated')"


def block_of(key: str = "transaction_id") -> str:
    """Slice of an id: ids are handed out in order, so those of a batch share a few blocks."""
    number = ids.id_number(key)
    other = f"CONCAT('x', PMOD(XXHASH64({key}), {OTHER_BLOCKS}))"
    return f"COALESCE(CAST({number} DIV {BLOCK_IDS} AS STRING), {other})"


def with_digest(typed: DataFrame) -> DataFrame:
    """Add a digest of all that a row says; how it arrived is no part of that."""
    said = ", ".join(name for name in typed.columns if name not in LINEAGE)
    return typed.withColumn("digest", F.expr(f"MD5(TO_JSON(STRUCT({said})))"))


def changes(incoming: DataFrame, held: DataFrame) -> DataFrame:
    """Incoming rows (typed, one a key, with digest) that are new or say something else than the one held.

    ``held`` has the columns of the key table. Rows that say the same are left out: they keep their first lineage.
    """
    old = held.selectExpr(
        "transaction_id AS _id", "digest AS _digest", "month AS old_month", "account_id AS old_account_id",
        "transaction_date AS old_transaction_date",
    )
    outcome = f"IF(_id IS NULL, '{NEW}', '{CHANGED}')"
    return (
        incoming.join(old, F.expr("transaction_id = _id"), "left")
        .filter("_id IS NULL OR digest <> _digest")
        .withColumn("outcome", F.expr(outcome))
        .withColumn("month", F.expr(month_of()))
        .drop("_id", "_digest")
    )


def touched_days(changed: DataFrame) -> DataFrame:
    """The accounts and days whose rows changed: where a row is now, and where it was."""
    now = changed.select("account_id", "transaction_date")
    before = changed.filter(f"outcome = '{CHANGED}'").selectExpr(
        "old_account_id AS account_id", "old_transaction_date AS transaction_date"
    )
    return now.union(before).distinct()


def same_day(days: DataFrame) -> tuple[DataFrame, object]:
    """``days`` with names of their own, and the condition that ties a row to one of them."""
    named = days.selectExpr("account_id AS _on_account", "transaction_date AS _on_day")
    return named, F.expr("account_id <=> _on_account AND transaction_date <=> _on_day")


def merged(stored: DataFrame, changed: DataFrame, typed_columns: list[str]) -> DataFrame:
    """The rows of the touched slices after the batch, rows without a positive amount included.

    ``stored`` are the slices before it. Velocity is counted anew for the touched accounts and days only; all other
    rows keep theirs, and no shuffle moves them where the touched days are few enough to broadcast.
    """
    gone = changed.filter(f"outcome = '{CHANGED}'").select("transaction_id")
    fresh = silver.flagged(changed.select(*typed_columns)).selectExpr(
        "*", "CAST(NULL AS BIGINT) AS daily_txn_count", "CAST(NULL AS DECIMAL(15,2)) AS daily_spend_total"
    )
    rows = stored.join(gone, "transaction_id", "left_anti").select(*fresh.columns).union(fresh)
    days, on_same_day = same_day(touched_days(changed))
    totals = day_totals(rows.join(days, on_same_day, "left_semi"))
    return with_totals(rows, totals).select(*fresh.columns)


def merged_keys(held: DataFrame, changed: DataFrame) -> DataFrame:
    """The key table's touched blocks after the batch."""
    columns = ("transaction_id", "digest", "month", "account_id", "transaction_date")
    mine = changed.select(*columns)
    return held.join(mine.select("transaction_id"), "transaction_id", "left_anti").select(*columns).union(mine)
