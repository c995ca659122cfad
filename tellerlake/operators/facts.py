"""Transaction facts: incremental selection, key resolution and keys of their own."""

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake import schemas
from tellerlake.functions import calendar
from tellerlake.operators.dedup import absent_from
from tellerlake.operators.scd import Load, current_rows
from tellerlake.schemas import day_literal, text_literal, time_literal

# The watermark of an empty fact table (fixed value).
BEGINNING = datetime.date(1900, 1, 1)


def watermark(fact: DataFrame) -> DataFrame:
    """One row: the latest loaded transaction date, or the beginning of time for an empty table."""
    return fact.agg(F.expr(f"COALESCE(MAX(transaction_date), {day_literal(BEGINNING)}) AS watermark"))


def newer_than(transactions: DataFrame, day: datetime.date) -> DataFrame:
    """Rows dated after ``day``.

    The day is a literal, so it reaches the Parquet scan; the condition on the year and month
    columns, which follows from it, prunes directories of the partitioned silver table.
    """
    newer = f"transaction_date > {day_literal(day)}"
    if {"transaction_year", "transaction_month"} <= set(transactions.columns):
        newer += f""" AND (transaction_year > {day.year}
            OR (transaction_year = {day.year} AND transaction_month >= {day.month}))"""
    return transactions.filter(newer)


def not_yet_loaded(
    transactions: DataFrame, fact: DataFrame, late: str, day: datetime.date | None = None
) -> DataFrame:
    """The rows an incremental load takes.

    ``late="drop"`` takes what is dated after the watermark ``day``; rows that arrive late are
    lost. ``late="anti_join"`` takes every transaction id the fact table lacks, so late rows are
    kept and a repeated load adds nothing. Neither takes rows without a date.
    """
    if late == "drop":
        if day is None:
            day = watermark(fact).first().watermark
        return newer_than(transactions, day)
    if late == "anti_join":
        return absent_from(transactions.filter("transaction_date IS NOT NULL"), fact, "transaction_id")
    raise ValueError(f"unknown late mode: {late}")


# Where an incoming row goes: into the table, or why not.
LOAD, KNOWN, UNDATED, LATE = "load", "known", "undated", "late"


def routed(transactions: DataFrame, known: DataFrame, late: str, day: datetime.date) -> DataFrame:
    """Every incoming row with its ``route``; ``known`` holds the ids that are loaded.

    Rows without a date are undated. With ``late="drop"`` those up to the watermark ``day`` that are not loaded are
    late; with ``late="anti_join"`` they load like all others.
    """
    if late not in ("drop", "anti_join"):
        raise ValueError(f"unknown late mode: {late}")
    too_late = f"transaction_date <= {day_literal(day)}" if late == "drop" else "FALSE"
    ids = known.selectExpr("transaction_id AS _known")
    return (
        transactions.join(ids, F.expr("transaction_id = _known"), "left")
        .withColumn(
            "route",
            F.expr(f"""CASE WHEN _known IS NOT NULL THEN '{KNOWN}' WHEN transaction_date IS NULL THEN '{UNDATED}'
                WHEN {too_late} THEN '{LATE}' ELSE '{LOAD}' END"""),
        )
        .drop("_known")
    )


def rejected(rows: DataFrame, load: Load) -> DataFrame:
    """Rows that are not loaded, as they were staged, with the reason."""
    return schemas.conform(
        rows,
        schemas.FACT_REJECTS,
        reason="route",
        dw_loaded_at=time_literal(load.loaded_at),
        dw_batch_id=text_literal(load.batch_id),
    )


def staged(transactions: DataFrame) -> DataFrame:
    """The staged columns with the types of the fact table.

    Money is rounded here, once, and an empty text counts as missing, as in a bulk load.
    """
    texts = [f.name for f in schemas.STAGED_TRANSACTION.fields if f.dataType.simpleString() == "string"]
    return schemas.conform(
        transactions, schemas.STAGED_TRANSACTION, **{name: f"NULLIF({name}, '')" for name in texts}
    )


def _spread(column: str) -> str:
    """The column with nulls replaced by texts that match nothing, so that they do not share a task."""
    return f"COALESCE({column}, CONCAT(CHR(1), transaction_id))"


def _account_lookup(dim_accounts: DataFrame, versions: str) -> tuple[DataFrame, str]:
    """The account rows to match and the condition that ties a transaction to one of them."""
    columns = ["account_id", "account_key", "customer_key", "branch_key"]
    same_account = f"{_spread('account_id')} = _a_account_id"
    if versions == "current":
        rows = current_rows(dim_accounts)
    elif versions == "as_of":
        rows = dim_accounts
        columns += ["scd_start_date", "scd_end_date"]
        same_account += (
            " AND transaction_date >= _a_scd_start_date"
            " AND (_a_scd_end_date IS NULL OR transaction_date < _a_scd_end_date)"
        )
    else:
        raise ValueError(f"unknown versions mode: {versions}")
    return rows.selectExpr(*(f"{name} AS _a_{name}" for name in columns)), same_account


def resolve_keys(
    transactions: DataFrame,
    dim_accounts: DataFrame,
    dim_merchants: DataFrame,
    dim_types: DataFrame,
    dim_branches: DataFrame,
    load: Load,
    versions: str = "current",
) -> DataFrame:
    """Staged rows with the surrogate keys of their dimensions; unmatched keys stay null.

    The account join comes first and shuffles on ``account_id``; both its inputs are plain
    exchanges, the shape in which adaptive execution splits the partition of a hot account. The
    other lookups carry no hint: Spark broadcasts those whose size allows it. ``versions="as_of"``
    takes the account version valid on the transaction date instead of the current one.
    """
    lookup, same_account = _account_lookup(dim_accounts, versions)
    merchant = dim_merchants.selectExpr("merchant_id AS _m_id", "merchant_key")
    kind = dim_types.selectExpr("txn_type_name AS _t_name", "txn_type_key")
    branch = dim_branches.select("branch_key")
    joined = (
        staged(transactions)
        .join(lookup, F.expr(same_account), "left")
        .join(merchant, F.expr(f"{_spread('merchant_id')} = _m_id"), "left")
        .join(kind, F.expr("transaction_type = _t_name"), "left")
        .join(branch, F.expr("_a_branch_key = branch_key"), "left")
    )
    return schemas.conform(
        joined,
        schemas.FACT_TRANSACTIONS,
        transaction_key="NULL",
        date_key=calendar.date_key("transaction_date"),
        account_key="_a_account_key",
        customer_key="_a_customer_key",
        dw_loaded_at=time_literal(load.loaded_at),
        dw_batch_id=text_literal(load.batch_id),
    )


def with_written_keys(rows: DataFrame, key_column: str, start: int) -> DataFrame:
    """Unique keys above ``start`` without a shuffle, for a frame that is written exactly once.

    The key is the position of the row in its write task, which costs nothing at any size but
    exists only in the written files: read the keys back from there, never recompute them.
    """
    return rows.withColumn(key_column, F.expr(f"{start + 1}L + MONOTONICALLY_INCREASING_ID()"))
