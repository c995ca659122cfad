"""Integrity counts and data-quality results."""

import datetime
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake import schemas
from tellerlake.schemas import time_literal
from tellerlake.session import small_frame


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key the parent lacks; a null key has no parent either."""
    return child.join(parent.select(key), key, "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row: how many child rows have no parent. Only one row per key is shuffled to the join."""
    per_key = child.groupBy(key).agg(F.expr("COUNT(*) AS n"))
    return orphans(per_key, parent, key).agg(F.expr("COALESCE(SUM(n), 0L) AS n_orphans"))


def decline_rate(transactions: DataFrame) -> DataFrame:
    """One row: totals and the share of declined transactions in percent, in a single pass."""
    return transactions.agg(
        F.expr("COUNT(*) AS total"),
        F.expr("COUNT_IF(is_completed) AS completed"),
        F.expr("COUNT_IF(is_declined) AS declined"),
    ).selectExpr("*", "declined / GREATEST(total, 1) * 100 AS decline_rate_pct")


@dataclass(frozen=True)
class RowCheck:
    """A check that looks at one row at a time: the SQL in ``fails`` is true on the bad ones."""

    name: str
    kind: str
    fails: str
    severity: str = "warning"


def not_null(column: str, severity: str = "critical") -> RowCheck:
    return RowCheck(f"{column}_not_null", "not_null", f"{column} IS NULL", severity)


def fits_width(column: str, width: int) -> RowCheck:
    return RowCheck(f"{column}_width", "width", f"LENGTH({column}) > {width}")


def fits_type(column: str, data_type: str) -> RowCheck:
    """The value survives the cast to the type it is stored as."""
    lost = f"{column} IS NOT NULL AND TRY_CAST({column} AS {data_type}) IS NULL"
    return RowCheck(f"{column}_precision", "precision", lost)


def agrees(column: str, expected: str) -> RowCheck:
    """A delivered column equals what its source columns imply."""
    return RowCheck(f"{column}_agrees", "consistency", f"NOT ({column} <=> ({expected}))")


def _result(table: str, check: RowCheck, failed: str, example: str) -> str:
    """One row of the log as a struct; expects the row count in ``_rows``."""
    percent = f"CAST({failed} / GREATEST(_rows, 1) * 100 AS {schemas.RATE.simpleString()})"
    return f"""NAMED_STRUCT(
        'table_name', '{table}', 'check_name', '{check.name}', 'check_type', '{check.kind}',
        'passed', {failed} = 0, 'rows_checked', _rows, 'rows_failed', {failed}, 'failure_pct', {percent},
        'severity', '{check.severity}', 'details', TO_JSON(NAMED_STRUCT('example', {example})))"""


def row_checks(table: str, df: DataFrame, key: str, checks: list[RowCheck]) -> DataFrame:
    """All row checks of a table in one aggregate; each failure names its smallest key."""
    measures = ["COUNT(*) AS _rows"]
    for i, check in enumerate(checks):
        measures.append(f"COUNT_IF({check.fails}) AS _failed{i}")
        measures.append(f"MIN(IF({check.fails}, CAST({key} AS STRING), NULL)) AS _example{i}")
    results = ", ".join(_result(table, check, f"_failed{i}", f"_example{i}") for i, check in enumerate(checks))
    return df.agg(*(F.expr(m) for m in measures)).selectExpr(f"INLINE(ARRAY({results}))")


def _per_key_check(table: str, check: RowCheck, per_key: DataFrame, failed: str) -> DataFrame:
    """A check over one row per key ``k`` with its row count ``n``; ``failed`` counts the bad ones."""
    totals = per_key.agg(
        F.expr("COALESCE(SUM(n), 0L) AS _rows"),
        F.expr(f"COALESCE(SUM(IF({check.fails}, {failed}, 0L)), 0L) AS _failed"),
        F.expr(f"MIN(IF({check.fails}, CAST(k AS STRING), NULL)) AS _example"),
    )
    return totals.selectExpr(f"INLINE(ARRAY({_result(table, check, '_failed', '_example')}))")


def unique_check(table: str, df: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """Rows beyond the first of each key; null keys are left to the not-null check."""
    per_key = df.filter(f"{key} IS NOT NULL").groupBy(F.expr(f"{key} AS k")).agg(F.expr("COUNT(*) AS n"))
    check = RowCheck(name or f"{key}_unique", "unique", "n > 1", "critical")
    return _per_key_check(table, check, per_key, "n - 1")


def one_current_check(table: str, dim: DataFrame, key: str) -> DataFrame:
    return unique_check(table, dim.filter("scd_is_current"), key, f"{key}_one_current")


def foreign_key_check(
    table: str, child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None, nulls_fail: bool = False
) -> DataFrame:
    """Child rows whose key the parent lacks, counted per key before the join.

    A null key passes, as a database foreign key lets it, unless ``nulls_fail`` makes it an orphan.
    """
    known = parent.selectExpr(f"{parent_key or key} AS _known").distinct()
    per_key = child.groupBy(F.expr(f"{key} AS k")).agg(F.expr("COUNT(*) AS n"))
    kind = "orphan" if nulls_fail else "foreign_key"
    lost = "_known IS NULL" if nulls_fail else "_known IS NULL AND k IS NOT NULL"
    return _per_key_check(
        table, RowCheck(f"{key}_{kind}", kind, lost), per_key.join(known, F.expr("k = _known"), "left"), "n"
    )


@dataclass(frozen=True)
class ForeignKey:
    """A column that names a row of another table."""

    column: str
    parent: DataFrame
    parent_key: str


def constraint_checks(
    table: str, df: DataFrame, example: str, required: list[str], foreign: list[ForeignKey], wanted: tuple[str, ...] = ()
) -> DataFrame:
    """Not-null and foreign-key checks of a table, all from one pass over it.

    Every row is unpivoted into one pair per constraint, (column, key), and pairs are counted in each map task before
    the shuffle: what leaves it are the keys in use, of which there are as many as the parents have, not the rows. A
    required column only has the keys null and not null. Parents are joined to the counted pairs, once for all. A
    null foreign key passes; the example of a missing parent is its smallest key, of a null the smallest ``example``.
    Nulls of ``wanted`` columns are worth a warning only.
    """
    pairs = [f"STRUCT('{c}' AS c, FALSE AS fk, IF({c} IS NULL, NULL, '') AS k)" for c in (*required, *wanted)]
    pairs += [f"STRUCT('{f.column}' AS c, TRUE AS fk, CAST({f.column} AS STRING) AS k)" for f in foreign]
    counted = (
        df.selectExpr(f"CAST({example} AS STRING) AS _id", f"INLINE(ARRAY({', '.join(pairs)}))")
        .groupBy("c", "fk", "k")
        .agg(F.expr("COUNT(*) AS n"), F.expr("MIN(IF(k IS NULL, _id, NULL)) AS id"))
    )
    known = [f.parent.selectExpr(f"'{f.column}' AS _c", f"CAST({f.parent_key} AS STRING) AS _k").distinct() for f in foreign]
    if known:
        counted = counted.join(reduce(DataFrame.union, known), F.expr("fk AND c = _c AND k = _k"), "left")
        bad = "IF(fk, k IS NOT NULL AND _k IS NULL, k IS NULL)"
    else:
        bad = "k IS NULL"
    totals = counted.groupBy("c", "fk").agg(
        F.expr("SUM(n) AS _rows"),
        F.expr(f"SUM(IF({bad}, n, 0L)) AS _failed"),
        F.expr(f"MIN(IF({bad}, COALESCE(k, id), NULL)) AS _example"),
    )
    checks = [not_null(column) for column in required] + [not_null(column, "warning") for column in wanted]
    checks += [RowCheck(f"{f.column}_foreign_key", "foreign_key", "") for f in foreign]
    # A list of the checks on the left: an empty table passes them all.
    names = [(check.name, check.kind, check.severity, check.name.removesuffix(f"_{check.kind}")) for check in checks]
    listed = small_frame(df.sparkSession, names, "check_name string, check_type string, severity string, _column string")
    found = listed.join(totals, F.expr("_column = c AND fk = (check_type = 'foreign_key')"), "left").selectExpr(
        "*", "COALESCE(_rows, 0L) AS rows_checked", "COALESCE(_failed, 0L) AS rows_failed"
    )
    percent = f"CAST(rows_failed / GREATEST(rows_checked, 1) * 100 AS {schemas.RATE.simpleString()})"
    return found.selectExpr(
        f"'{table}' AS table_name", "check_name", "check_type", "rows_failed = 0 AS passed", "rows_checked", "rows_failed",
        f"{percent} AS failure_pct", "severity", "TO_JSON(NAMED_STRUCT('example', _example)) AS details",
    )


def version_chain_check(table: str, dim: DataFrame, key: str) -> DataFrame:
    """Versions count 1..n without gaps and each closes on the day the next one starts."""
    window = f"OVER (PARTITION BY {key} ORDER BY scd_version)"
    broken = f"scd_version <> ROW_NUMBER() {window} OR NOT (scd_end_date <=> LEAD(scd_start_date) {window})"
    flagged = dim.selectExpr(key, f"{broken} AS _broken")
    return row_checks(table, flagged, key, [RowCheck(f"{key}_version_chain", "version_chain", "_broken", "critical")])


def silver_results(
    transactions: DataFrame, accounts: DataFrame, customers: DataFrame, branches: DataFrame
) -> list[DataFrame]:
    """Checks of the silver tables: keys, widths and precision of transactions, and parents."""
    row_level = [not_null(column) for column in ("transaction_id", "account_id", "amount")]
    row_level += [fits_width(column, width) for column, width in schemas.STAGED_WIDTHS.items()]
    row_level += [
        fits_type(column, schemas.STAGED_TRANSACTION[column].dataType.simpleString())
        for column in ("amount", "fraud_score", "balance_after", "daily_spend_total")
    ]
    return [
        row_checks("transactions", transactions, "transaction_id", row_level),
        unique_check("transactions", transactions, "transaction_id"),
        foreign_key_check("accounts", accounts, "customer_id", customers, nulls_fail=True),
        foreign_key_check("transactions", transactions, "account_id", accounts, nulls_fail=True),
        foreign_key_check("accounts", accounts, "branch_id", branches, nulls_fail=True),
    ]


def gold_results(
    fact: DataFrame,
    snapshots: DataFrame,
    dim_accounts: DataFrame,
    dim_customers: DataFrame,
    dim_merchants: DataFrame,
    dim_branches: DataFrame,
    dim_types: DataFrame,
    dim_date: DataFrame,
) -> list[DataFrame]:
    """Checks of the star schema: keys of the dimensions, versions, and all constraints of facts and snapshots."""
    day = ForeignKey("date_key", dim_date, "date_key")
    account = ForeignKey("account_key", dim_accounts, "account_key")
    customer = ForeignKey("customer_key", dim_customers, "customer_key")
    fact_keys = [
        day, account, customer,
        ForeignKey("merchant_key", dim_merchants, "merchant_key"),
        ForeignKey("branch_key", dim_branches, "branch_key"),
        ForeignKey("txn_type_key", dim_types, "txn_type_key"),
    ]
    keyed = [
        ("dim_customers", dim_customers, "customer_key", "customer_id", False),
        ("dim_accounts", dim_accounts, "account_key", "account_id", False),
        ("dim_merchants", dim_merchants, "merchant_key", "merchant_id", True),
        ("dim_branches", dim_branches, "branch_key", "branch_id", True),
        ("dim_transaction_type", dim_types, "txn_type_key", "txn_type_name", True),
        ("dim_date", dim_date, "date_key", "full_date", True),
    ]
    results = []
    for table, dim, surrogate, natural, once in keyed:
        foreign = [customer] if table == "dim_accounts" else []
        results.append(constraint_checks(table, dim, surrogate, [surrogate, natural], foreign))
        results.append(unique_check(table, dim, surrogate))
        if once:
            results.append(unique_check(table, dim, natural))
    required = ["transaction_id", "transaction_date", "amount"]
    return [
        *results,
        one_current_check("dim_customers", dim_customers, "customer_id"),
        one_current_check("dim_accounts", dim_accounts, "account_id"),
        version_chain_check("dim_customers", dim_customers, "customer_id"),
        version_chain_check("dim_accounts", dim_accounts, "account_id"),
        # A transaction without an account is kept: its key is missing, not wrong.
        constraint_checks("fact_transactions", fact, "transaction_id", required, fact_keys, wanted=("account_key",)),
        constraint_checks("fact_account_snapshots", snapshots, "snapshot_date", ["snapshot_date"], [day, account, customer]),
    ]


def all_results(parts: list[DataFrame], checked_at: datetime.datetime) -> DataFrame:
    """Results of several checks as rows of the data-quality log."""
    rows = reduce(DataFrame.unionByName, parts)
    return schemas.conform(rows, schemas.AUDIT_DATA_QUALITY, checked_at=time_literal(checked_at))
