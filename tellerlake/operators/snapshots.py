"""Daily account balances."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake import schemas
from tellerlake.functions import calendar
from tellerlake.operators import changes
from tellerlake.operators.scd import Load, current_rows
from tellerlake.schemas import text_literal, time_literal

DAY_COLUMNS = ("account_id", "transaction_date", "closing_balance", "daily_credits", "daily_debits", "txn_count")
_CHAIN = "PARTITION BY XXHASH64(account_id), account_id ORDER BY transaction_date"


def account_days(transactions: DataFrame) -> DataFrame:
    """One row per account and dated day with completed transactions.

    Closing balance is the balance after the day's last transaction. Days are reduced by a partially aggregated
    group-by, so whatever the account's volume no task sees more than one row per task and day.
    """
    amount = "TRY_CAST(amount AS DECIMAL(15,2))"
    credit = "NOT COALESCE(is_debit, FALSE)"
    return (
        transactions.filter("status = 'Completed' AND transaction_date IS NOT NULL")
        .groupBy("account_id", "transaction_date")
        .agg(
            F.expr(
                "MAX_BY(TRY_CAST(balance_after AS DECIMAL(15,2)), STRUCT(transaction_time, transaction_id))"
                " AS closing_balance"
            ),
            F.expr(f"COALESCE(SUM(IF({credit}, {amount}, NULL)), 0) AS daily_credits"),
            F.expr(f"COALESCE(SUM(IF({credit}, NULL, {amount})), 0) AS daily_debits"),
            F.expr("COUNT(*) AS txn_count"),
        )
    )


def _resolved(days: DataFrame, dim_accounts: DataFrame, load: Load, **computed: str) -> DataFrame:
    """Days with their keys and the columns that follow, as snapshots."""
    account = current_rows(dim_accounts).select("account_id", "account_key", "customer_key")
    return schemas.conform(
        days.join(account, "account_id", "left"),
        schemas.STORED_SNAPSHOT,
        snapshot_key="NULL",
        snapshot_date="transaction_date",
        date_key=calendar.date_key("transaction_date"),
        is_overdrawn="closing_balance < 0",
        dw_loaded_at=time_literal(load.loaded_at),
        dw_batch_id=text_literal(load.batch_id),
        **computed,
    )


def account_snapshots(transactions: DataFrame, dim_accounts: DataFrame, load: Load) -> DataFrame:
    """One row per account and day with completed transactions, from all of them.

    Opening balance is the closing balance of the account's previous such day, null on its first.
    """
    days = account_days(transactions).selectExpr("*", f"LAG(closing_balance) OVER ({_CHAIN}) AS opening_balance")
    return _resolved(days, dim_accounts, load).drop("account_id")


def new_days(days: DataFrame, dim_accounts: DataFrame, load: Load) -> DataFrame:
    """Days as stored snapshots whose opening balance is not known yet."""
    return _resolved(days, dim_accounts, load, opening_balance="NULL")


def bases(stored: DataFrame, touched: DataFrame, last: DataFrame) -> DataFrame:
    """(_account, _base) of the accounts with touched days: the balance that their chain begins with.

    ``stored`` are the snapshots from the earliest touched month on, before the batch; ``touched`` the accounts and
    days that changed; ``last`` (account_id, closing_balance) the latest closing balance of each account. A chain
    begins with what its first stored row there began with: whatever came before that month is carried by it. An
    account without a row there begins with its latest balance, and a new one with none.
    """
    accounts = touched.selectExpr("account_id AS _account").distinct()
    first = stored.groupBy(F.expr("account_id AS _first_of")).agg(
        F.expr("MIN_BY(STRUCT(opening_balance), snapshot_date) AS _begin")
    )
    carried = last.selectExpr("account_id AS _last_of", "closing_balance AS _carried")
    return (
        accounts.join(first, F.expr("_account <=> _first_of"), "left")
        .join(carried, F.expr("_account <=> _last_of"), "left")
        .selectExpr("_account", "IF(_begin IS NULL, _carried, _begin.opening_balance) AS _base")
    )


def chained(stored: DataFrame, touched: DataFrame, fresh: DataFrame, base: DataFrame) -> DataFrame:
    """The snapshots of accounts with touched days, from the earliest touched month on, each opened anew.

    ``fresh`` are the snapshots of the touched days as they are now. Adds ``_moved``: whether the row is not as it
    is stored.
    """
    held = stored.join(base, F.expr("account_id <=> _account"), "left_semi")
    days, _ = changes.same_day(touched)
    kept = held.join(days, F.expr("account_id <=> _on_account AND snapshot_date <=> _on_day"), "left_anti")
    rows = kept.withColumn("_fresh", F.lit(False)).unionByName(fresh.withColumn("_fresh", F.lit(True)))
    chain = "OVER (PARTITION BY XXHASH64(account_id), account_id ORDER BY snapshot_date)"
    opened = rows.join(base, F.expr("account_id <=> _account"), "left").selectExpr(
        "*", f"IF(ROW_NUMBER() {chain} = 1, _base, LAG(closing_balance) {chain}) AS _opening"
    )
    names = [name for name in stored.columns if name != "opening_balance"]
    moved = "_fresh OR NOT (opening_balance <=> _opening) AS _moved"
    return opened.selectExpr(*names, "_opening AS opening_balance", moved).select(*stored.columns, "_moved")


def closing_balances(chain: DataFrame, base: DataFrame) -> DataFrame:
    """(account_id, closing_balance) of the accounts with touched days, after the batch.

    An account all of whose rows in the chain are gone is back at the balance that the chain began with.
    """
    ends = chain.groupBy("account_id").agg(F.expr("MAX_BY(STRUCT(closing_balance), snapshot_date) AS _end"))
    return base.join(ends, F.expr("_account <=> account_id"), "left").selectExpr(
        "_account AS account_id", "IF(_end IS NULL, _base, _end.closing_balance) AS closing_balance"
    )
