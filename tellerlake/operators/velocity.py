"""Daily account velocity: completed transactions and spend per account and day, on every row."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.schemas import MONEY

_MONEY = MONEY.simpleString()
_SAME_DAY = "account_id <=> _day_account AND transaction_date <=> _day"


def day_totals(transactions: DataFrame) -> DataFrame:
    """One row per account and day, null ones included: how many rows completed, and what they spent.

    Spend is summed as exact decimals, so no order of adding changes it. Rows are aggregated before the shuffle: a
    day of one account with a third of all rows sends one row a task.
    """
    spent = f"SUM(IF(is_completed AND is_debit, TRY_CAST(amount AS {_MONEY}), NULL))"
    return transactions.groupBy(F.expr("account_id AS _day_account"), F.expr("transaction_date AS _day")).agg(
        F.expr("COUNT_IF(is_completed) AS _day_count"), F.expr(f"TRY_CAST(COALESCE({spent}, 0) AS {_MONEY}) AS _day_spend")
    )


def with_totals(transactions: DataFrame, totals: DataFrame) -> DataFrame:
    """Add ``daily_txn_count`` and ``daily_spend_total`` from day totals; rows that are not completed get 0.

    Rows that have both columns keep them where ``totals`` lacks their day. A spend that its type can't hold is null.
    Both sides of the join are plain, so adaptive execution broadcasts small totals and splits the rows of a hot day.
    """
    held = "daily_txn_count" in transactions.columns
    count = "COALESCE(_day_count, daily_txn_count)" if held else "_day_count"
    spend = "IF(_day_count IS NULL, daily_spend_total, _day_spend)" if held else "_day_spend"
    columns = [name for name in transactions.columns if name not in ("daily_txn_count", "daily_spend_total")]
    return transactions.join(totals, F.expr(_SAME_DAY), "left").selectExpr(
        *columns,
        f"IF(is_completed, {count}, 0L) AS daily_txn_count",
        f"IF(is_completed, {spend}, CAST(0 AS {_MONEY})) AS daily_spend_total",
    )


def with_daily_velocity(transactions: DataFrame) -> DataFrame:
    """Velocity of all rows of a frame, which is read twice: pass a stored one."""
    return with_totals(transactions, day_totals(transactions))
