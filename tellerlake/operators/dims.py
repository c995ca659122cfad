"""Generated and seeded dimensions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.functions import calendar
from tellerlake.operators.dedup import absent_from
from tellerlake.operators.keys import highest

CALENDAR_START, CALENDAR_END = "2020-01-01", "2027-12-31"

# Transaction type, category and direction of the money (fixed values).
TRANSACTION_TYPES = (
    ("Purchase", "Spend", "DEBIT"),
    ("ATM Withdrawal", "Cash", "DEBIT"),
    ("EFT Transfer Out", "Transfer", "DEBIT"),
    ("EFT Transfer In", "Transfer", "CREDIT"),
    ("Debit Order", "Recurring", "DEBIT"),
    ("Salary Credit", "Income", "CREDIT"),
    ("Bank Charges", "Fee", "DEBIT"),
    ("Reversal", "Reversal", "CREDIT"),
)


def calendar_columns(day: str) -> list[str]:
    """Every column of the calendar dimension for a date."""
    return [
        f"{calendar.date_key(day)} AS date_key",
        f"{day} AS full_date",
        f"CAST({calendar.iso_day_of_week(day)} AS SMALLINT) AS day_of_week",
        f"DATE_FORMAT({day}, 'EEEE') AS day_name",
        f"CAST(DAY({day}) AS SMALLINT) AS day_of_month",
        f"CAST(DAYOFYEAR({day}) AS SMALLINT) AS day_of_year",
        f"CAST(WEEKOFYEAR({day}) AS SMALLINT) AS week_of_year",
        f"CAST(MONTH({day}) AS SMALLINT) AS month_number",
        f"DATE_FORMAT({day}, 'MMMM') AS month_name",
        f"CAST(QUARTER({day}) AS SMALLINT) AS quarter",
        f"CAST(YEAR({day}) AS SMALLINT) AS year",
        f"{calendar.is_weekend(day)} AS is_weekend",
        f"{calendar.is_month_end(day)} AS is_month_end",
        f"{calendar.is_quarter_end(day)} AS is_quarter_end",
        f"{calendar.is_year_end(day)} AS is_year_end",
        f"CAST({calendar.fiscal_year(day)} AS SMALLINT) AS fiscal_year",
        f"CAST({calendar.fiscal_quarter(day)} AS SMALLINT) AS fiscal_quarter",
    ]


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = spark.range(1).selectExpr(f"EXPLODE(SEQUENCE(DATE '{start}', DATE '{end}')) AS _day")
    return days.selectExpr(*calendar_columns("_day"))


def transaction_type_seed(spark: SparkSession) -> DataFrame:
    rows = ", ".join(str((position, *row)) for position, row in enumerate(TRANSACTION_TYPES, 1))
    names = "position, txn_type_name, txn_category, balance_direction"
    return spark.sql(f"SELECT * FROM VALUES {rows} AS seed({names})")


def dim_transaction_type(spark: SparkSession, existing: DataFrame | None = None) -> DataFrame:
    """The seeded lookup, added to an existing one without touching the names it already has.

    Keys follow the order of the seed: its position when there is no table yet, else above the
    keys in use. The seed is a fixed handful of rows, so one task numbers it.
    """
    columns = ["txn_type_key", "txn_type_name", "txn_category", "balance_direction"]
    seed = transaction_type_seed(spark)
    if existing is None:
        return seed.selectExpr("CAST(position AS BIGINT) AS txn_type_key", *columns[1:])
    fresh = absent_from(seed, existing, "txn_type_name").selectExpr(
        "CAST(ROW_NUMBER() OVER (ORDER BY position) AS BIGINT) AS txn_type_key", *columns[1:]
    )
    fresh = fresh.withColumn("txn_type_key", F.col("txn_type_key") + highest(existing, "txn_type_key"))
    return existing.select(columns).unionByName(fresh)
