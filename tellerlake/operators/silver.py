"""Bronze text rows to typed, deduplicated and enriched silver tables."""

import datetime

from pyspark.sql import DataFrame

from tellerlake.functions import bands, casts
from tellerlake.operators.dedup import RECENCY, latest_by_key
from tellerlake.operators.velocity import with_daily_velocity
from tellerlake.schemas import day_literal
from tellerlake.session import materialise

_READ = {"int": casts.to_integer, "double": casts.to_double, "boolean": casts.to_boolean, "date": casts.to_day}


def _project(bronze: DataFrame, columns: str, **derived: str) -> DataFrame:
    """Silver columns, plus whatever lineage exists to order the copies of a row.

    ``columns`` names them in order, ``name:kind`` for those that are read as a type; ``derived``
    gives the SQL of columns that raw rows do not have.
    """
    chosen = []
    for column in columns.split():
        name, _, kind = column.partition(":")
        value = derived.get(name) or (_READ[kind](name) if kind else name)
        chosen.append(f"{value} AS {name}")
    return bronze.selectExpr(*chosen, *(name for name in RECENCY if name in bronze.columns))


def _without_position(df: DataFrame) -> DataFrame:
    return df.drop("_source_file", "_source_row_number")


def branches(bronze: DataFrame) -> DataFrame:
    rows = _project(bronze, "branch_id branch_name city province region opened_date:date is_active:boolean")
    return _without_position(latest_by_key(rows, "branch_id"))


def merchants(bronze: DataFrame) -> DataFrame:
    rows = _project(bronze, "merchant_id merchant_name merchant_category mcc_code:int is_online:boolean")
    return _without_position(latest_by_key(rows, "merchant_id"))


def customers(bronze: DataFrame) -> DataFrame:
    """Customers without their national id number; the surviving copy must carry an e-mail address."""
    rows = _project(
        bronze,
        "customer_id first_name last_name full_name email phone date_of_birth:date age:int age_band gender"
        " province city postal_code customer_segment income_band risk_rating kyc_verified:boolean"
        " onboarding_date:date is_active:boolean",
        full_name="CONCAT_WS(' ', first_name, last_name)",
        age_band=bands.age_band(casts.to_integer("age")),
    )
    return _without_position(latest_by_key(rows, "customer_id").filter("CONTAINS(email, '@')"))


def accounts(bronze: DataFrame, as_of: datetime.date) -> DataFrame:
    """Accounts with an owner; ``as_of`` is the day their age is counted to."""
    rows = _project(
        bronze,
        "account_id customer_id branch_id account_type account_number currency opening_balance:double"
        " current_balance:double credit_limit:double interest_rate:double status open_date:date"
        " close_date:date overdraft_limit:double account_age_days has_overdraft",
        account_age_days=f"DATEDIFF({day_literal(as_of)}, {casts.to_day('open_date')})",
        has_overdraft=f"COALESCE({casts.to_double('overdraft_limit')} > 0, FALSE)",
    )
    return latest_by_key(rows, "account_id").filter("customer_id IS NOT NULL").drop(*RECENCY)


def typed_transactions(bronze: DataFrame) -> DataFrame:
    """The latest copy of each transaction, typed."""
    rows = _project(
        bronze,
        "transaction_id account_id merchant_id transaction_type channel amount:double is_debit:boolean"
        " currency balance_after:double transaction_date:date transaction_time reference description"
        " status is_fraud_flag:boolean fraud_score:double is_weekend:boolean is_holiday_season:boolean",
    )
    return _without_position(latest_by_key(rows, "transaction_id"))


def flagged(typed: DataFrame) -> DataFrame:
    """Typed transactions with all that follows from a row by itself."""
    hour = casts.hour_of("transaction_time")
    return typed.selectExpr(
        *typed.columns,
        f"{hour} AS transaction_hour",
        # 1 = Sunday here; the calendar dimension counts from Monday.
        "DAYOFWEEK(transaction_date) AS transaction_day_of_week",
        "MONTH(transaction_date) AS transaction_month",
        "YEAR(transaction_date) AS transaction_year",
        f"{bands.is_night(hour)} AS is_night_transaction",
        f"{bands.is_business_hours(hour)} AS is_business_hours",
        f"{bands.amount_band('amount')} AS amount_band",
        f"{bands.fraud_risk_band('fraud_score')} AS fraud_risk_band",
        f"{bands.is_declined('status')} AS is_declined",
        f"{bands.is_completed('status')} AS is_completed",
    )


def valid_transactions(bronze: DataFrame) -> DataFrame:
    """Silver transactions without their velocity, for what doesn't need it: one deduplication and no join."""
    return flagged(typed_transactions(bronze)).filter("amount > 0")


def transactions(bronze: DataFrame) -> DataFrame:
    """Typed, enriched transactions with a positive amount.

    Copies are removed before velocity is counted, so a re-ingested day is not counted twice. Completed rows without
    a positive amount still count towards velocity and are dropped last. The deduplicated rows are stored, for the
    day totals and the rows that they go back to are both read from them; the flags are added after the join.
    """
    typed = materialise(typed_transactions(bronze))
    completed = typed.selectExpr("*", f"{bands.is_completed('status')} AS is_completed")
    counted = with_daily_velocity(completed).filter("amount > 0").drop("is_completed")
    return flagged(counted).select(*silver_columns(typed))


def silver_columns(typed: DataFrame) -> list[str]:
    """The columns of the silver table, velocity last."""
    return [*flagged(typed).columns, "daily_txn_count", "daily_spend_total"]
