"""Marts over the star schema, and the selections the reports make from them."""

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.functions import bands
from tellerlake.operators.scd import current_rows
from tellerlake.schemas import day_literal

SUMMARY_REPORT_DAYS = 30


def customer_360(fact: DataFrame, dim_customers: DataFrame, dim_accounts: DataFrame) -> DataFrame:
    """One row per current customer: profile, accounts and completed transactions.

    Facts are summed per customer key before any join, then per customer, because a fact keeps the
    key of the version that was current when it was loaded.
    """
    per_key = (
        fact.filter("status = 'Completed'")
        .groupBy("customer_key")
        .agg(
            F.expr("COUNT(*) AS n"),
            F.expr("SUM(IF(is_debit, amount, NULL)) AS spend"),
            F.expr("SUM(IF(NOT is_debit, amount, NULL)) AS income"),
            F.expr("MAX(transaction_date) AS last_day"),
        )
    )
    activity = (
        dim_customers.select("customer_key", "customer_id")
        .join(per_key, "customer_key")
        .groupBy("customer_id")
        .agg(
            F.expr("SUM(n) AS completed_txn_count"),
            F.expr("SUM(spend) AS total_spend"),
            F.expr("SUM(income) AS total_income"),
            F.expr("MAX(last_day) AS last_transaction_date"),
        )
    )
    holdings = (
        current_rows(dim_accounts)
        .groupBy("customer_id")
        .agg(F.expr("COUNT(*) AS account_count"), F.expr("COUNT_IF(status = 'Active') AS active_account_count"))
    )
    return (
        current_rows(dim_customers)
        .join(holdings, "customer_id", "left")
        .join(activity, "customer_id", "left")
        .selectExpr(
            "customer_key",
            "customer_id",
            "full_name",
            "age_band",
            "province",
            "customer_segment",
            "income_band",
            "risk_rating",
            "kyc_verified",
            "is_active",
            "COALESCE(account_count, 0L) AS account_count",
            "COALESCE(active_account_count, 0L) AS active_account_count",
            "COALESCE(completed_txn_count, 0L) AS completed_txn_count",
            "CAST(COALESCE(total_spend, 0) AS DECIMAL(18,2)) AS total_spend",
            "CAST(COALESCE(total_income, 0) AS DECIMAL(18,2)) AS total_income",
            "last_transaction_date",
        )
    )


def fraud_signals(fact: DataFrame) -> DataFrame:
    """Every fact with its alert level: the fraud band in capitals, CRITICAL for flagged rows."""
    return fact.selectExpr(
        "transaction_id",
        "transaction_date",
        "account_key",
        "customer_key",
        "merchant_key",
        "channel",
        "amount",
        "status",
        "is_fraud_flag",
        "fraud_score",
        "fraud_risk_band",
        "IF(is_fraud_flag, 'CRITICAL', UPPER(fraud_risk_band)) AS alert_level",
    )


def daily_transaction_summary(fact: DataFrame, dim_types: DataFrame) -> DataFrame:
    """Counts and amounts per day, transaction type and channel."""
    per_key = fact.groupBy("transaction_date", "txn_type_key", "channel").agg(
        F.expr("COUNT(*) AS txn_count"),
        F.expr(f"COUNT_IF({bands.is_completed('status')}) AS completed_count"),
        F.expr(f"COUNT_IF({bands.is_declined('status')}) AS declined_count"),
        F.expr("COUNT_IF(is_fraud_flag) AS flagged_count"),
        F.expr("CAST(SUM(amount) AS DECIMAL(18,2)) AS total_amount"),
    )
    names = dim_types.selectExpr("txn_type_key", "txn_type_name AS transaction_type")
    return per_key.join(names, "txn_type_key", "left").select(
        "transaction_date",
        "transaction_type",
        "channel",
        "txn_count",
        "completed_count",
        "declined_count",
        "flagged_count",
        "total_amount",
    )


def customer_report(mart: DataFrame, rows: int | None = None) -> DataFrame:
    """All customers, or the ``rows`` first by key."""
    return mart if rows is None else mart.orderBy("customer_key").limit(rows)


def fraud_report(mart: DataFrame) -> DataFrame:
    return mart.filter("alert_level IN ('CRITICAL', 'HIGH')")


def summary_report(mart: DataFrame, as_of: datetime.date, days: int = SUMMARY_REPORT_DAYS) -> DataFrame:
    """The days since ``as_of - days``, selected by SQL text over the mart."""
    since = day_literal(as_of - datetime.timedelta(days=days))
    return mart.sparkSession.sql(f"SELECT * FROM {{mart}} WHERE transaction_date >= {since}", mart=mart)
