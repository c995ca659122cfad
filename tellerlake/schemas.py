"""Column contracts of every layer. Names, types and order are fixed values."""

import datetime

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(15, 2)
RATE = DecimalType(5, 2)
SCORE = DecimalType(4, 3)


def _columns(text: str) -> tuple[str, ...]:
    return tuple(text.split())


# Raw business columns, as found in the CSV headers (fixed values).
RAW_COLUMNS = {
    "branches": _columns("branch_id branch_name city province region opened_date is_active"),
    "merchants": _columns("merchant_id merchant_name merchant_category mcc_code is_online"),
    "customers": _columns(
        "customer_id first_name last_name email phone id_number date_of_birth age gender province"
        " city postal_code customer_segment income_band risk_rating kyc_verified onboarding_date is_active"
    ),
    "accounts": _columns(
        "account_id customer_id branch_id account_type account_number currency opening_balance"
        " current_balance credit_limit interest_rate status open_date close_date overdraft_limit"
    ),
    "transactions": _columns(
        "transaction_id account_id merchant_id transaction_type channel amount is_debit currency"
        " balance_after transaction_date transaction_time reference description status is_fraud_flag"
        " fraud_score is_weekend is_holiday_season"
    ),
}

LINEAGE_COLUMNS = ("_source_file", "_batch_id", "_ingestion_ts", "_ingestion_date", "_source_row_number")

KEYS = {
    "branches": "branch_id",
    "merchants": "merchant_id",
    "customers": "customer_id",
    "accounts": "account_id",
    "transactions": "transaction_id",
}


def bronze_schema(table: str) -> StructType:
    """All-string business columns, lineage, and the partition columns ``date`` and ``batch``."""
    fields = [StructField(name, StringType()) for name in RAW_COLUMNS[table]]
    for name in LINEAGE_COLUMNS:
        fields.append(StructField(name, LongType() if name == "_source_row_number" else StringType()))
    fields += [StructField("date", DateType()), StructField("batch", StringType())]
    return StructType(fields)


def _struct(**types: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in types.items()])


DIM_BRANCHES = _struct(
    branch_key=LongType(),
    branch_id=StringType(),
    branch_name=StringType(),
    city=StringType(),
    province=StringType(),
    region=StringType(),
    opened_date=DateType(),
    is_active=BooleanType(),
    dw_created_at=TimestampType(),
    dw_batch_id=StringType(),
)

DIM_MERCHANTS = _struct(
    merchant_key=LongType(),
    merchant_id=StringType(),
    merchant_name=StringType(),
    merchant_category=StringType(),
    mcc_code=IntegerType(),
    is_online=BooleanType(),
    dw_created_at=TimestampType(),
    dw_batch_id=StringType(),
)

DIM_CUSTOMERS = _struct(
    customer_key=LongType(),
    customer_id=StringType(),
    full_name=StringType(),
    email=StringType(),
    date_of_birth=DateType(),
    age_band=StringType(),
    gender=StringType(),
    province=StringType(),
    city=StringType(),
    customer_segment=StringType(),
    income_band=StringType(),
    risk_rating=StringType(),
    kyc_verified=BooleanType(),
    onboarding_date=DateType(),
    is_active=BooleanType(),
    scd_start_date=DateType(),
    scd_end_date=DateType(),
    scd_is_current=BooleanType(),
    scd_version=ShortType(),
    dw_created_at=TimestampType(),
    dw_batch_id=StringType(),
)

DIM_ACCOUNTS = _struct(
    account_key=LongType(),
    account_id=StringType(),
    customer_key=LongType(),
    customer_id=StringType(),
    account_type=StringType(),
    account_number=StringType(),
    currency=StringType(),
    credit_limit=MONEY,
    interest_rate=RATE,
    overdraft_limit=MONEY,
    status=StringType(),
    open_date=DateType(),
    close_date=DateType(),
    account_age_days=IntegerType(),
    branch_key=LongType(),
    scd_start_date=DateType(),
    scd_end_date=DateType(),
    scd_is_current=BooleanType(),
    scd_version=ShortType(),
    dw_created_at=TimestampType(),
    dw_batch_id=StringType(),
)

DIM_DATE = _struct(
    date_key=IntegerType(),
    full_date=DateType(),
    day_of_week=ShortType(),
    day_name=StringType(),
    day_of_month=ShortType(),
    day_of_year=ShortType(),
    week_of_year=ShortType(),
    month_number=ShortType(),
    month_name=StringType(),
    quarter=ShortType(),
    year=ShortType(),
    is_weekend=BooleanType(),
    is_month_end=BooleanType(),
    is_quarter_end=BooleanType(),
    is_year_end=BooleanType(),
    fiscal_year=ShortType(),
    fiscal_quarter=ShortType(),
)

DIM_TRANSACTION_TYPE = _struct(
    txn_type_key=LongType(),
    txn_type_name=StringType(),
    txn_category=StringType(),
    balance_direction=StringType(),
)

# What the fact load takes from silver, typed as the fact table stores it.
STAGED_TRANSACTION = _struct(
    transaction_id=StringType(),
    account_id=StringType(),
    merchant_id=StringType(),
    transaction_type=StringType(),
    transaction_date=DateType(),
    transaction_time=StringType(),
    transaction_hour=ShortType(),
    amount=MONEY,
    is_debit=BooleanType(),
    balance_after=MONEY,
    status=StringType(),
    is_fraud_flag=BooleanType(),
    fraud_score=SCORE,
    fraud_risk_band=StringType(),
    is_weekend=BooleanType(),
    is_night_transaction=BooleanType(),
    amount_band=StringType(),
    daily_txn_count=IntegerType(),
    daily_spend_total=MONEY,
    reference=StringType(),
    description=StringType(),
    channel=StringType(),
)

FACT_TRANSACTIONS = _struct(
    transaction_key=LongType(),
    date_key=IntegerType(),
    account_key=LongType(),
    customer_key=LongType(),
    merchant_key=LongType(),
    branch_key=LongType(),
    txn_type_key=LongType(),
    transaction_id=StringType(),
    transaction_date=DateType(),
    transaction_time=StringType(),
    transaction_hour=ShortType(),
    amount=MONEY,
    is_debit=BooleanType(),
    balance_after=MONEY,
    status=StringType(),
    is_fraud_flag=BooleanType(),
    fraud_score=SCORE,
    fraud_risk_band=StringType(),
    is_weekend=BooleanType(),
    is_night_transaction=BooleanType(),
    amount_band=StringType(),
    daily_txn_count=IntegerType(),
    daily_spend_total=MONEY,
    reference=StringType(),
    description=StringType(),
    channel=StringType(),
    dw_loaded_at=TimestampType(),
    dw_batch_id=StringType(),
)

# What the fact load leaves out, and why.
FACT_REJECTS = StructType(
    [
        *STAGED_TRANSACTION.fields,
        StructField("reason", StringType()),
        StructField("dw_loaded_at", TimestampType()),
        StructField("dw_batch_id", StringType()),
    ]
)

FACT_ACCOUNT_SNAPSHOTS = _struct(
    snapshot_key=LongType(),
    snapshot_date=DateType(),
    date_key=IntegerType(),
    account_key=LongType(),
    customer_key=LongType(),
    closing_balance=MONEY,
    opening_balance=MONEY,
    daily_credits=MONEY,
    daily_debits=MONEY,
    txn_count=IntegerType(),
    is_overdrawn=BooleanType(),
    dw_loaded_at=TimestampType(),
    dw_batch_id=StringType(),
)

# Snapshots as they are stored: with the account that they are of, to chain its days.
STORED_SNAPSHOT = StructType([StructField("account_id", StringType()), *FACT_ACCOUNT_SNAPSHOTS.fields])

AUDIT_PIPELINE_RUNS = _struct(
    pipeline_name=StringType(),
    layer=StringType(),
    status=StringType(),
    started_at=TimestampType(),
    ended_at=TimestampType(),
    duration_secs=IntegerType(),
    rows_processed=LongType(),
    rows_failed=LongType(),
    error_message=StringType(),
    batch_id=StringType(),
    metadata=StringType(),
)

AUDIT_DATA_QUALITY = _struct(
    checked_at=TimestampType(),
    table_name=StringType(),
    check_name=StringType(),
    check_type=StringType(),
    passed=BooleanType(),
    rows_checked=LongType(),
    rows_failed=LongType(),
    failure_pct=RATE,
    severity=StringType(),
    details=StringType(),
)

# Text widths of the staged transaction columns (fixed values), checked by the quality operators.
STAGED_WIDTHS = {
    "transaction_id": 50,
    "account_id": 20,
    "merchant_id": 20,
    "transaction_type": 50,
    "status": 50,
    "fraud_risk_band": 20,
    "amount_band": 20,
    "reference": 50,
    "description": 255,
    "channel": 50,
}

# Values a row takes when its source does not carry the column at all (fixed values, as SQL).
DEFAULTS = {
    "is_active": "TRUE",
    "kyc_verified": "FALSE",
    "is_online": "FALSE",
    "currency": "'ZAR'",
    "is_fraud_flag": "FALSE",
}


def conform(df: DataFrame, schema: StructType, **computed: str) -> DataFrame:
    """Project onto a schema: ``computed`` SQL wins, absent columns take their default.

    A column that is neither present, computed nor defaulted is an error, so a misnamed source
    column can never shift its neighbours. Decimals that do not fit become null (see the
    precision checks); nothing raises in the middle of a load.
    """
    present = {name: f"`{name}`" for name in df.columns}
    values = DEFAULTS | present | computed
    missing = [name for name in schema.names if name not in values]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.selectExpr(
        *(f"TRY_CAST({values[f.name]} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
    )


def text_literal(value: str) -> str:
    """A Python string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def day_literal(day: datetime.date) -> str:
    return f"DATE '{day.isoformat()}'"


def time_literal(time: datetime.datetime) -> str:
    """A UTC time as a SQL literal that does not depend on the session zone."""
    return f"TIMESTAMP '{time:%Y-%m-%d %H:%M:%S.%f}+00:00'"
