import datetime
import random
from decimal import Decimal

import pytest
from conftest import as_set, final_plan

from tellerlake.operators import dedup, silver
from tellerlake.operators.velocity import with_daily_velocity
from tellerlake.plans.standins import view
from tellerlake.schemas import RAW_COLUMNS

AS_OF = datetime.date(2024, 2, 1)


def bronze(spark, table, *rows):
    """Bronze rows from partial dicts; the position in the list is the row number."""
    names = [*RAW_COLUMNS[table], "_ingestion_ts", "_batch_id", "_source_file", "_source_row_number"]
    kinds = ", ".join(f"{n} {'bigint' if n == '_source_row_number' else 'string'}" for n in names)
    base = {"_ingestion_ts": "t1", "_batch_id": "b1", "_source_file": "f"}
    full = [{**base, "_source_row_number": i, **row} for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in full], kinds)


def test_latest_copy_wins_by_time_batch_and_position(spark):
    rows = [
        ("a", "t1", "b9", 9, "old"), ("a", "t2", "b1", 1, "new"),
        ("b", "t1", "b1", 5, "old"), ("b", "t1", "b2", 1, "new"),
        ("c", "t1", "b1", 1, "old"), ("c", "t1", "b1", 2, "new"),
        (None, "t9", "b9", 1, "lost"),
    ]
    df = spark.createDataFrame(rows, "k string, _ingestion_ts string, _batch_id string, _source_row_number bigint, v string")
    for partitions in (1, 3, 7):
        kept = dedup.latest_by_key(df.repartition(partitions), "k").select("k", "v")
        assert as_set(kept) == {("a", "new"), ("b", "new"), ("c", "new")}


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark, sf_dir):
    plan = final_plan(dedup.latest_by_key(view(spark, sf_dir, "transactions_in"), "transaction_id"))
    assert "row_number(), 1, Partial" in plan


def test_customer_filters_run_after_dedup(spark):
    rows = bronze(
        spark, "customers",
        {"customer_id": "1", "email": "x@y", "_ingestion_ts": "t1"},
        {"customer_id": "1", "email": "broken", "_ingestion_ts": "t2"},
        {"customer_id": "2", "email": None},
        {"customer_id": "3", "email": "a@b", "first_name": "Ann", "last_name": None, "age": "64"},
    )
    kept = silver.customers(rows)
    assert as_set(kept.select("customer_id", "full_name", "age_band")) == {("3", "Ann", "55-64")}
    assert not {"id_number", "_source_file", "_source_row_number"} & set(kept.columns)


def test_accounts(spark):
    rows = bronze(
        spark, "accounts",
        {"account_id": "1", "customer_id": "c", "overdraft_limit": "0.01", "open_date": "2024-01-31"},
        {"account_id": "2", "customer_id": "c", "overdraft_limit": "0", "open_date": "bad"},
        {"account_id": "3", "customer_id": "c", "overdraft_limit": None},
        {"account_id": "4", "customer_id": None},
        {"account_id": None, "customer_id": "c"},
    )
    kept = silver.accounts(rows, AS_OF).select("account_id", "has_overdraft", "account_age_days")
    assert as_set(kept) == {("1", True, 1), ("2", False, None), ("3", False, None)}


def txn(number, account="a", day="2024-01-01", amount="10", debit="True", status="Completed", **more):
    return {
        "transaction_id": None if number is None else str(number), "account_id": account, "transaction_date": day,
        "amount": amount, "is_debit": debit, "status": status, **more,
    }


def velocity(spark, *rows):
    kept = silver.transactions(bronze(spark, "transactions", *rows))
    return as_set(kept.select("transaction_id", "daily_txn_count", "daily_spend_total"))


def test_velocity_counts_completed_rows_of_the_day(spark):
    got = velocity(
        spark,
        txn(1), txn(2, debit="False"), txn(3, debit=None), txn(4, status="Pending"), txn(5, day="2024-01-02"),
        txn(6, account="b", amount="1.5"),
    )
    assert got == {("1", 3, 10.0), ("2", 3, 10.0), ("3", 3, 10.0), ("4", 0, 0.0), ("5", 1, 10.0), ("6", 1, 1.5)}


def test_repeated_ingestion_does_not_inflate_velocity(spark):
    rows = [txn(1), txn(2)]
    again = [{**row, "_ingestion_ts": "t2"} for row in rows]
    assert velocity(spark, *rows, *again) == velocity(spark, *rows)


def test_rows_without_amount_count_and_are_dropped_last(spark):
    got = velocity(spark, txn(1), txn(2, amount="-4"), txn(3, amount="x"), txn(None, amount="99"))
    assert got == {("1", 3, 6.0)}


def test_null_account_and_day_form_a_group(spark):
    got = velocity(spark, txn(1, account=None), txn(2, account=None), txn(3, day="bad"), txn(4, day="bad"))
    assert got == {("1", 2, 20.0), ("2", 2, 20.0), ("3", 2, 20.0), ("4", 2, 20.0)}


HOT_SCHEMA = (
    "transaction_id string, account_id string, transaction_date date, amount double, is_debit boolean, is_completed boolean"
)


@pytest.mark.parametrize("seed", range(3))
def test_velocity_equals_plain_sums(spark, seed):
    """A third of all rows on one account and day, against sums made in plain Python."""
    pick = random.Random(seed)
    rows = []
    for i in range(600):
        account, day = ("hot", 1) if i % 3 == 0 else (pick.choice(["a", "b", None]), pick.choice([1, 2, 3, None]))
        amount = Decimal(pick.randint(1, 9999)) / 100
        day = day and datetime.date(2024, 1, day)
        rows.append((str(i), account, day, float(amount), pick.random() < 0.7, pick.random() < 0.8))
    expected = set()
    for row in rows:
        same = [r for r in rows if r[1:3] == row[1:3] and r[5]]
        spent = sum((Decimal(str(r[3])) for r in same if r[4]), Decimal(0))
        expected.add((*row, *((len(same), spent) if row[5] else (0, Decimal(0)))))
    assert as_set(with_daily_velocity(spark.createDataFrame(rows, HOT_SCHEMA))) == expected


def test_a_hot_day_is_split(spark, tmp_path):
    """The rows of one account's day are dealt over several tasks by adaptive execution."""
    path = str(tmp_path / "rows")
    spark.range(400_000).selectExpr(
        "CAST(id AS STRING) AS transaction_id", "IF(id % 3 > 0, 'a', CAST(id % 5000 AS STRING)) AS account_id",
        "DATE '2024-01-01' AS transaction_date", "1D AS amount", "TRUE AS is_debit", "TRUE AS is_completed",
    ).repartition(16).write.parquet(path)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        counted = with_daily_velocity(spark.read.parquet(path))
        assert "skew=true" in final_plan(counted)
        assert counted.filter("account_id = 'a'").select("daily_txn_count").distinct().collect() == [(266_666,)]
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_one_scan_and_one_deduplication(spark, sf_dir):
    """The stored rows are all that the query reads; without velocity nothing is stored or joined."""
    rows = view(spark, sf_dir, "transactions_in")
    plan = silver.transactions(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "events.parquet" not in plan
    without = final_plan(silver.valid_transactions(rows)).split("== Initial Plan ==")[0]
    assert without.count("FileScan") == 1 and without.count("WindowGroupLimit") == 2 and "Join" not in without
