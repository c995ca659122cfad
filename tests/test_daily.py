import datetime

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tellerlake.operators import scd
from tellerlake.plans import gold, incremental
from tellerlake.plans.daily import DailyRun, Paths
from tellerlake.plans.standins import view
from tellerlake.schemas import AUDIT_PIPELINE_RUNS

DAY_ONE, DAY_TWO, DAY_THREE = (datetime.date(2024, m, 1) for m in (2, 3, 4))


def put(df, folder, table):
    rows = df.drop("_ingestion_ts", "_batch_id")
    if table == "customers":
        rows = rows.selectExpr("*", "'0' AS id_number")
    rows.write.mode("overwrite").option("header", True).csv(f"{folder}/{table}.csv")


def test_three_days(spark, sf_dir, tmp_path):
    folder = str(tmp_path / "raw")
    paths = Paths(folder, str(tmp_path / "wh"))
    put(view(spark, sf_dir, "branches_in"), folder, "branches")
    put(view(spark, sf_dir, "merchants_in"), folder, "merchants")
    put(view(spark, sf_dir, "customers_day1"), folder, "customers")
    put(view(spark, sf_dir, "accounts_day1"), folder, "accounts")
    everything = view(spark, sf_dir, "transactions_in")
    put(view(spark, sf_dir, "transactions_loaded"), folder, "transactions")

    first = DailyRun(spark, paths, DAY_ONE, "run1").run()
    valid = incremental.read_transactions(spark, paths.silver)
    assert first["gold"]["fact_transactions"] == valid.count() <= first["silver"]["transactions_inserted"]
    customers, accounts = first["silver"]["customers"], first["silver"]["accounts"]
    assert first["gold"]["dim_customers_inserted"] == customers and first["gold"]["dim_customers_updated"] == 0

    # The same files again: nothing changes but bronze.
    same = DailyRun(spark, paths, DAY_TWO, "run2")
    assert min(same.bronze().values()) > 0
    small = ("branches", "merchants", "customers", "accounts")
    assert same.silver() == {n: first["silver"][n] for n in small} | {"transactions_inserted": 0, "transactions_updated": 0}
    second = same.gold()
    assert second["fact_transactions"] == second["dim_customers_inserted"] == second["dim_accounts_updated"] == 0

    put(view(spark, sf_dir, "customers_day2"), folder, "customers")
    put(view(spark, sf_dir, "accounts_day2"), folder, "accounts")
    put(everything, folder, "transactions")
    third = DailyRun(spark, paths, DAY_THREE, "run3").run()
    assert third["gold"]["dim_customers_updated"] > 0 and third["gold"]["dim_accounts_inserted"] > 0

    fact = gold.read_fact(spark, paths.gold)
    ids = {r.transaction_id for r in fact.select("transaction_id").collect()}
    silver_ids = incremental.read_transactions(spark, paths.silver)
    assert ids == {r.transaction_id for r in silver_ids.select("transaction_id").collect()}
    assert fact.count() == len(ids)
    assert fact.select("transaction_key").distinct().count() == len(ids)

    # Everything a check may find in this data is an orphan or a wrong delivered flag, never a broken key.
    allowed = {"accounts.customer_id_orphan", "transactions.account_id_orphan", "accounts.branch_id_orphan",
               "fact_transactions.account_key_not_null"}
    assert set(third["quality"]) <= allowed

    dim = gold.read_type2(spark, paths.gold, scd.CUSTOMERS)
    closed = dim.filter("NOT scd_is_current")
    assert closed.count() == third["gold"]["dim_customers_updated"]
    assert as_set(closed.select("scd_start_date", "scd_end_date").distinct()) == {(DAY_ONE, DAY_THREE)}
    assert gold.read_snapshots(spark, paths.gold).count() > 0

    assert spark.sql("SELECT COUNT(*) AS n FROM dim_date").first().n == 2922
    by_type = "SELECT COUNT(*) AS n FROM fact_transactions JOIN dim_transaction_type USING (txn_type_key)"
    assert spark.sql(by_type).first().n == len(ids)
    assert spark.sql("SELECT COUNT(*) AS n FROM mart_fraud_signals").first().n == len(ids)

    # Repeating a finished run is harmless.
    again = DailyRun(spark, paths, DAY_THREE, "run3")
    assert set(again.bronze().values()) == {0}
    assert again.gold()["fact_transactions"] == 0
    assert gold.read_fact(spark, paths.gold).count() == len(ids)

    log = spark.read.schema(AUDIT_PIPELINE_RUNS).parquet(f"{paths.audit}/pipeline_runs")
    assert as_set(log.groupBy("status").count()) == {("success", 12)}
    exported = spark.read.option("header", True).csv(f"{paths.exports}/customer_360_20240401.csv")
    assert exported.count() == third["reports"]["customer_360"] == third["marts"]["customer_360"]


def test_failed_step_is_logged_and_raised(spark, tmp_path):
    run = DailyRun(spark, Paths(str(tmp_path / "raw"), str(tmp_path / "wh")), DAY_ONE, "x")
    assert set(run.bronze().values()) == {0}
    with pytest.raises(ValueError):
        run._logged("gold_load", "gold", lambda: (_ for _ in ()).throw(ValueError("boom")))
    row = spark.read.parquet(f"{run.paths.audit}/pipeline_runs").first()
    assert (row.status, row.error_message, row.batch_id) == ("failed", "boom", "x")


def test_uncommitted_version_is_not_seen(spark, tmp_path):
    from tellerlake.sources import tables

    root = str(tmp_path)
    schema = spark.range(1).schema
    for version in (1, 2):
        tables.overwrite(spark.range(3), f"{root}/t/version={version}")
    tables.commit(spark, root, "t", 1, "b1")
    assert tables.last_commit(spark, root, "t").version == 1
    assert tables.read_up_to(spark, root, "t", 1, schema).count() == 3
    assert tables.last_commit(spark, root, "other") is None


def test_view_of_one_row_group_is_spread_over_tasks(spark, tmp_path):
    rows = spark.range(0, 150_000, 1, 1).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ'2024-01-05 10:00:00' AS ts", "id % 900 AS user_id", "'click' AS event_type",
        "CAST(id AS DOUBLE) AS value", """CONCAT('{"k": ', id % 100, ', "h": "', MD5(CAST(id AS STRING)), '"}') AS props""",
    )
    rows.write.parquet(f"{tmp_path}/events.parquet")
    few, many = (view(spark, str(tmp_path), "feed_day1", spread=spread) for spread in (False, True))
    in_tasks = [df.select(F.spark_partition_id().alias("p")).distinct().count() for df in (few, many)]
    assert in_tasks[0] == 1 < in_tasks[1]
    assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()
