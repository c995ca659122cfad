import datetime

import pytest
from conftest import as_set, final_plan
from pyspark.sql import functions as F

from tellerlake.operators import changes, dims, facts, scd, snapshots
from tellerlake.operators.scd import Load
from tellerlake.plans import gold
from tellerlake.schemas import DIM_ACCOUNTS, DIM_BRANCHES, DIM_MERCHANTS
from tellerlake.sources import tables
from tellerlake.sources.slices import Run

D = datetime.date
LOAD = Load("b", D(2024, 2, 1), datetime.datetime(2024, 2, 1))
TXN = (
    "transaction_id string, account_id string, merchant_id string, transaction_type string, transaction_date date,"
    " transaction_time string, transaction_hour int, amount double, is_debit boolean, balance_after double,"
    " status string, is_fraud_flag boolean, fraud_score double, fraud_risk_band string, is_weekend boolean,"
    " is_night_transaction boolean, amount_band string, daily_txn_count bigint, daily_spend_total double,"
    " reference string, description string, channel string, transaction_year int, transaction_month int"
)


def frame(spark, schema, *rows):
    names = [f.strip().split()[0] for f in schema.split(",")] if isinstance(schema, str) else schema.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def txns(spark, *rows):
    base = {"transaction_type": "Purchase", "transaction_time": "10:00:00", "amount": 10.0, "is_debit": True,
            "status": "Completed", "balance_after": 1.0, "transaction_date": D(2024, 1, 10)}
    full = [{**base, **r} for r in rows]
    for r in full:
        if r["transaction_date"]:
            r |= {"transaction_year": r["transaction_date"].year, "transaction_month": r["transaction_date"].month}
    return frame(spark, TXN, *full)


def account(key, business_id, version=1, start=D(2024, 1, 1), end=None, **more):
    return {"account_key": key, "account_id": business_id, "scd_version": version, "scd_start_date": start,
            "scd_end_date": end, "scd_is_current": end is None, **more}


@pytest.fixture
def star(spark):
    accounts = frame(
        spark, DIM_ACCOUNTS,
        account(1, "a", 1, D(2024, 1, 1), D(2024, 1, 10), customer_key=11, branch_key=21),
        account(2, "a", 2, D(2024, 1, 10), D(2024, 1, 10), customer_key=12, branch_key=21),
        account(3, "a", 3, D(2024, 1, 10), None, customer_key=13, branch_key=21),
        account(4, "b", 1, customer_key=None, branch_key=99),
    )
    merchants = frame(spark, DIM_MERCHANTS, {"merchant_key": 31, "merchant_id": "m"})
    branches = frame(spark, DIM_BRANCHES, {"branch_key": 21, "branch_id": "x"})
    return accounts, merchants, dims.dim_transaction_type(spark), branches


def test_keys_resolve_and_unmatched_rows_stay(spark, star):
    rows = txns(
        spark,
        {"transaction_id": "1", "account_id": "a", "merchant_id": "m"},
        {"transaction_id": "2", "account_id": "b", "merchant_id": "unknown", "transaction_type": "Other", "reference": ""},
        {"transaction_id": "3", "account_id": None, "merchant_id": None},
    )
    got = facts.resolve_keys(rows, *star, LOAD)
    assert got.filter("reference IS NOT NULL").count() == 0
    columns = ("transaction_id", "account_key", "customer_key", "merchant_key", "branch_key", "txn_type_key", "date_key")
    assert as_set(got.select(*columns)) == {
        ("1", 3, 13, 31, 21, 1, 20240110), ("2", 4, None, None, None, None, 20240110), ("3", None, None, None, None, 1, 20240110),
    }


def test_as_of_takes_the_version_of_the_day(spark, star):
    days = {"1": D(2023, 12, 31), "2": D(2024, 1, 1), "3": D(2024, 1, 9), "4": D(2024, 1, 10), "5": D(2030, 1, 1)}
    rows = txns(spark, *({"transaction_id": n, "account_id": "a", "transaction_date": d} for n, d in days.items()))
    got = facts.resolve_keys(rows, *star, LOAD, versions="as_of").select("transaction_id", "account_key")
    assert as_set(got) == {("1", None), ("2", 1), ("3", 1), ("4", 3), ("5", 3)}


def test_money_is_rounded_once_and_what_does_not_fit_is_null(spark, star):
    rows = txns(spark, {"transaction_id": "1", "account_id": "a", "amount": 1.005, "balance_after": 1e15, "fraud_score": 0.1239})
    got = facts.resolve_keys(rows, *star, LOAD).first()
    assert (str(got.amount), got.balance_after, str(got.fraud_score)) == ("1.01", None, "0.124")


def test_drop_and_anti_join(spark):
    loaded = txns(spark, {"transaction_id": "1", "transaction_date": D(2024, 1, 5)}, {"transaction_id": "2", "transaction_date": D(2024, 1, 3)})
    incoming = loaded.unionByName(
        txns(spark, {"transaction_id": "late", "transaction_date": D(2024, 1, 4)}, {"transaction_id": "same_day", "transaction_date": D(2024, 1, 5)},
             {"transaction_id": "new", "transaction_date": D(2024, 2, 1)}, {"transaction_id": "undated", "transaction_date": None})
    )
    ids = lambda df: {r.transaction_id for r in df.collect()}
    assert ids(facts.not_yet_loaded(incoming, loaded, "drop")) == {"new"}
    taken = facts.not_yet_loaded(incoming, loaded, "anti_join")
    assert ids(taken) == {"late", "same_day", "new"}
    assert ids(facts.not_yet_loaded(incoming, loaded.unionByName(taken), "anti_join")) == set()
    assert ids(facts.not_yet_loaded(incoming, loaded.limit(0), "drop")) == ids(incoming) - {"undated"}


def test_every_row_takes_one_route(spark):
    rows = txns(spark, {"transaction_id": "1"}, {"transaction_id": "2", "transaction_date": None}, {"transaction_id": "3"},
                {"transaction_id": "4", "transaction_date": D(2024, 3, 1)}, {"transaction_id": "5", "transaction_date": None})
    known = spark.createDataFrame([("3",), ("5",), ("9",)], "transaction_id string")
    routes = lambda late: {r.transaction_id: r.route for r in facts.routed(rows, known, late, D(2024, 1, 10)).collect()}
    assert routes("anti_join") == {"1": "load", "2": "undated", "3": "known", "4": "load", "5": "known"}
    assert routes("drop") == {"1": "late", "2": "undated", "3": "known", "4": "load", "5": "known"}
    with pytest.raises(ValueError):
        facts.routed(rows, known, "x", D(2024, 1, 10))


def test_staged_facts_are_not_sorted_into_directories_of_routes(spark, tmp_path):
    rows = txns(spark, {"transaction_id": "1"}, {"transaction_id": "2", "transaction_date": None})
    taken = gold.load_facts(spark, str(tmp_path), rows, Load("b1", D(2024, 1, 31), datetime.datetime(2024, 5, 1)))
    assert (taken["n_rows"], taken["undated"]) == (1, 1)
    assert not [path for path in (tmp_path / "staging" / gold.FACT).iterdir() if path.is_dir()]
    assert as_set(gold.read_fact(spark, str(tmp_path)).select("transaction_id")) == {("1",)}
    assert as_set(gold.read_rejects(spark, str(tmp_path)).select("transaction_id", "reason")) == {("2", facts.UNDATED)}


def test_loads_route_reject_and_look_up_touched_blocks_only(spark, tmp_path):
    """Two loads with drop; rejects are kept, and a load that died before its commit leaves nothing behind."""
    root = str(tmp_path)
    far = str(1 << 21)  # another block of ids

    def load(batch, day, *rows):
        return gold.load_facts(spark, root, txns(spark, *rows), Load(batch, day, datetime.datetime(2024, 5, 1)), "drop")

    first = load("b1", D(2024, 1, 31), {"transaction_id": "1"}, {"transaction_id": "2", "transaction_date": None})
    assert (first["n_rows"], first["undated"], first["late"], first["known"]) == (1, 1, 0, 0)
    # A load that dies between the keys' commit and the fact's.
    dead = Run(spark, root, "dead", snapshot=2)
    dead.replace(spark.createDataFrame([("7",)], "transaction_id string"), gold.FACT_KEYS, changes.block_of(), ["0"])
    dead.commit()
    assert {r[0] for r in gold.read_fact_keys(spark, root, 1).collect()} == {"1"}
    second = load("b2", D(2024, 2, 28), {"transaction_id": "1"}, {"transaction_id": "4"}, {"transaction_id": far, "transaction_date": D(2024, 2, 5)},
                  {"transaction_id": "7", "transaction_date": D(2024, 2, 5)})
    assert (second["n_rows"], second["undated"], second["late"], second["known"]) == (2, 0, 1, 1)
    assert as_set(gold.read_fact(spark, root).select("transaction_id")) == {("1",), ("7",), (far,)}
    assert as_set(gold.read_rejects(spark, root).select("transaction_id", "reason", "dw_batch_id")) == {
        ("2", "undated", "b1"), ("4", "late", "b2"),
    }
    assert {r[0] for r in gold.read_fact_keys(spark, root, 2, {"2"}).collect()} == {far}
    assert load("b2", D(2024, 2, 28), {"transaction_id": "8"}) == {"n_rows": 0}
    nothing = load("b3", D(2024, 3, 1), {"transaction_id": "7", "transaction_date": D(2024, 2, 5)})
    assert nothing["n_rows"] == 0 and nothing["known"] == 1
    assert tables.last_commit(spark, root, gold.FACT).watermark == D(2024, 2, 5)
    assert not (tmp_path / gold.FACT / "version=3").exists()


def test_watermark_reaches_the_scan(spark, tmp_path):
    rows = txns(spark, *({"transaction_id": str(m), "transaction_date": D(2024, m, 5)} for m in range(1, 7)))
    path = str(tmp_path / "silver")
    rows.write.partitionBy("transaction_year", "transaction_month").parquet(path)
    stored = spark.read.parquet(path)
    newer = facts.newer_than(stored, D(2024, 4, 5)).select("transaction_id")
    plan = final_plan(newer)
    assert "PushedFilters: [IsNotNull(transaction_date), GreaterThan(transaction_date,2024-04-05)]" in plan
    assert "transaction_month" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    scan = newer._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() <= 3
    assert as_set(newer) == {("5",), ("6",)}


def test_hot_account_is_split_by_adaptive_execution(spark, star, tmp_path):
    """Two thirds of the facts on one account: the join must run in more tasks than there are keys."""
    rows = txns(spark, {"transaction_id": "1", "account_id": "a"}).drop("transaction_id", "account_id").crossJoin(
        spark.range(60_000).selectExpr("CAST(id AS STRING) AS transaction_id", "IF(id % 3 = 0, CONCAT('x', id), 'a') AS account_id")
    )
    path = str(tmp_path / "t")
    rows.repartition(8).write.parquet(path)
    tiny = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    accounts = star[0].repartition(2)
    try:
        for key, value in tiny.items():
            spark.conf.set(key, value)
        joined = facts.resolve_keys(spark.read.parquet(path), accounts, *star[1:], LOAD)
        plan = final_plan(joined)
        assert "skew=true" in plan
        assert joined.filter("account_key = 3").count() == 40_000
    finally:
        for key in tiny:
            spark.conf.unset(key)


def test_written_keys_are_unique(spark, tmp_path):
    rows = spark.range(1000).repartition(7)
    facts.with_written_keys(rows, "k", 41).write.parquet(str(tmp_path / "k"))
    stored = spark.read.parquet(str(tmp_path / "k"))
    low, distinct = stored.agg(F.min("k"), F.countDistinct("k")).first()
    assert low == 42 and distinct == 1000


def test_snapshots(spark, star):
    rows = txns(
        spark,
        {"transaction_id": "1", "account_id": "a", "transaction_time": "09:00:00", "balance_after": 5.0},
        {"transaction_id": "2", "account_id": "a", "transaction_time": "11:00:00", "balance_after": -7.0, "amount": 2.5},
        {"transaction_id": "3", "account_id": "a", "transaction_time": "11:00:00", "balance_after": -6.0, "is_debit": False},
        {"transaction_id": "4", "account_id": "a", "transaction_time": "23:00:00", "balance_after": 9.0, "status": "Failed"},
        {"transaction_id": "5", "account_id": "a", "transaction_date": D(2024, 1, 20), "balance_after": 3.0},
    )
    got = snapshots.account_snapshots(rows, star[0], LOAD)
    money = [f"CAST({c} AS DOUBLE)" for c in ("closing_balance", "opening_balance", "daily_credits", "daily_debits")]
    assert as_set(got.selectExpr("snapshot_date", "account_key", "customer_key", *money, "txn_count", "is_overdrawn")) == {
        (D(2024, 1, 10), 3, 13, -6.0, None, 10.0, 12.5, 3, True),
        (D(2024, 1, 20), 3, 13, 3.0, -6.0, 0.0, 10.0, 1, False),
    }


def test_current_account_keys(spark, star):
    silver = spark.createDataFrame([("a", "c1", "x"), ("b", "c9", None)], "account_id string, customer_id string, branch_id string")
    customers = spark.createDataFrame([(7, "c1", True), (6, "c1", False)], "customer_key bigint, customer_id string, scd_is_current boolean")
    got = scd.resolve_account_keys(silver, star[3], customers).select("account_id", "branch_key", "customer_key")
    assert as_set(got) == {("a", 21, 7), ("b", None, None)}
