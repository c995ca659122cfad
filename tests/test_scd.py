import datetime
from dataclasses import replace

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tellerlake.operators import keys, quality, scd
from tellerlake.operators.scd import Load
from tellerlake.plans import gold
from tellerlake.session import materialise

DAYS = [datetime.date(2024, 1, d) for d in (1, 2, 3)]
LOADS = [Load(f"b{i}", day, datetime.datetime(2024, 1, 1)) for i, day in enumerate(DAYS)]
COLUMNS = "account_id customer_key customer_id account_type account_number currency credit_limit interest_rate".split()
COLUMNS += "overdraft_limit status open_date close_date account_age_days branch_key".split()


def accounts(spark, *rows):
    kinds = {"customer_key": "bigint", "branch_key": "bigint", "account_age_days": "int", "open_date": "date",
             "close_date": "date", "credit_limit": "double", "interest_rate": "double", "overdraft_limit": "double"}
    schema = ", ".join(f"{n} {kinds.get(n, 'string')}" for n in COLUMNS)
    base = {"status": "Active", "interest_rate": 1.5, "currency": "ZAR"}
    return spark.createDataFrame([tuple({**base, **r}.get(n) for n in COLUMNS) for r in rows], schema)


def apply(spark, dim, incoming, load):
    """The whole dimension after a load, and the outcome of each current key."""
    if dim is None:
        rows = scd.first_rows(incoming, scd.ACCOUNTS, load).drop("account_key")
        return materialise(keys.number_rows(rows, "account_id", "account_key").select(scd.ACCOUNTS.schema.names)), None
    merged = materialise(scd.scd2_merge(scd.current_rows(dim), incoming, scd.ACCOUNTS, load))
    keyed = keys.assign_keys(merged, "account_id", "account_key")
    return materialise(dim.filter("NOT scd_is_current").unionByName(keyed.drop("_action"))), keyed


def outcome(keyed):
    return as_set(keyed.select("account_id", "_action", "scd_version", "scd_is_current"))


def test_versions(spark):
    one, _ = apply(spark, None, accounts(spark, {"account_id": "same"}, {"account_id": "new_status"},
                                         {"account_id": "gone"}, {"account_id": "untracked", "account_type": "A"}), LOADS[0])
    two, keyed = apply(spark, one, accounts(spark, {"account_id": "same"}, {"account_id": "new_status", "status": "Closed"},
                                            {"account_id": "untracked", "account_type": "B"}, {"account_id": "fresh"}), LOADS[1])
    assert outcome(keyed) == {
        ("same", "keep", 1, True), ("gone", "keep", 1, True), ("untracked", "keep", 1, True),
        ("fresh", "insert", 1, True), ("new_status", "expire", 1, False), ("new_status", "update", 2, True),
    }
    closed = two.filter("NOT scd_is_current").first()
    assert (closed.scd_start_date, closed.scd_end_date) == (DAYS[0], DAYS[1])
    assert two.filter("account_id = 'untracked'").first().account_type == "A"
    opened = two.filter("account_id = 'new_status' AND scd_is_current").first()
    assert (opened.scd_start_date, opened.scd_end_date, opened.dw_batch_id) == (DAYS[1], None, "b1")
    assert sorted(r.account_key for r in two.collect()) == list(range(1, 7))


@pytest.mark.parametrize(
    "before, after, action",
    [
        ({"credit_limit": None}, {"credit_limit": None}, "keep"),
        ({"credit_limit": None}, {"credit_limit": 0.0}, "keep"),
        ({"credit_limit": 5.0}, {"credit_limit": 5.001}, "keep"),
        ({"credit_limit": 5.0}, {"credit_limit": 5.01}, "update"),
        ({"overdraft_limit": 1.0}, {"overdraft_limit": None}, "update"),
        ({"status": None}, {"status": None}, "keep"),
        ({"status": None}, {"status": "Active"}, "update"),
        ({"interest_rate": 1.5}, {"interest_rate": 1.25}, "update"),
    ],
)
def test_what_counts_as_a_change(spark, before, after, action):
    one, _ = apply(spark, None, accounts(spark, {"account_id": "x", **before}), LOADS[0])
    _, keyed = apply(spark, one, accounts(spark, {"account_id": "x", **after}), LOADS[1])
    assert {row[1] for row in outcome(keyed)} == ({"keep"} if action == "keep" else {"update", "expire"})


def test_repeating_a_load_changes_nothing(spark):
    rows = accounts(spark, {"account_id": "a"}, {"account_id": "b", "status": "Closed"})
    one, _ = apply(spark, None, accounts(spark, {"account_id": "a"}, {"account_id": "b"}), LOADS[0])
    two, _ = apply(spark, one, rows, LOADS[1])
    three, keyed = apply(spark, two, rows, LOADS[2])
    assert as_set(three) == as_set(two)
    assert {row[1] for row in outcome(keyed)} == {"keep"}


def test_two_changes_on_one_day(spark):
    one, _ = apply(spark, None, accounts(spark, {"account_id": "a"}), LOADS[0])
    two, _ = apply(spark, one, accounts(spark, {"account_id": "a", "status": "Closed"}), LOADS[1])
    again = replace(LOADS[1], batch_id="later")
    three, _ = apply(spark, two, accounts(spark, {"account_id": "a", "status": "Dormant"}), again)
    versions = as_set(three.select("scd_version", "status", "scd_start_date", "scd_end_date"))
    assert versions == {(1, "Active", DAYS[0], DAYS[1]), (2, "Closed", DAYS[1], DAYS[1]), (3, "Dormant", DAYS[1], None)}
    assert quality.version_chain_check("d", three, "account_id").first().passed
    assert quality.one_current_check("d", three, "account_id").first().passed


def test_random_loads_keep_chains_whole(spark):
    import random

    pick, dim = random.Random(5), None
    for step, load in enumerate(LOADS):
        rows = [{"account_id": str(i), "status": pick.choice("ABC")} for i in range(60) if step == 0 or pick.random() < 0.8]
        dim, _ = apply(spark, dim, accounts(spark, *rows), load)
        current = {r.account_id: r.status for r in dim.filter("scd_is_current").collect()}
        assert all(current[row["account_id"]] == row["status"] for row in rows)
        assert quality.version_chain_check("d", dim, "account_id").first().passed
        assert quality.unique_check("d", dim, "account_key").first().passed
    assert len(current) == 60


def test_type1_keeps_fixed_columns_and_keys(spark):
    names = "branch_id string, branch_name string, city string, province string, region string, opened_date date, is_active boolean"
    old = spark.createDataFrame([("1", "Old", "c", "p", "r", DAYS[0], True), ("2", "Gone", "c", "p", "r", DAYS[0], True)], names)
    new = spark.createDataFrame([("1", "New", "c2", "p", "r", DAYS[2], False), ("3", "Added", "c", "p", "r", DAYS[2], True)], names)
    rows = scd.first_rows(old, scd.BRANCHES, LOADS[0]).drop("branch_key")
    dim = keys.number_rows(rows, "branch_id", "branch_key").select(scd.BRANCHES.schema.names)
    before = {r.branch_id: r.branch_key for r in dim.collect()}
    merged = keys.assign_keys(scd.scd1_merge(dim, new, scd.BRANCHES, LOADS[1]), "branch_id", "branch_key")
    got = {r.branch_id: r for r in merged.collect()}
    assert {k: r._action for k, r in got.items()} == {"1": "update", "2": "keep", "3": "insert"}
    assert (got["1"].branch_name, got["1"].opened_date, got["1"].is_active) == ("New", DAYS[0], False)
    assert [got[k].dw_batch_id for k in "123"] == ["b1", "b0", "b1"]
    assert got["1"].branch_key == before["1"] and got["3"].branch_key == 3


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="status"):
        scd.first_rows(accounts(spark, {"account_id": "x"}).drop("status"), scd.ACCOUNTS, LOADS[0])


def test_merge_reads_each_side_once(spark):
    one = accounts(spark, {"account_id": "a"})
    dim = scd.first_rows(one, scd.ACCOUNTS, LOADS[0]).withColumn("account_key", F.lit(1).cast("long"))
    plan = scd.scd2_merge(dim, one, scd.ACCOUNTS, LOADS[1])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Join") == 1


def test_stored_load_never_gives_a_key_twice(spark, tmp_path):
    """The row with the highest key is closed on day two while new ids come on days two and three."""
    root = str(tmp_path)
    names = [f"A{i}" for i in range(1, 6)]
    before = gold.load_dimension(spark, root, scd.ACCOUNTS, accounts(spark, *({"account_id": n} for n in names)), LOADS[0])
    assert before["max_key"] == 5
    highest = gold.read_type2(spark, root, scd.ACCOUNTS).filter("account_key = 5").first().account_id
    changed = [{"account_id": n, "status": "Closed" if n == highest else "Active"} for n in names]
    gold.load_dimension(spark, root, scd.ACCOUNTS, accounts(spark, *changed, {"account_id": "A8"}), LOADS[1])
    third = accounts(spark, *changed[:2], {"account_id": "A9"}, {"account_id": "A8", "status": "Closed"})
    gold.load_dimension(spark, root, scd.ACCOUNTS, third, LOADS[2])
    stored = gold.read_type2(spark, root, scd.ACCOUNTS)
    assert stored.count() == stored.select("account_key").distinct().count() == 9
    assert stored.filter("scd_is_current").count() == 7
    # an older batch again, after newer ones, changes nothing
    assert gold.load_dimension(spark, root, scd.ACCOUNTS, accounts(spark, {"account_id": "A1"}), LOADS[0])["n_rows"] == 0


def test_stored_load_refuses_a_key_that_comes_twice(spark, tmp_path):
    with pytest.raises(ValueError, match="comes 2 times"):
        gold.load_dimension(spark, str(tmp_path), scd.ACCOUNTS, accounts(spark, *[{"account_id": "A1"}] * 2), LOADS[0])


def test_stored_load_computes_what_comes_in_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(text):
        seen.add(1)
        return text

    noted = F.udf(counted).asNondeterministic()(F.col("account_id"))
    incoming = accounts(spark, {"account_id": "A1"}, {"account_id": "A2"}).withColumn("account_id", noted)
    for load in LOADS:
        gold.load_dimension(spark, str(tmp_path), scd.ACCOUNTS, incoming, load)
    assert seen.value == 2 * len(LOADS)
