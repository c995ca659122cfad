from conftest import as_set

from tellerlake.operators import dims, keys


def test_keys_are_dense_unique_and_stable(spark):
    rows = spark.range(5000).selectExpr("CONCAT('C', id) AS k", "id AS v")
    spread = [as_set(keys.number_rows(rows.repartition(n), "k", "sk")) for n in (1, 5, 13)]
    assert spread[0] == spread[1] == spread[2]
    assert sorted(row[2] for row in spread[0]) == list(range(1, 5001))


def test_assign_keys_continues_above_the_highest(spark):
    rows = spark.createDataFrame([("a", 5), ("b", None), ("c", 2), ("d", None)], "k string, sk bigint")
    got = dict(as_set(keys.assign_keys(rows, "k", "sk")))
    assert got["a"] == 5 and got["c"] == 2 and sorted((got["b"], got["d"])) == [6, 7]


def test_empty_input(spark):
    rows = spark.createDataFrame([], "k string, sk bigint")
    assert keys.assign_keys(rows, "k", "sk").count() == 0
    assert keys.next_id_number(rows, "k").first().next_number == 1


def test_transaction_types_keep_existing_rows(spark):
    seeded = dims.dim_transaction_type(spark)
    assert sorted(r.txn_type_key for r in seeded.collect()) == list(range(1, 9))
    existing = spark.createDataFrame([(40, "Reversal", "Own", "DEBIT")], seeded.schema)
    merged = {r.txn_type_name: r for r in dims.dim_transaction_type(spark, existing).collect()}
    assert len(merged) == 8
    assert merged["Reversal"].txn_category == "Own"
    assert sorted(r.txn_type_key for r in merged.values()) == [40, *range(41, 48)]


def test_calendar_size(spark):
    days = dims.dim_date(spark)
    assert days.count() == 2922
    assert days.select("date_key").distinct().count() == 2922
