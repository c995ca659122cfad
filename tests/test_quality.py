import datetime

from conftest import as_set

from tellerlake.operators import quality


def results(df):
    return {r.check_name: (r.rows_checked, r.rows_failed, r.passed, r.details) for r in df.collect()}


def test_row_checks_in_one_pass(spark):
    df = spark.createDataFrame([("b", "long", 1.0), ("a", "longer", 1e20), (None, "x", None)], "k string, t string, n double")
    checks = [quality.not_null("k"), quality.fits_width("t", 3), quality.fits_type("n", "decimal(15,2)")]
    got = quality.row_checks("t", df, "k", checks)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert results(got) == {
        "k_not_null": (3, 1, False, "{}"),
        "t_width": (3, 2, False, '{"example":"a"}'),
        "n_precision": (3, 1, False, '{"example":"a"}'),
    }
    assert {str(r.failure_pct) for r in got.collect()} == {"33.33", "66.67"}


def test_unique(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert results(quality.unique_check("t", df, "k")) == {"k_unique": (4, 2, False, '{"example":"a"}')}


def test_foreign_keys_and_orphans(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert results(quality.foreign_key_check("t", child, "k", parent)) == {"k_foreign_key": (4, 2, False, '{"example":"x"}')}
    assert results(quality.foreign_key_check("t", child, "k", parent, nulls_fail=True))["k_orphan"][:2] == (4, 3)
    assert quality.orphan_count(child, parent, "k").first().n_orphans == 3
    assert quality.orphans(child, parent, "k").count() == 3


def test_broken_chain_is_found(spark):
    d = datetime.date
    rows = [("a", 1, d(2024, 1, 1), d(2024, 1, 2)), ("a", 2, d(2024, 1, 2), None), ("b", 1, d(2024, 1, 1), d(2024, 1, 3)),
            ("b", 2, d(2024, 1, 4), None), ("c", 2, d(2024, 1, 1), None)]
    dim = spark.createDataFrame(rows, "k string, scd_version int, scd_start_date date, scd_end_date date")
    assert results(quality.version_chain_check("t", dim, "k"))["k_version_chain"][:2] == (5, 2)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "k string, is_completed boolean, is_declined boolean")
    assert results(quality.unique_check("t", empty, "k"))["k_unique"][:3] == (0, 0, True)
    assert results(quality.row_checks("t", empty, "k", [quality.not_null("k")]))["k_not_null"][:3] == (0, 0, True)
    assert quality.decline_rate(empty).first().decline_rate_pct == 0
    assert quality.orphan_count(empty, empty, "k").first().n_orphans == 0


def test_decline_rate(spark):
    df = spark.createDataFrame([(True, False), (False, True), (None, None), (False, False)], "is_completed boolean, is_declined boolean")
    assert as_set(quality.decline_rate(df)) == {(4, 1, 1, 25.0)}


def test_constraints_in_one_pass(spark):
    rows = [("1", 1, 7), ("2", None, 8), (None, 3, None), ("0", 4, 8), ("9", 4, 7)]
    df = spark.createDataFrame(rows, "id string, a long, b int")
    parents = spark.createDataFrame([(1,), (3,), (3,)], "p long"), spark.createDataFrame([(7,)], "b int")
    foreign = [quality.ForeignKey("a", parents[0], "p"), quality.ForeignKey("b", parents[1], "b")]
    checks = quality.constraint_checks("t", df, "id", ["id", "a"], foreign)
    assert results(checks) == {
        "id_not_null": (5, 1, False, "{}"),
        "a_not_null": (5, 1, False, '{"example":"2"}'),
        "a_foreign_key": (5, 2, False, '{"example":"4"}'),
        "b_foreign_key": (5, 2, False, '{"example":"8"}'),
    }
    none = quality.constraint_checks("t", df.limit(0), "id", ["id"], foreign[:1])
    assert results(none) == {"id_not_null": (0, 0, True, "{}"), "a_foreign_key": (0, 0, True, "{}")}


def test_constraints_read_the_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id AS a", "id % 7 AS b", "CAST(id AS STRING) AS id").write.parquet(path)
    parent = spark.range(5)
    foreign = [quality.ForeignKey(c, parent, "id") for c in ("a", "b")]
    checks = quality.constraint_checks("t", spark.read.parquet(path), "id", ["a", "b"], foreign)
    assert checks._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert results(checks)["a_foreign_key"][:2] == (1000, 995)
