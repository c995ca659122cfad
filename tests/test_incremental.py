import datetime

import pyarrow.parquet as pq
import pytest
from conftest import as_set

from tellerlake.operators import changes, silver
from tellerlake.plans import incremental
from tellerlake.plans.standins import view
from tellerlake.sources import raw, slices, tables

BUSINESS = ["transaction_id", "account_id", "amount", "status", "transaction_date", "is_declined",
                        "amount_band", "daily_txn_count", "daily_spend_total"]


def put(spark, root, rows, batch, day):
    """One bronze batch from the rows of a stand-in view."""
    plain = rows.drop("_ingestion_ts", "_batch_id").selectExpr("*", "'f.csv' AS _source_file", "1L AS _source_row_number")
    stamped = raw.with_lineage(plain, batch, datetime.datetime(2024, 5, day))
    tables.append_bronze(stamped, f"{root}/bronze", "transactions", batch)


def rebuilt(spark, root):
    return silver.transactions(tables.read_bronze(spark, f"{root}/bronze", "transactions"))


def merge(spark, root, batch, **more):
    return incremental.merge_transactions(spark, f"{root}/bronze", f"{root}/silver", batch, **more)


@pytest.fixture
def feeds(spark, sf_dir):
    return {n: view(spark, sf_dir, f"feed_day{n}") for n in (1, 2, 3)}


def test_three_days_equal_a_rebuild(spark, tmp_path, feeds):
    root = str(tmp_path)
    seen = 0
    for n, feed in feeds.items():
        put(spark, root, feed, f"b{n}", n)
        got = merge(spark, root, f"b{n}")
        assert got["inserted"] > 0 and (got["updated"] > 0) == (n == 3)
        seen += got["inserted"]
        mine = incremental.read_transactions(spark, f"{root}/silver")
        full = rebuilt(spark, root)
        assert mine.schema.simpleString() == full.schema.simpleString()
        assert as_set(mine.select(BUSINESS)) == as_set(full.select(BUSINESS))
        assert mine.count() == full.count()
    keys = slices.read(spark, f"{root}/silver", incremental.KEYS, spark.createDataFrame([], changes.KEY_COLUMNS).schema)
    assert keys.count() == seen == keys.select("transaction_id").distinct().count()
    assert merge(spark, root, "b3") == {"inserted": 0, "updated": 0}
    # The same files again: nothing is written but the commit.
    put(spark, root, feeds[3], "b4", 4)
    before = slices.current(spark, f"{root}/silver", incremental.TRANSACTIONS)
    assert merge(spark, root, "b4") == {"inserted": 0, "updated": 0}
    assert slices.current(spark, f"{root}/silver", incremental.TRANSACTIONS) == before
    # Each snapshot stays readable.
    first = incremental.read_transactions(spark, f"{root}/silver", snapshot=1)
    assert first.filter("status <> 'Completed'").count() > 0 and first.count() < seen


def test_a_day_reads_and_writes_only_what_it_touches(spark, tmp_path, feeds):
    root = str(tmp_path)
    put(spark, root, feeds[1], "b1", 1)
    merge(spark, root, "b1")
    one = feeds[3].filter("transaction_date >= '2024-04-01'").orderBy("transaction_id").limit(5)
    put(spark, root, one, "b2", 2)
    merge(spark, root, "b2")
    now = slices.current(spark, f"{root}/silver", incremental.TRANSACTIONS)
    assert now["2024-01"] == now["2024-02"] == 1 and now["2024-04"] == 2
    rewritten = [p for p in incremental.read_transactions(spark, f"{root}/silver").inputFiles() if "snapshot=2" in p]
    assert rewritten and all("slice=2024-04" in p for p in rewritten)


def test_files_are_sorted_and_an_account_is_in_few_row_groups(spark, tmp_path, feeds):
    root = str(tmp_path)
    put(spark, root, feeds[1], "b1", 1)
    spark.conf.set("parquet.block.size", "4096")
    spark.conf.set("parquet.page.size.row.check.min", "10")
    spark.conf.set("parquet.page.size.row.check.max", "10")
    try:
        merge(spark, root, "b1")
    finally:
        for name in ("parquet.block.size", "parquet.page.size.row.check.min", "parquet.page.size.row.check.max"):
            spark.conf.unset(name)
    files = [p.removeprefix("file:").replace("//", "") for p in incremental.read_transactions(spark, f"{root}/silver").inputFiles()]
    touched = groups = 0
    for path in files:
        file = pq.ParquetFile(path)
        rows = file.read(columns=list(incremental.SORTED_BY)).to_pylist()
        keys = [tuple((v is not None, v) for v in row.values()) for row in rows]
        assert keys == sorted(keys)
        place = file.schema_arrow.get_field_index("account_id")
        wanted = rows[len(rows) // 2]["account_id"]
        for k in range(file.num_row_groups):
            held = file.metadata.row_group(k).column(place).statistics
            touched += held is not None and held.min <= wanted <= held.max
        groups += file.num_row_groups
    assert len(files) <= touched <= 2 * len(files) < groups


@pytest.mark.parametrize("step", ["replace", "commit"])
def test_a_killed_merge_leaves_the_last_snapshot_and_can_be_repeated(spark, tmp_path, feeds, monkeypatch, step):
    root = str(tmp_path)
    for n in (1, 2):
        put(spark, root, feeds[n], f"b{n}", n)
    merge(spark, root, "b1")
    put(spark, root, feeds[3], "b3", 3)
    before = as_set(incremental.read_transactions(spark, f"{root}/silver").select(BUSINESS))
    real, calls = getattr(slices.Run, step), []

    def dies(self, *args, **more):
        calls.append(args)
        if step == "commit" or len(calls) == 2:
            raise RuntimeError("killed")
        return real(self, *args, **more)

    monkeypatch.setattr(slices.Run, step, dies)
    with pytest.raises(RuntimeError):
        merge(spark, root, "b3")
    monkeypatch.undo()
    assert as_set(incremental.read_transactions(spark, f"{root}/silver").select(BUSINESS)) == before
    merge(spark, root, "b3")
    assert as_set(incremental.read_transactions(spark, f"{root}/silver").select(BUSINESS)) == as_set(
        rebuilt(spark, root).select(BUSINESS)
    )


def test_an_older_batch_makes_a_rebuild(spark, tmp_path, feeds):
    root = str(tmp_path)
    put(spark, root, feeds[3], "b3", 3)
    merge(spark, root, "b3")
    put(spark, root, feeds[1], "b1", 1)
    put(spark, root, feeds[2], "b2", 2)
    merge(spark, root, "late")
    assert as_set(incremental.read_transactions(spark, f"{root}/silver").select(BUSINESS)) == as_set(
        rebuilt(spark, root).select(BUSINESS)
    )


def test_rows_that_move_to_another_day_and_ids_without_number(spark, tmp_path):
    root = str(tmp_path)
    columns = [
        "transaction_id", "account_id", "merchant_id", "transaction_type", "channel", "amount", "is_debit", "currency",
        "balance_after", "transaction_date", "transaction_time", "reference", "description", "status", "is_fraud_flag",
        "fraud_score", "is_weekend", "is_holiday_season",
    ]

    def rows(*given):
        return spark.createDataFrame(
            [tuple({"amount": "1.00", "is_debit": "True", "status": "Completed", **g}.get(c) for c in columns) for g in given],
            ", ".join(f"{c} string" for c in columns),
        )

    days = {
        1: [{"transaction_id": i, "account_id": "a", "transaction_date": "2024-01-05"} for i in ("T1", "T2", "odd", "T3")]
        + [{"transaction_id": "T9", "account_id": None, "transaction_date": "bad"}, {"transaction_id": None}],
        2: [{"transaction_id": "T1", "account_id": "a", "transaction_date": "2024-03-05"},
            {"transaction_id": "odd", "account_id": "b", "transaction_date": "2024-01-05", "amount": "-1"}],
        3: [{"transaction_id": i, "account_id": "a", "transaction_date": "2024-02-01"} for i in ("T2", "T3")]
        + [{"transaction_id": "T10", "account_id": None, "transaction_date": None}],
    }
    for n, given in days.items():
        put(spark, root, rows(*given), f"b{n}", n)
        merge(spark, root, f"b{n}")
        mine = incremental.read_transactions(spark, f"{root}/silver").select(BUSINESS)
        assert as_set(mine) == as_set(rebuilt(spark, root).select(BUSINESS))
    now = {r.transaction_id: (r.daily_txn_count, str(r.daily_spend_total)) for r in mine.collect()}
    assert now == {"T1": (1, "1.00"), "T2": (2, "2.00"), "T3": (2, "2.00"), "T9": (2, "2.00"), "T10": (2, "2.00")}
    assert "2024-01" in slices.current(spark, f"{root}/silver", incremental.TRANSACTIONS)
