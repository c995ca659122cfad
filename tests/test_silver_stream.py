import pytest
from conftest import as_set
from pyspark.errors import StreamingQueryException
from test_incremental import BUSINESS, merge, put, rebuilt

from tellerlake.plans import incremental
from tellerlake.plans.standins import view
from tellerlake.sources import slices, tables
from tellerlake.streaming.silver_stream import merge_new_files


def test_three_drops_and_a_killed_merge_equal_the_batch_run(spark, sf_dir, tmp_path, monkeypatch):
    streamed, batch, landing = tmp_path / "stream", str(tmp_path / "batch"), tmp_path / "in"
    landing.mkdir()

    def drop(day):
        rows = view(spark, sf_dir, f"feed_day{day}").drop("_ingestion_ts", "_batch_id")
        rows.toPandas().to_csv(landing / f"day{day}.csv", index=False)

    def run():
        folders = (str(landing), f"{streamed}/bronze", f"{streamed}/silver", str(tmp_path / "state"))
        merge_new_files(spark, *folders, files_per_batch=1).awaitTermination()

    def rows():
        return as_set(incremental.read_transactions(spark, f"{streamed}/silver").select(BUSINESS))

    drop(1)
    run()
    first = rows()
    assert first == as_set(rebuilt(spark, streamed).select(BUSINESS))

    drop(2)
    with monkeypatch.context() as patched:
        patched.setattr(slices.Run, "commit", lambda *_, **__: 1 / 0)
        with pytest.raises(StreamingQueryException):
            run()
    held = tables.read_bronze(spark, f"{streamed}/bronze", "transactions").count()
    assert rows() == first

    drop(3)
    run()
    for n in (1, 2, 3):
        put(spark, batch, view(spark, sf_dir, f"feed_day{n}"), f"b{n}", n)
        merge(spark, batch, f"b{n}")
    assert rows() == as_set(incremental.read_transactions(spark, f"{batch}/silver").select(BUSINESS))
    bronze = tables.read_bronze(spark, f"{streamed}/bronze", "transactions")
    assert held < bronze.count() == tables.read_bronze(spark, f"{batch}/bronze", "transactions").count()
    snapshot = slices.last_snapshot(spark, f"{streamed}/silver")
    run()
    assert snapshot == slices.last_snapshot(spark, f"{streamed}/silver") == 3
