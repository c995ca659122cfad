import datetime

import pytest
from conftest import as_set

from tellerlake.schemas import bronze_schema
from tellerlake.sources import raw, reports, tables
from tellerlake.streaming.bronze_stream import ingest_new_files

HEADER = "branch_id,branch_name,city,province,region,opened_date,is_active"
AT = datetime.datetime(2024, 2, 1, 12, 30, 5)


def write(path, lines, header=HEADER):
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_missing_file_is_skipped(spark, tmp_path):
    assert raw.read_raw(spark, "branches", str(tmp_path / "none.csv")) is None


def test_missing_column_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="is_active"):
        raw.read_raw(spark, "branches", write(tmp_path / "b.csv", ["1,a,b,c,d,e"], HEADER.rsplit(",", 1)[0]))


def test_tokens_quotes_and_column_order(spark, tmp_path):
    header = "branch_name,branch_id,city,province,region,opened_date,is_active,extra"
    lines = ['"Say ""hi"", twice",1,NA,"",None,2020-01-01,True,e', "n/a,2,nan,x,N/A,NULL,False,"]
    rows = raw.read_raw(spark, "branches", write(tmp_path / "b.csv", lines, header))
    assert as_set(rows.select("branch_id", "branch_name", "city", "province", "region", "opened_date", "extra")) == {
        ("1", 'Say "hi", twice', None, None, None, "2020-01-01", "e"),
        ("2", None, None, "x", None, None, None),
    }


def test_row_numbers_follow_the_file_over_many_splits(spark, tmp_path):
    """Two files cut into dozens of splits: every number must be the line's place in its file."""
    for name, n in (("one", 20_000), ("two", 7_001)):
        write(tmp_path / f"{name}.csv", [f"{i},{'x' * (i % 37)},c,p,r,2020-01-01,True" for i in range(1, n + 1)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        rows = raw.read_raw(spark, "branches", str(tmp_path / "*.csv"))
        assert rows.rdd.getNumPartitions() > 20
        assert rows.filter("CAST(branch_id AS BIGINT) <> _source_row_number").count() == 0
        assert as_set(rows.groupBy("_source_file").count()) == {("one.csv", 20_000), ("two.csv", 7_001)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def records_of(spark, path):
    rows = raw.read_raw(spark, "branches", path).select("_source_row_number", "branch_id", "branch_name", "is_active")
    bad = raw.read_rejects(spark, "branches", path).select("source_row_number", "reason", "record")
    return as_set(rows), as_set(bad)


def test_records_over_lines_and_malformed_ones(spark, tmp_path):
    lines = ['1,"a\nb",c,p,r,d,True', "", "2,short", '3,n,c,p,r,d,True,"l,ong"', '4,n,c,p,r,d,"q\n\n1,2,3,4,5,6,7\nz"',
             '5,"a""b, ",c,p,r,d,False', "   ", '6,"open,c,p,r,d,x', "7,n,c,p,r,d,True"]
    rows, bad = records_of(spark, write(tmp_path / "b.csv", lines))
    assert rows == {(1, "1", "a\nb", "True"), (4, "4", "n", "q\n\n1,2,3,4,5,6,7\nz"), (5, "5", 'a"b, ', "False"), (7, "7", "n", "True")}
    assert bad == {
        (2, "few fields", "2,short"), (3, "many fields", lines[3]), (6, "open quote", '6,"open,c,p,r,d,x'),
    }


def test_records_that_cross_splits(spark, tmp_path):
    """Multi-line records all over two files cut into dozens of splits, beside a file of plain lines."""
    def line(i):
        name = f'"{"x" * (i % 37)}\n{i},b,c,p,r,d,True\n\n""y"""' if i % 3 == 0 else "x" * (i % 11)
        return f"{i},{name},c,p,r,2020-01-01,True"

    for name, n in (("one", 9_000), ("two", 4_000)):
        write(tmp_path / f"{name}.csv", [line(i) for i in range(1, n + 1)])
    write(tmp_path / "plain.csv", [f"{i},x,c,p,r,d,True" for i in range(1, 3_001)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        rows = raw.read_raw(spark, "branches", str(tmp_path / "*.csv"))
        assert rows.filter("CAST(branch_id AS BIGINT) <> _source_row_number").count() == 0
        assert as_set(rows.groupBy("_source_file").count()) == {("one.csv", 9_000), ("two.csv", 4_000), ("plain.csv", 3_000)}
        assert rows.filter("branch_name LIKE '%\n\n\"y\"'").count() == 3_000 + 1_333
        assert raw.read_rejects(spark, "branches", str(tmp_path / "*.csv")).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_stray_quote_takes_no_other_record(spark, tmp_path):
    lines = [f'{i},{chr(34) if i in (5, 2_000) else ""}n,c,p,r,d,True' for i in range(1, 3_001)]
    rows, bad = records_of(spark, write(tmp_path / "b.csv", lines))
    assert len(rows) == 2_998 and {number for number, *_ in rows} == set(range(1, 3_001)) - {5, 2_000}
    assert bad == {(i, "open quote", lines[i - 1]) for i in (5, 2_000)}


def test_another_header_is_an_error(spark, tmp_path):
    write(tmp_path / "a.csv", ["1,a,b,c,d,e,True"])
    write(tmp_path / "b.csv", ["a,1,b,c,d,e,True"], "branch_name,branch_id,city,province,region,opened_date,is_active")
    with pytest.raises(Exception, match="another header"):
        raw.read_raw(spark, "branches", str(tmp_path / "*.csv")).collect()


def test_empty_file_and_header_only(spark, tmp_path):
    assert records_of(spark, write(tmp_path / "b.csv", [])) == (set(), set())


def test_ingest_keeps_rejects_once(spark, tmp_path):
    path, bronze = write(tmp_path / "branches.csv", ["1,a,b,c,d,e,True", "2,short"]), str(tmp_path / "bronze")
    assert raw.ingest(spark, "branches", path, bronze, "b1", AT) == 1
    assert raw.ingest(spark, "branches", path, bronze, "b1", AT) == 0
    assert raw.ingest(spark, "branches", path, bronze, "b2", AT) == 1
    kept = spark.read.parquet(f"{bronze}/{tables.BRONZE_REJECTS}").select("table_name", "batch", "source_row_number", "record")
    assert sorted(tuple(r) for r in kept.collect()) == [("branches", "b1", 2, "2,short"), ("branches", "b2", 2, "2,short")]


def test_rows_are_not_shuffled_for_numbering(spark, tmp_path):
    rows = raw.read_raw(spark, "branches", write(tmp_path / "b.csv", ["1,a,b,c,d,e,True"]))
    streamed_side = rows._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    assert "Exchange" not in streamed_side


def test_a_batch_without_rows_counts_none(spark, tmp_path):
    path, bronze = write(tmp_path / "branches.csv", ["1,a,b,c,d,2020-01-01,True"]), str(tmp_path / "bronze")
    rows = raw.with_lineage(raw.read_raw(spark, "branches", path), "b1", AT)
    assert tables.append_bronze(rows.limit(0), bronze, "branches", "b1") == 0
    assert tables.append_bronze(rows, bronze, "branches", "b1") == 1
    assert tables.append_bronze(rows, bronze, "branches", "b2") == 1


def test_lineage_and_append(spark, tmp_path):
    path, bronze = write(tmp_path / "branches.csv", ["1,a,b,c,d,2020-01-01,True", "2,a,b,c,d,2020-01-01,True"]), str(tmp_path / "bronze")

    def ingest(batch, at):
        return tables.append_bronze(raw.with_lineage(raw.read_raw(spark, "branches", path), batch, at), bronze, "branches", batch)

    assert ingest("b1", AT) == 2
    assert ingest("b1", AT) is None
    assert ingest("b2", AT + datetime.timedelta(days=1)) == 2
    stored = tables.read_bronze(spark, bronze, "branches")
    assert stored.schema == bronze_schema("branches")
    columns = ("branch_id", "_source_file", "_batch_id", "_ingestion_ts", "_ingestion_date", "_source_row_number", "date")
    day = AT.date()
    assert as_set(stored.filter("_batch_id = 'b1'").select(*columns)) == {
        ("1", "branches.csv", "b1", "2024-02-01T12:30:05", "2024-02-01", 1, day),
        ("2", "branches.csv", "b1", "2024-02-01T12:30:05", "2024-02-01", 2, day),
    }
    assert stored.count() == 4


def test_stream_takes_each_file_once(spark, tmp_path):
    landing, bronze, state = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "state")
    landing.mkdir()

    def run():
        ingest_new_files(spark, "branches", str(landing), bronze, state).awaitTermination()
        return as_set(tables.read_bronze(spark, bronze, "branches").select("branch_id", "_source_file", "_source_row_number"))

    write(landing / "a.csv", ["1,a,b,c,d,e,True", "2,a,b,c,d,e,True"])
    assert run() == {("1", "a.csv", 1), ("2", "a.csv", 2)}
    write(landing / "b.csv", ["3,a,b,c,d,e,True"])
    assert run() == {("1", "a.csv", 1), ("2", "a.csv", 2), ("3", "b.csv", 1)}
    assert len(run()) == 3
    batches = {r._batch_id for r in tables.read_bronze(spark, bronze, "branches").collect()}
    assert len(batches) == 2 and not any(b.startswith("None") for b in batches)

    # A new checkpoint reads everything again, under batch ids of its own.
    state = str(tmp_path / "other")
    assert len(run()) == 3
    assert tables.read_bronze(spark, bronze, "branches").count() == 6


def test_report_files_and_failures(spark, tmp_path):
    day = datetime.date(2024, 2, 1)
    good = spark.createDataFrame([(1, "x")], "a int, b string")

    def broken():
        raise ValueError("no such mart")

    outcome = reports.export_all({"bad": broken, "good": lambda: good}, str(tmp_path), day, bounded={"good"})
    assert outcome["good"] == 1 and isinstance(outcome["bad"], ValueError)
    files = list((tmp_path / "good_20240201.csv").glob("part-*.csv"))
    assert [f.read_text() for f in files] == ["a,b\n1,x\n"]


def test_append_new_ids(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("1", "a"), ("2", "a")], "k string, v string")
    second = spark.createDataFrame([("2", "b"), ("3", "b")], "k string, v string")
    assert tables.append_new_ids(first, path, "k") == 2
    assert tables.append_new_ids(second, path, "k") == 1
    assert as_set(spark.read.parquet(path)) == {("1", "a"), ("2", "a"), ("3", "b")}
    assert tables.append_new_ids(second, path, "k") == 0
    assert tables.append_new_ids(second, path) == 2
    assert as_set(spark.read.parquet(path)) == as_set(second)
    assert tables.append_new_ids(first, path, "k", fresh=True) == 2
    assert as_set(spark.read.parquet(path)) == as_set(first)
