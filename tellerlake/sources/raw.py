"""Raw CSV files: records, also over several lines, lineage, exact row numbers, and what is malformed."""

import datetime
import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tellerlake import schemas
from tellerlake.functions.casts import null_tokens_to_null
from tellerlake.schemas import day_literal, text_literal
from tellerlake.session import materialise, path_exists
from tellerlake.sources import tables

log = logging.getLogger(__name__)

# File of each raw table inside the raw folder (fixed values).
SOURCE_FILES = {
    "branches": "branches.csv",
    "merchants": "merchants.csv",
    "customers": "customers.csv",
    "accounts": "accounts.csv",
    "transactions": "transactions.csv",
}

# A quote that is not closed within so many lines is taken for a stray one, not for a record that long.
LONGEST_RECORD = 1000

_QUOTES = """(LENGTH({0}) - LENGTH(REPLACE({0}, '"', '')))"""


def header_of(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names in the first line of the first file."""
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


def read_raw(
    spark: SparkSession, table: str, path: str | list[str], seen: Observation | None = None
) -> DataFrame | None:
    """A raw table with null tokens cleared and records numbered per file, or None if it is missing.

    A file lacking one of the table's columns, or with another header than the first, is an error;
    additional columns are kept. Malformed records are left out, see :func:`read_rejects`; ``seen``
    observes their number as ``n_rejected`` when the rows are written.
    """
    records = _records(spark, table, path)
    if records is None:
        return None
    names, parsed = records
    if seen is not None:
        parsed = parsed.observe(seen, F.expr("COUNT(_reason) AS n_rejected"))
    return parsed.filter("_reason IS NULL").selectExpr(
        *(f"{null_tokens_to_null(f'_cells.c{k}')} AS `{name}`" for k, name in enumerate(names)),
        "_source_file",
        "_source_row_number",
    )


def read_rejects(spark: SparkSession, table: str, path: str | list[str]) -> DataFrame | None:
    """The malformed records of a raw table: file, number, reason and text; None if it is missing.

    ``open quote``: a quote that nothing closes. ``few fields`` and ``many fields``: not one field for
    each column of the header.
    """
    records = _records(spark, table, path)
    if records is None:
        return None
    return records[1].filter("_reason IS NOT NULL").selectExpr(
        f"{text_literal(table)} AS table_name",
        "_source_file AS source_file",
        "_source_row_number AS source_row_number",
        "_reason AS reason",
        "value AS record",
    )


def _records(spark: SparkSession, table: str, path: str | list[str]) -> tuple[list[str], DataFrame] | None:
    """Column names, and (value, _cells, _reason, _source_file, _source_row_number) for each record."""
    if isinstance(path, str) and not path_exists(spark, path):
        log.warning("no file for %s, skipping: %s", table, path)
        return None
    names = header_of(spark, path)
    missing = [name for name in schemas.RAW_COLUMNS[table] if name not in names]
    if missing:
        raise ValueError(f"{path} lacks columns: {', '.join(missing)}")
    fields = ", ".join(f"c{k} STRING" for k in range(len(names)))
    options = """MAP('escape', '"', 'mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '_bad')"""
    cells = f"FROM_CSV(value, '{fields}, _bad STRING', {options})"
    expected = ", ".join(text_literal(name.lower()) for name in names)
    found = ", ".join(f"LOWER(COALESCE(NULLIF(cells.c{k}, ''), '_c{k}'))" for k in range(len(names)))
    same = f"ELEMENT_AT(TRANSFORM(ARRAY({cells}), cells -> cells._bad IS NULL AND ARRAY({found}) = ARRAY({expected})), 1)"
    data = f"""CASE WHEN _source_row_number > 0 THEN TRUE WHEN {same} THEN FALSE
        ELSE CAST(RAISE_ERROR(CONCAT('another header: ', _source_file)) AS BOOLEAN) END"""
    # Only of a malformed record: the cells it has, told from its text without what stands in quotes.
    n_cells = """SIZE(SPLIT(REGEXP_REPLACE(value, '"[^"]*"', ''), ','))"""
    reason = f"""CASE WHEN {_QUOTES.format('value')} % 2 = 1 THEN 'open quote' WHEN _cells._bad IS NULL THEN NULL
        WHEN {n_cells} < {len(names)} THEN 'few fields' ELSE 'many fields' END"""
    # Cells are null but in good records: conditions on them may be tested before the others are gone.
    parsed = _numbered(spark, path).filter(data)
    parsed = parsed.selectExpr("*", f"CASE WHEN _source_row_number > 0 THEN {cells} END AS _cells")
    parsed = parsed.selectExpr("*", f"{reason} AS _reason")
    return names, parsed.withColumn("_cells", F.expr("CASE WHEN _reason IS NULL THEN _cells END"))


def _numbered(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, _source_file, _source_row_number) for each record, numbered per file from the header's zero.

    A split is read front to back by one task, so a line's place inside a split is the difference of two
    increasing ids. Lines and quotes of each split are counted once and stored: one row per input split,
    as many as the driver has tasks to schedule, broadcast with their running totals. Lines of files
    without blank lines and with even quotes in every line are records, and are not shuffled.
    """
    lines = spark.read.text(path).selectExpr(
        "value",
        "_metadata.file_name AS _source_file",
        "_metadata.file_path AS _path",
        "_metadata.file_block_start AS _block",
        f"{_QUOTES.format('value')} % 2 AS _odd",
        "MONOTONICALLY_INCREASING_ID() AS _id",
    )
    splits = lines.groupBy("_path", "_block").agg(
        F.expr("MIN(_id) AS _first"),
        F.expr("COUNT(*) AS _size"),
        F.expr("SUM(_odd) AS _odds"),
        F.expr("COUNT_IF(TRIM(value) = '') AS _blanks"),
    )
    ahead, whole = "(PARTITION BY _path ORDER BY _block)", "(PARTITION BY _path)"
    totals = materialise(
        splits.selectExpr(
            "_path",
            "_block",
            f"SUM(_size) OVER {ahead} - _size - _first AS _shift",
            f"SUM(_odds) OVER {ahead} - _odds AS _odds_ahead",
            f"SUM(_odds + _blanks) OVER {whole} > 0 AS _uneven",
        )
    )
    placed = lines.join(F.broadcast(totals), ["_path", "_block"]).selectExpr("*", "_id + _shift AS _line")
    columns = ("value", "_source_file", "_line AS _source_row_number")
    if totals.filter("_uneven").isEmpty():
        return placed.selectExpr(*columns)
    plain = placed.filter("NOT _uneven").selectExpr(*columns)
    return plain.unionByName(_glued(placed.filter("_uneven")))


def _glued(lines: DataFrame) -> DataFrame:
    """Records of files with blank lines or quoted line breaks, as :func:`_numbered` gives them.

    A line is inside quotes if an odd number of lines with odd quotes is ahead of it in its file: that of
    its split is known, so one window per split finds it. The lines of a record meet by the number of the
    quote that opens it; a record has at most ``LONGEST_RECORD`` lines, so no group is larger. Lines
    behind a stray quote stand alone. Line breaks become ``\\n``; blank lines outside quotes go.
    """
    marked = lines.selectExpr(
        "*", "_odds_ahead + SUM(_odd) OVER (PARTITION BY _path, _block ORDER BY _id) - _odd AS _ahead"
    ).selectExpr("*", "CASE WHEN _ahead % 2 = 1 OR _odd = 1 THEN _ahead DIV 2 END AS _opening")
    inside = marked.filter("_opening IS NOT NULL")
    pairs = (
        inside.filter("_odd = 1")
        .groupBy("_path", "_opening")
        .agg(F.expr("COUNT(*) = 2 AND MAX(_line) - MIN(_line) < " + str(LONGEST_RECORD)).alias("_closed"))
    )
    inside = inside.join(pairs, ["_path", "_opening"])
    columns = ["_path", "_block", "_source_file", "_line", "value"]
    alone = marked.filter("_opening IS NULL").select(columns).unionByName(inside.filter("NOT _closed").select(columns))
    joined = (
        inside.filter("_closed")
        .groupBy("_path", "_source_file", "_opening")
        .agg(
            F.expr("MIN(_block) AS _block"),
            F.expr("MIN(_line) AS _line"),
            F.expr(
                "ARRAY_JOIN(TRANSFORM(ARRAY_SORT(COLLECT_LIST(STRUCT(_line, value))), l -> l.value), '\\n')"
            ).alias("value"),
        )
    )
    records = materialise(alone.filter("TRIM(value) <> ''").unionByName(joined.select(columns)))
    counts = (
        records.groupBy("_path", "_block")
        .agg(F.expr("COUNT(*) AS _size"))
        .selectExpr("_path", "_block", "SUM(_size) OVER (PARTITION BY _path ORDER BY _block) - _size AS _before")
    )
    return records.join(F.broadcast(counts), ["_path", "_block"]).selectExpr(
        "value",
        "_source_file",
        "_before + ROW_NUMBER() OVER (PARTITION BY _path, _block ORDER BY _line) - 1 AS _source_row_number",
    )


def with_lineage(rows: DataFrame, batch_id: str, ingested_at: datetime.datetime) -> DataFrame:
    """Batch, time and day of ingestion; one value per batch, the day also as partition column."""
    return rows.selectExpr(
        *(f"`{name}`" for name in rows.columns if name != "_source_row_number"),
        f"{text_literal(batch_id)} AS _batch_id",
        f"'{ingested_at.isoformat()}' AS _ingestion_ts",
        f"'{ingested_at:%Y-%m-%d}' AS _ingestion_date",
        "_source_row_number",
        f"{day_literal(ingested_at.date())} AS date",
    )


def ingest(
    spark: SparkSession,
    table: str,
    path: str | list[str],
    bronze: str,
    batch_id: str,
    ingested_at: datetime.datetime,
) -> int:
    """Append raw files to bronze as one batch and keep their malformed records; returns the rows added.

    Rejects follow the rows: should a run die between the two, a repeated one finds the batch loaded and
    stores its rejects anew.
    """
    seen = Observation()
    rows = read_raw(spark, table, path, seen)
    if rows is None:
        return 0
    n_rows = tables.append_bronze(with_lineage(rows, batch_id, ingested_at), bronze, table, batch_id)
    if n_rows is None or seen.get["n_rejected"]:
        if n_rows is not None:
            log.warning("%s: %d malformed records", table, seen.get["n_rejected"])
        tables.store_rejects(read_rejects(spark, table, path), bronze, batch_id)
    return n_rows or 0
