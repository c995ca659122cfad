"""Parquet tables in slices, of which a run replaces the ones that it changed.

A slice is a directory: the rows of a month, or of a range of ids. A run writes the slices that it changes under its
own snapshot number and names them, for all its tables at once, in one appended commit. Readers pass a snapshot, or
take the last, and read each slice as its newest commit up to there left it: a run that dies leaves nothing that they
see, a repeated one writes over its own leavings, and tables of one snapshot belong together.
"""

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tellerlake import schemas
from tellerlake.session import empty_frame, small_frame
from tellerlake.sources import tables

LOG = "snapshot long, batch_id string, table_name string, slice string, n_rows long, mark string"
#: Table name of the row that every commit has: which batch it took, and up to where (``mark``).
BATCH = ""


def _log(spark: SparkSession, root: str) -> DataFrame:
    found = tables.read_if_present(spark, f"{root}/snapshots", LOG, warn=False)
    return empty_frame(spark, LOG) if found is None else found


def last_snapshot(spark: SparkSession, root: str) -> int:
    """Number of the newest committed snapshot, 0 before the first."""
    return _log(spark, root).agg(F.expr("COALESCE(MAX(snapshot), 0L)")).first()[0]


def batches(spark: SparkSession, root: str) -> tuple[set[str], str | None]:
    """The batches that commits took, and the highest mark among them."""
    rows = _log(spark, root).filter(f"table_name = '{BATCH}'").select("batch_id", "mark").collect()
    return {row.batch_id for row in rows}, max((row.mark for row in rows if row.mark is not None), default=None)


def last_mark(spark: SparkSession, root: str) -> str | None:
    """The mark of the newest commit."""
    return _log(spark, root).filter(f"table_name = '{BATCH}'").agg(F.expr("MAX_BY(mark, snapshot)")).first()[0]


def holds(spark: SparkSession, root: str, batch_id: str) -> bool:
    taken = f"table_name = '{BATCH}' AND batch_id = {schemas.text_literal(batch_id)}"
    return not _log(spark, root).filter(taken).isEmpty()


def current(
    spark: SparkSession, root: str, table: str, only: Iterable[str] | None = None, snapshot: int | None = None
) -> dict[str, int]:
    """The snapshot that last wrote each slice with rows, of all slices or some. There is one entry a slice."""
    log = _log(spark, root).filter(f"table_name = {schemas.text_literal(table)}")
    if snapshot is not None:
        log = log.filter(f"snapshot <= {snapshot}")
    newest = log.groupBy("slice").agg(F.expr("MAX_BY(STRUCT(snapshot, n_rows), snapshot) AS last"))
    wanted = None if only is None else set(only)
    return {
        row.slice: row.last.snapshot
        for row in newest.collect()
        if row.last.n_rows and (wanted is None or row.slice in wanted)
    }


def read(
    spark: SparkSession,
    root: str,
    table: str,
    schema: StructType,
    only: Iterable[str] | None = None,
    snapshot: int | None = None,
) -> DataFrame:
    """The rows of a table, or of some of its slices: other files are not even listed."""
    found = current(spark, root, table, only, snapshot)
    if not found:
        return empty_frame(spark, schema)
    paths = [f"{root}/{table}/snapshot={number}/slice={name}" for name, number in sorted(found.items())]
    return spark.read.schema(schema).parquet(*paths)


@dataclass
class Run:
    """What a run has written so far; ``commit`` makes it visible. The snapshot is the next, unless it is given."""

    spark: SparkSession
    root: str
    batch_id: str
    snapshot: int = 0
    written: list[tuple] = field(default_factory=list)

    def __post_init__(self):
        self.snapshot = self.snapshot or last_snapshot(self.spark, self.root) + 1

    def replace(
        self, rows: DataFrame, table: str, slice_of: str, touched: Iterable[str], order: Iterable[str] = ()
    ) -> dict[str, int]:
        """Write the new content of slices; those ``touched`` that get no rows end up empty. Returns rows by slice.

        ``slice_of`` is SQL of the slice of a row. Slices get a few files of a good size each, in which rows
        are sorted by ``order``: a reader that looks for some of its values skips most row groups.
        """
        path = f"{self.root}/{table}/snapshot={self.snapshot}"
        placed = tables.balanced(rows.withColumn("slice", F.expr(slice_of)), "slice")
        placed = placed.sortWithinPartitions("slice", *order) if order else placed
        placed.write.mode("overwrite").partitionBy("slice").parquet(path)
        counted = {}
        if not self.spark.read.schema("slice string").parquet(path).isEmpty():
            stored = self.spark.read.schema("slice string").parquet(path)
            counted = {row.slice: row["count"] for row in stored.groupBy("slice").count().collect()}
        for name in set(touched) | set(counted):
            self.written.append((table, name, counted.get(name, 0)))
        return counted

    def commit(self, mark: str | None = None, taken: Iterable[str] = ()) -> None:
        """One appended file names everything that the run wrote, and the batches it took."""
        rows = [(self.snapshot, self.batch_id, table, name, n, None) for table, name, n in self.written]
        rows += [(self.snapshot, batch, BATCH, "", 0, mark) for batch in {self.batch_id, *taken}]
        small_frame(self.spark, rows, LOG).write.mode("append").parquet(f"{self.root}/snapshots")
