"""New raw files as a stream: each file is ingested into bronze exactly once."""

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tellerlake.sources import raw


def new_files(
    spark: SparkSession, landing: str, checkpoint: str, files_per_batch: int, step: Callable[[list[str], str], None]
) -> StreamingQuery:
    """Start a query that calls ``step`` with the files that appeared since the last one and a batch id, then stops.

    The stream only tracks which files are new (at most ``files_per_batch`` paths at a time, never their
    content). The batch id follows from the query's id, which its checkpoint keeps, and the number of the
    micro-batch, so a step that is repeated after a failure gets the same files under the same id, and a
    query with a new checkpoint is not mistaken for an old one.
    """

    def take(files: DataFrame, number: int) -> None:
        paths = [row.path for row in files.select("path").collect()]
        if paths:
            step(paths, f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}")

    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
        .select("path")
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(take)
        .start()
    )


def ingest(spark: SparkSession, table: str, paths: list[str], bronze: str, batch_id: str) -> int:
    """Files of one micro-batch into bronze, which ignores a batch that it already holds."""
    ingested_at = datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
    return raw.ingest(spark, table, paths, bronze, batch_id, ingested_at)


def ingest_new_files(
    spark: SparkSession, table: str, landing: str, bronze: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Start a query that ingests the files that appeared in ``landing`` since the last one, then stops.

    The rows are read by the batch reader, so lineage, row numbers and rejects are the same. A restarted
    query adds nothing twice.
    """

    def step(paths: list[str], batch_id: str) -> None:
        ingest(spark, table, paths, bronze, batch_id)

    return new_files(spark, landing, checkpoint, files_per_batch, step)
