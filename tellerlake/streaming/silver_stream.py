"""New transaction files as a stream: through bronze into silver, each file exactly once."""

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tellerlake.plans import incremental
from tellerlake.streaming import bronze_stream


def merge_new_files(
    spark: SparkSession, landing: str, bronze: str, silver: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Start a query that takes new transaction files into bronze and merges them into silver, then stops.

    Silver is what a full rebuild of bronze gives: copies and corrections are resolved against all that is
    stored, however late they come, so no watermark drops any. The key blocks that silver keeps are the
    stream's state; the checkpoint holds only which files were taken. A query that dies between the two layers
    repeats its micro-batch: bronze already holds it, and the merge takes every batch that no commit names.
    """

    def step(paths: list[str], batch_id: str) -> None:
        bronze_stream.ingest(spark, incremental.TRANSACTIONS, paths, bronze, batch_id)
        incremental.merge_transactions(spark, bronze, silver, batch_id)

    return bronze_stream.new_files(spark, landing, checkpoint, files_per_batch, step)
