"""The log of runs."""

import datetime
import json

from pyspark.sql import DataFrame, SparkSession

from tellerlake import schemas


def run_row(
    spark: SparkSession,
    name: str,
    layer: str,
    status: str,
    started_at: datetime.datetime,
    ended_at: datetime.datetime,
    batch_id: str,
    rows_processed: int = 0,
    rows_failed: int = 0,
    error: str | None = None,
    **metadata,
) -> DataFrame:
    """One finished step of a run, as a row of the run log."""
    seconds = int((ended_at - started_at).total_seconds())
    details = json.dumps(metadata, default=str, sort_keys=True)
    row = (name, layer, status, started_at, ended_at, seconds, rows_processed, rows_failed, error, batch_id, details)
    return spark.createDataFrame([row], schemas.AUDIT_PIPELINE_RUNS)
