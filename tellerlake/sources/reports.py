"""CSV reports and bulk loads into an outside database."""

import datetime
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def write_csv(report: DataFrame, folder: str, name: str, day: datetime.date, single_file: bool = False) -> int:
    """Write ``{name}_{yyyymmdd}.csv`` with a header and return its row count.

    ``single_file`` is for reports of bounded size; others are written by as many tasks as they have.
    """
    taken = Observation()
    counted = report.observe(taken, F.count("*").alias("n_rows"))
    if single_file:
        counted = counted.coalesce(1)
    counted.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}_{day:%Y%m%d}.csv")
    return taken.get["n_rows"]


def export_all(
    reports: dict[str, Callable[[], DataFrame]], folder: str, day: datetime.date, bounded: set[str] = frozenset()
) -> dict[str, int | Exception]:
    """Write every report; one that fails is recorded and does not stop the others."""
    outcome: dict[str, int | Exception] = {}
    for name, build in reports.items():
        try:
            outcome[name] = write_csv(build(), folder, name, day, single_file=name in bounded)
        except Exception as error:
            log.warning("report %s failed: %s", name, error)
            outcome[name] = error
    return outcome


def write_jdbc(df: DataFrame, url: str, table: str, truncate: bool = False, **options: str) -> None:
    """Bulk load into a database table; ``truncate`` empties it first and keeps its definition."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", 50_000)
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.option("truncate", truncate).mode("overwrite" if truncate else "append").save()
