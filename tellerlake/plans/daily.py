"""One daily run: raw files to bronze, silver, gold, checks, marts and reports, in dependency order."""

import datetime
import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tellerlake import schemas
from tellerlake.functions.ids import new_batch_id
from tellerlake.operators import audit, marts, quality, scd, silver
from tellerlake.operators.scd import Load
from tellerlake.plans import gold, incremental
from tellerlake.sources import raw, reports, slices, tables

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Paths:
    """Where the layers live; any file system Spark can reach."""

    raw: str
    warehouse: str

    @property
    def bronze(self) -> str:
        return f"{self.warehouse}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.warehouse}/silver"

    @property
    def gold(self) -> str:
        return f"{self.warehouse}/gold"

    @property
    def marts(self) -> str:
        return f"{self.warehouse}/marts"

    @property
    def exports(self) -> str:
        return f"{self.warehouse}/exports"

    @property
    def audit(self) -> str:
        return f"{self.warehouse}/audit"


def now() -> datetime.datetime:
    return datetime.datetime.now(datetime.UTC).replace(tzinfo=None)


class DailyRun:
    """A run over one batch. Each step can be repeated alone as long as earlier outputs exist.

    ``late`` chooses what happens to transactions dated up to the fact table's watermark: "anti_join"
    loads whatever id is missing, "drop" leaves them out and logs how many there are.
    """

    def __init__(
        self, spark: SparkSession, paths: Paths, as_of: datetime.date, batch_id: str | None = None, late: str = "anti_join"
    ):
        self.spark = spark
        self.paths = paths
        self.late = late
        self.load = Load(batch_id or new_batch_id(), as_of, now())

    def run(self) -> dict[str, dict]:
        """All steps in order; returns what each one counted."""
        return {
            "bronze": self._logged("bronze_ingest", "bronze", self.bronze),
            "silver": self._logged("silver_transform", "silver", self.silver),
            "gold": self._logged("gold_load", "gold", self.gold),
            "quality": self._logged("quality_checks", "gold", self.quality, counts_failures=True),
            "marts": self._logged("mart_build", "gold", self.marts),
            "reports": self._logged("report_export", "gold", self.reports),
        }

    def _logged(self, name: str, layer: str, step: Callable[[], dict], counts_failures: bool = False) -> dict:
        """Run a step and add a row to the run log, whether it succeeds or fails.

        Of a step that ``counts_failures`` the numbers are failed rows. A step some of whose outputs
        failed is logged as failed, with their errors, and the run goes on.
        """
        started = now()

        def write(status: str, error: str | None, counts: dict) -> None:
            total = sum(v for v in counts.values() if isinstance(v, int))
            failed = sum(isinstance(v, Exception) for v in counts.values()) + (total if counts_failures else 0)
            processed = 0 if counts_failures else total
            row = audit.run_row(
                self.spark, name, layer, status, started, now(), self.load.batch_id, processed, failed, error, **counts
            )
            row.coalesce(1).write.mode("append").parquet(f"{self.paths.audit}/pipeline_runs")

        try:
            counts = step()
        except Exception as error:
            write("failed", str(error), {})
            raise
        errors = [f"{k}: {v}" for k, v in counts.items() if isinstance(v, Exception)]
        write("failed" if errors else "success", "; ".join(errors) or None, counts)
        return counts

    def bronze(self) -> dict[str, int]:
        """Append every raw file that exists as one batch; malformed records go beside them."""
        counts = {}
        for table, file in raw.SOURCE_FILES.items():
            path = f"{self.paths.raw}/{file}"
            counts[table] = raw.ingest(
                self.spark, table, path, self.paths.bronze, self.load.batch_id, self.load.loaded_at
            )
        return counts

    def silver(self) -> dict[str, int]:
        """Rewrite the small silver tables from all bronze batches, and merge the new ones into the transactions."""
        builders: dict[str, Callable[[DataFrame], DataFrame]] = {
            "branches": silver.branches,
            "merchants": silver.merchants,
            "customers": silver.customers,
            "accounts": lambda bronze: silver.accounts(bronze, self.load.as_of),
        }
        counts = {}
        for table, build in builders.items():
            bronze = self._bronze(table)
            if bronze is not None:
                counts[table] = tables.overwrite(build(bronze), f"{self.paths.silver}/{table}")["n_rows"]
        merged = incremental.merge_transactions(self.spark, self.paths.bronze, self.paths.silver, self.load.batch_id)
        return counts | {f"transactions_{outcome}": n for outcome, n in merged.items()}

    def _bronze(self, table: str) -> DataFrame | None:
        return tables.read_if_present(self.spark, f"{self.paths.bronze}/{table}", schemas.bronze_schema(table))

    def _silver(self, table: str) -> DataFrame | None:
        if table == "transactions":
            found = slices.last_snapshot(self.spark, self.paths.silver)
            return incremental.read_transactions(self.spark, self.paths.silver) if found else None
        return tables.read_if_present(self.spark, f"{self.paths.silver}/{table}")

    def gold(self) -> dict[str, int]:
        """Dimensions first, customers before accounts, then facts and snapshots of what silver changed."""
        spark, root, load = self.spark, self.paths.gold, self.load
        counts = {}
        gold.load_seeds(spark, root, load)
        for dimension in (scd.BRANCHES, scd.MERCHANTS, scd.CUSTOMERS, scd.ACCOUNTS):
            incoming = self._silver(dimension.name.removeprefix("dim_"))
            if incoming is None:
                continue
            if dimension is scd.ACCOUNTS:
                incoming = scd.resolve_account_keys(
                    incoming,
                    gold.read_type1(spark, root, scd.BRANCHES),
                    gold.read_type2(spark, root, scd.CUSTOMERS, current_only=True),
                )
            taken = gold.load_dimension(spark, root, dimension, incoming, load)
            counts[f"{dimension.name}_inserted"] = taken["inserted"]
            counts[f"{dimension.name}_updated"] = taken["updated"]
        now = slices.last_snapshot(spark, self.paths.silver)
        if now:
            last = tables.last_commit(spark, root, gold.FACT)
            since = last.source or 0 if last else 0
            changed = incremental.changed_transactions(spark, self.paths.silver, since, now)
            counts[gold.FACT] = gold.load_facts(spark, root, changed, load, self.late, source=now)["n_rows"]
            counts[gold.SNAPSHOTS] = gold.load_snapshots(spark, root, self.paths.silver, load)["n_rows"]
        return counts

    def quality(self) -> dict[str, int]:
        """Append the results of all checks to the data-quality log; returns the failing ones."""
        spark, root = self.spark, self.paths.gold
        silver_tables = [self._silver(t) for t in ("transactions", "accounts", "customers", "branches")]
        parts = [] if None in silver_tables else quality.silver_results(*silver_tables)
        parts += [
            *quality.gold_results(
                gold.read_fact(spark, root),
                gold.read_snapshots(spark, root),
                gold.read_type2(spark, root, scd.ACCOUNTS),
                gold.read_type2(spark, root, scd.CUSTOMERS),
                gold.read_type1(spark, root, scd.MERCHANTS),
                gold.read_type1(spark, root, scd.BRANCHES),
                gold.read_types(spark, root),
                gold.read_calendar(spark, root),
            ),
        ]
        path = f"{self.paths.audit}/data_quality"
        results = quality.all_results(parts, self.load.loaded_at)
        results.coalesce(1).write.mode("append").parquet(path)
        this_run = f"checked_at = {schemas.time_literal(self.load.loaded_at)} AND NOT passed"
        failing = spark.read.schema(schemas.AUDIT_DATA_QUALITY).parquet(path).filter(this_run)
        counts = {f"{row.table_name}.{row.check_name}": row.rows_failed for row in failing.collect()}
        for check, rows in counts.items():
            log.warning("%s: %d rows failed", check, rows)
        return counts

    def marts(self) -> dict[str, int]:
        """Rebuild the marts from gold, and offer gold and marts to SQL as temporary views."""
        spark, root = self.spark, self.paths.gold
        fact = gold.read_fact(spark, root)
        customers, accounts = gold.read_type2(spark, root, scd.CUSTOMERS), gold.read_type2(spark, root, scd.ACCOUNTS)
        built = {
            "customer_360": marts.customer_360(fact, customers, accounts),
            "fraud_signals": marts.fraud_signals(fact),
            "daily_summary": marts.daily_transaction_summary(fact, gold.read_types(spark, root)),
        }
        counts = {name: tables.overwrite(df, f"{self.paths.marts}/{name}")["n_rows"] for name, df in built.items()}
        gold.register_views(spark, root)
        for name in built:
            spark.read.parquet(f"{self.paths.marts}/{name}").createOrReplaceTempView(f"mart_{name}")
        return counts

    def reports(self) -> dict[str, int | Exception]:
        """Export the reports as CSV; one that fails does not stop the others."""

        def mart(name: str) -> DataFrame:
            return self.spark.read.parquet(f"{self.paths.marts}/{name}")

        wanted = {
            "customer_360": lambda: marts.customer_report(mart("customer_360")),
            "fraud_signals": lambda: marts.fraud_report(mart("fraud_signals")),
            "daily_summary": lambda: marts.summary_report(mart("daily_summary"), self.load.as_of),
        }
        return reports.export_all(wanted, self.paths.exports, self.load.as_of)
