"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores (default 8). Each
query runs once, in a session warmed up by the first one, and its whole result is produced and
discarded. Fact and mart queries share the stored dimensions; ``gold_dimensions`` is their build.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tellerlake.plans import catalog  # noqa: E402
from tellerlake.session import build_session  # noqa: E402

HEADLINE = (
    "silver_branches silver_merchants silver_customers silver_accounts silver_transactions txn_velocity dedup_latest"
    " orphan_counts decline_rate dim_date dim_transaction_type scd1_branches scd1_merchants scd2_customers scd2_accounts"
    " surrogate_keys fact_incremental_drop fact_incremental_antijoin gold_dimensions fact_resolve fact_as_of"
    " account_snapshot mart_customer_360 mart_fraud_signals mart_daily_summary dq_results bronze_ingest"
).split()


def produce(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    produce(catalog.silver_transactions(spark, sf_dir))
    seconds = {}
    for name in HEADLINE:
        started = time.time()
        if name == "gold_dimensions":
            catalog.stored_dimensions(spark, sf_dir)
        else:
            produce(catalog.QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.time() - started, 3)
    line = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "spark": spark.version,
        "state": "warm session, each query once",
    }
    spark.stop()
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
