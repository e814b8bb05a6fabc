"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores. Every query is built and run to the
end (all rows, all columns) into the no-op sink. The first run of a query warms the JVM, and the
faster of two timed runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "station_daily",
    "raw_validation",
    "flatten_daily",
    "city_slug_join",
    "incremental_upsert",
    "window_plan_coverage",
    "clean_daily",
    "monthly_climate",
    "climatology",
    "anomaly_month",
    "anomaly_events",
    "anomaly_correlations",
    "anomaly_lags",
    "strongest_links",
    "ml_features",
    "ordered_split",
    "class_weights",
    "classification_report",
    "roc_auc",
    "run_daily_summary",
    "ml_daily_summary",
    "run_stats",
    "ingestion_health",
    "ml_health",
    "metric_summary",
    "dq_report",
    "fleet_monthly",
    "fleet_correlations",
    "fleet_links",
    "candidate_lags",
    "similar_links",
    "updated_correlations",
    "retracted_climatology",
    "window_plan_missing",
    "schema_drift",
    "auc_by_day",
    "stored_upsert",
    "upsert_months",
    "landing_zone",
    "stream_landing",
    "stored_log",
    "log_append",
    "rf_predictions",
)


def session(cpus: str) -> SparkSession:
    folder = tempfile.mkdtemp(prefix="isotherm-bench-")  # one machine: what tests do too
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("isotherm-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    from isotherm.plans.queries import REGISTRY

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    wanted = sys.argv[1:] or HEADLINE
    spark = session(cpus)

    def seconds(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in wanted:
        seconds(name)
        timings[name] = round(min(seconds(name), seconds(name)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus) if cpus.isdigit() else cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
