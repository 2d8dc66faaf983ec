"""Time the headline queries; prints one JSON line.

Settings: BENCH_SF_DIR (tables), BENCH_CPUS (threads), BENCH_RUNS (timed runs of
each query, 3). The given tables are first written to a scratch folder in as
many files as there are threads, since some lie in a single row group that one
task would read alone; the landed sales feed is written there too. Neither is
timed. Every query is planned, run and fully materialised; the median counts, so
the first run, which warms the session, does not.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from unittest import mock

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from pyspark.sql import SparkSession  # noqa: E402

from crateflow.catalog import feeds  # noqa: E402
from crateflow.catalog.queries import QUERIES  # noqa: E402

HEADLINE = (
    "silver_transform",
    "silver_stats",
    "surrogate_key_dense",
    "dim_customers",
    "dim_employees",
    "fact_sales",
    "fact_distributor_orders",
    "asof_employee_key",
    "asof_window_variant",
    "promo_bridge",
    "mart_sales_vs_target",
    "kpi_sales_by_hist_region",
    "kpi_growth",
    "kpi_promo_uplift",
    "kpi_return_rate",
)
# Sources and jobs, timed once: they write as much as they read.
LONG = ("scan_csv_strings", "landing_ingest", "run_history_latest", "gold_job")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def lay_out(spark: SparkSession, folder: str, parts: int) -> str:
    """The tables in files that all threads can read at once."""
    out = tempfile.mkdtemp(prefix="crateflow-bench-")
    for name in TABLES:
        df = spark.read.parquet(f"{folder}/{name}.parquet")
        df.repartition(parts if name in ("orders", "lineitem", "events") else 1).write.parquet(
            f"{out}/{name}.parquet"
        )
    feeds.landed_sales(spark, out).write.parquet(f"{out}/landed_sales.parquet")
    return out


def main() -> None:
    given = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = lay_out(spark, given, int(cpus))

    def landed(session: SparkSession, path: str):
        return session.read.parquet(f"{path}/landed_sales.parquet")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    with mock.patch.object(feeds, "landed_sales", landed):
        for name in HEADLINE:
            times[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
        total = round(sum(times.values()), 3)
        for name in LONG:
            times[name] = round(timed(name), 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(os.path.normpath(given)),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
