"""Layer jobs: every source of a run, failures kept apart, one log."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crateflow.contracts import (
    BY_CODE,
    GOLD_LOG,
    INGEST_LOG,
    PLATFORM,
    SILVER_LOG,
    SOURCES,
    UNKNOWN_KEY,
    SourceSpec,
)
from crateflow.operators import dimensions, facts, marts
from crateflow.operators.bronze import attach_lineage, cast_to_string
from crateflow.operators.promotions import promotion_bridge
from crateflow.operators.quality import date_null_ratio
from crateflow.operators.silver import (
    ContractError,
    check_contract,
    null_key_rows,
    transform,
)
from crateflow.session import in_this_job, scratch_of_job, shuffles_removed
from crateflow.sources.delimited import scan_csv
from crateflow.sources.tables import SMALL, append_rows, log_frame, publish, read_table
from crateflow.sources.workbook import scan_workbooks

_log = logging.getLogger(__name__)

_SOURCES_AT_ONCE = 4
# dimensions that keep the first row of a business key, and their source
_FIRST_KEPT = {
    "dim_customers": "SRC03",
    "dim_products": "SRC04",
    "dim_distributors": "SRC06",
    "dim_promotion": "SRC10",
}

# reads the given paths of one source as strings; may be replaced per format
Reader = Callable[[SourceSpec, list[str]], DataFrame]


def default_readers(spark: SparkSession) -> dict[str, Reader]:
    """Readers of the two file formats sources come in."""
    return {
        "csv": lambda source, paths: scan_csv(
            spark, paths, source.multiline, row_seq=True, check=lambda df: check_contract(df, source)
        ),
        "xlsx": lambda source, paths: scan_workbooks(spark, paths, True, source.columns),
    }


def bronze_frame(df: DataFrame, source: SourceSpec, run_date: str, batch_id: str) -> DataFrame:
    """Checked against the contract, stamped with lineage, all strings."""
    check_contract(df, source)
    return cast_to_string(attach_lineage(df, source.file, run_date, batch_id))


def run_bronze(
    spark: SparkSession,
    run_date: str,
    batch_id: str,
    raw_root: str,
    bronze_root: str,
    readers: dict[str, Reader] | None = None,
    sources: tuple[SourceSpec, ...] = SOURCES,
) -> list[dict]:
    """Land every source; one that fails is logged and the others go on."""
    readers = readers or default_readers(spark)

    def land(source: SourceSpec) -> dict:
        # joined as text: a path object would swallow a slash of ``s3a://bucket``
        raw_path = f"{raw_root.rstrip('/')}/{source.file}"
        return _land_source(
            spark, source, readers[source.format], raw_path, bronze_root, run_date, batch_id
        )

    records = list(each_source(land, sources))
    publish(log_frame(spark, records, INGEST_LOG), bronze_root, run_date, "ingest_log")
    return records


def each_source(work: Callable[[SourceSpec], object], sources: tuple[SourceSpec, ...]):
    """Results in source order; a few sources run at once so that none waits for a slow tail."""
    with ThreadPoolExecutor(_SOURCES_AT_ONCE) as pool:
        yield from pool.map(in_this_job(work), sources)


def _land_source(
    spark: SparkSession,
    source: SourceSpec,
    reader: Reader,
    raw_path: str,
    bronze_root: str,
    run_date: str,
    batch_id: str,
) -> dict:
    """``duration_sec`` covers read and write: Spark reads when it writes."""
    start = time.perf_counter()
    status, rows = "success", 0
    try:
        frame = bronze_frame(reader(source, [raw_path]), source, run_date, batch_id)
        publish(frame, bronze_root, run_date, source.name, SMALL)
        # answered by the Parquet footers, and exact even after lost tasks
        rows = read_table(spark, bronze_root, run_date, source.name, frame.schema).count()
    except ContractError as error:
        status = "schema_mismatch"
        _log.error("%s", error)
    except Exception as error:  # noqa: BLE001 -- any other failure is this source's alone
        status = "failed"
        _log.error("%s: %s", source.file, error)
    return {
        "batch_id": batch_id,
        "source_name": source.name,
        "source_file": source.file,
        "source_platform": PLATFORM,
        "rows_loaded": rows,
        "status": status,
        "duration_sec": time.perf_counter() - start,
    }


def run_silver(
    spark: SparkSession,
    run_date: str,
    bronze_root: str,
    silver_root: str,
    sources: tuple[SourceSpec, ...] = SOURCES,
) -> list[dict]:
    """Clean every source; each one adds a row to the Silver log when it is done."""

    def clean(source: SourceSpec) -> dict:
        return _clean_source(spark, source, bronze_root, silver_root, run_date)

    records = []
    # appends go one after the other: two at once would share a commit folder
    for source, entry in zip(sources, each_source(clean, sources)):
        append_rows(log_frame(spark, [entry], SILVER_LOG), silver_root, run_date, "silver_log")
        records.append(
            {"source_file": source.file, "status": entry["status"], "error": entry["error_message"]}
        )
    return records


def _clean_source(
    spark: SparkSession, source: SourceSpec, bronze_root: str, silver_root: str, run_date: str
) -> dict:
    entry = {
        "source_name": source.name,
        "run_date": run_date,
        "row_count_in": 0,
        "row_count_out": 0,
        "null_count": 0,
        "dedup_count": 0,
        "status": "success",
        "error_message": None,
    }
    try:
        bronze = read_table(spark, bronze_root, run_date, source.name)
        entry["row_count_in"] = bronze.count()
        # what only describes the run comes first: once the table is replaced,
        # nothing may call the source failed
        empty = null_key_rows(bronze, source).count()
        _report_dates(bronze, source)
        silver = transform(bronze, source, few_copies=True)
        publish(silver, silver_root, run_date, source.name, SMALL)
    except Exception as error:  # noqa: BLE001 -- one source must not stop the run
        _log.error("%s: %s", source.file, error)
        return entry | {"status": "failed", "error_message": str(error)}
    # Rows in and out come from Parquet footers; only the rows with an empty
    # key are looked at again. Counters inside the write would be off whenever a
    # task runs twice.
    rows_out = read_table(spark, silver_root, run_date, source.name, silver.schema).count()
    return entry | {
        "row_count_out": rows_out,
        "null_count": empty,
        "dedup_count": entry["row_count_in"] - rows_out - empty,
    }


def _report_dates(bronze: DataFrame, source: SourceSpec) -> None:
    """One narrow scan of the date columns; as many log lines as there are columns."""
    for row in date_null_ratio(bronze, source).collect():
        level = logging.WARNING if row["level"] == "warning" else logging.INFO
        percent = 100 * (row["null_ratio"] or 0.0)
        _log.log(level, "%s.%s: %.0f%% NULL after parsing", source.file, row["column_name"], percent)


def run_gold(
    spark: SparkSession,
    run_date: str,
    silver_root: str,
    gold_root: str,
    sales_territory: bool = False,
) -> list[dict]:
    """Build dimensions, facts and marts from Silver, each once; one log row each.

    With ``sales_territory`` a sale also carries the key of its territory; it
    then needs ``dim_territory`` too.

    Every table is read back after it was written: facts join stored
    dimensions whose size is known, and nothing is computed twice. Tables that
    do not need each other are built at the same time. A table that fails, or
    needs one that failed, is logged; the others are built, and what was there
    under its name stays.
    """
    built: dict[str, DataFrame] = {}
    records: list[dict] = []

    def silver(code: str) -> DataFrame:
        return read_table(spark, silver_root, run_date, BY_CODE[code].name)

    def build(name: str, work: Callable[[], DataFrame]) -> dict:
        record = {
            "table_name": name, "run_date": run_date, "rows": 0, "copies_dropped": None,
            "status": "success", "error_message": None,
        }
        try:
            df = work()
            publish(df, gold_root, run_date, name, SMALL)
        except Exception as error:  # noqa: BLE001 -- one table must not stop the others
            reason = f"needs {error.args[0]}" if isinstance(error, _Missing) else str(error)
            _log.error("%s: %s", name, reason)
            return record | {"status": "failed", "error_message": reason}
        built[name] = read_table(spark, gold_root, run_date, name, df.schema)
        rows, dropped = built[name].count(), None
        if name in _FIRST_KEPT:
            # the dimension has one row more than keys, that of the unknown member
            dropped = silver(_FIRST_KEPT[name]).count() - (rows - 1)
        return record | {"rows": rows, "copies_dropped": dropped}

    def store(builds: dict[str, Callable[[], DataFrame]]) -> None:
        with ThreadPoolExecutor(_SOURCES_AT_ONCE) as pool:
            records.extend(pool.map(in_this_job(build), builds, builds.values()))

    def need(name: str) -> DataFrame:
        if name not in built:
            raise _Missing(name)
        return built[name]

    def all_dates() -> DataFrame:
        # returns and distributor orders may fall on days without a sale around them
        return dimensions.build_dim_date(
            (silver("SRC01"), "order_date"),
            (silver("SRC09"), "return_date"),
            (silver("SRC05"), "order_date"),
        )

    with scratch_of_job(spark), shuffles_removed(spark):
        store(
            {
                "dim_customers": lambda: dimensions.build_dim_customers(silver("SRC03")),
                "dim_products": lambda: dimensions.build_dim_products(silver("SRC04")),
                "dim_distributors": lambda: dimensions.build_dim_distributors(silver("SRC06")),
                "dim_employees": lambda: dimensions.build_dim_employees(silver("SRC07")),
                "dim_territory": lambda: dimensions.build_dim_territories(silver("SRC08")),
                "dim_promotion": lambda: dimensions.build_dim_promotions(silver("SRC10")),
                "dim_date": lambda: dimensions.build_dim_date((silver("SRC01"), "order_date")),
            }
        )
        store(
            {
                "fact_sales": lambda: facts.build_fact_sales(
                    silver("SRC01"),
                    need("dim_customers"),
                    need("dim_products"),
                    need("dim_employees"),
                    need("dim_date"),
                    need("dim_territory") if sales_territory else None,
                ),
                "fact_targets": lambda: facts.build_fact_targets(
                    silver("SRC02"), need("dim_employees")
                ),
            }
        )
        # wide tables one after the other, so that the shuffle files of one are there at a time
        store(
            {
                "fact_returns": lambda: facts.build_fact_returns(
                    silver("SRC09"),
                    need("dim_customers"),
                    need("dim_products"),
                    need("dim_employees"),
                    all_dates(),
                    need("dim_territory"),
                ),
            }
        )
        store(
            {
                "fact_distributor_orders": lambda: facts.build_fact_distributor_orders(
                    silver("SRC05"), need("dim_products"), all_dates(), need("dim_distributors")
                ),
            }
        )
        store(
            {
                "bridge_sales_promotion": lambda: promotion_bridge(
                    need("fact_sales"),
                    need("dim_promotion").filter(F.col("promotion_key") != UNKNOWN_KEY),
                    ["order_id"],
                ),
                "mart_sales_vs_target": lambda: marts.sales_vs_target(
                    need("fact_sales"), need("fact_targets"), need("dim_employees")
                ),
            }
        )
    publish(log_frame(spark, records, GOLD_LOG), gold_root, run_date, "gold_log")
    return records


class _Missing(Exception):
    """A table that another one needs was not built."""


def outcome(records: list[dict]) -> tuple[bool, str]:
    """Whether a run succeeded, and how many of its sources did not."""
    failed = sum(record["status"] != "success" for record in records)
    total = len(records)
    if failed:
        return False, f"FAILED: {failed}/{total} sources"
    return True, f"OK: {total}/{total} sources"
