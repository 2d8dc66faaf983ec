"""Every operator as a query over the given tables: ``name -> f(spark, folder)``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial

import pandas as pd
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crateflow import jobs
from crateflow.catalog import feeds
from crateflow.catalog.workbooks import encode_workbook
from crateflow.contracts import BY_CODE, INGEST_LOG, ROW_SEQ, SOURCES, SourceSpec
from crateflow.functions.columns import source_name
from crateflow.operators import bronze, dimensions, facts, marts, promotions, quality, silver
from crateflow.operators.asof import asof_by_bucket, resolve_asof
from crateflow.plans.dense_key import dense_key
from crateflow.plans.spread import star_join
from crateflow.session import scratch_dir, scratch_of_job, shuffles_removed, stored
from crateflow.sources.delimited import scan_csv
from crateflow.sources.tables import (
    SMALL,
    append_rows,
    latest_per,
    publish,
    publish_days,
    read_table,
    run_history,
)
from crateflow.sources.workbook import scan_workbooks
from crateflow.streaming.landing import ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_RUN_DATE = "2026-07-22"
_BATCH = "batch-1"


def query(function: Query) -> Query:
    """Register a query under the name of its function."""
    QUERIES[function.__name__] = function
    return function


# --- sources and sinks -------------------------------------------------------


def _order_strings(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.table(spark, folder, "orders").select(
        feeds.ident("ORD", "o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("order_date"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("amount"),
        F.concat(F.lit('say "'), F.col("o_orderpriority"), F.lit('",\nthen go')).alias("note"),
    )


@query
def scan_csv_strings(spark, folder):
    path = scratch_dir(spark, "csv")
    _order_strings(spark, folder).write.option("header", True).option("escape", '"').csv(path)
    return scan_csv(spark, path)


_PART_HEADER = ["product_id", "product_name", "size", "price", "launched"]
_PARTS_PER_WORKBOOK = 5_000


def _write_workbook(folder: str, group: pd.DataFrame) -> pd.DataFrame:
    # a group is one block of part numbers, so it is bounded by the block
    rows = list(group[_PART_HEADER].itertuples(index=False, name=None))
    path = f"{folder}/block-{int(group['block'].iloc[0]):012d}.xlsx"
    store, place = FileSystem.from_uri(path)
    with store.open_output_stream(place) as out:
        out.write(encode_workbook(_PART_HEADER, rows))
    return pd.DataFrame({"path": [path]})


@query
def scan_workbook_strings(spark, folder):
    parts = feeds.table(spark, folder, "part").select(
        feeds.ident("PRD", "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
        F.date_add(F.lit("1994-01-01").cast("date"), F.col("p_size")).alias("launched"),
        F.floor(F.col("p_partkey") / _PARTS_PER_WORKBOOK).alias("block"),
    )
    books = scratch_dir(spark, "workbooks")
    FileSystem.from_uri(books)[0].create_dir(FileSystem.from_uri(books)[1])
    parts.groupBy("block").applyInPandas(partial(_write_workbook, books), "path string").count()
    return scan_workbooks(spark, books)


@query
def idempotent_overwrite(spark, folder):
    root = scratch_dir(spark, "layer")
    for _ in range(2):
        publish(_order_strings(spark, folder).drop("note"), root, _RUN_DATE, "orders")
    return read_table(spark, root, _RUN_DATE, "orders")


@query
def ingest_log_overwrite(spark, folder):
    root = scratch_dir(spark, "log")
    for _ in range(2):
        log = feeds.run_log(spark, folder).select(*INGEST_LOG.fieldNames())
        publish(log, root, _RUN_DATE, "ingest_log")
    log = read_table(spark, root, _RUN_DATE, "ingest_log")
    return log.groupBy("batch_id", "status").agg(
        F.count("*").alias("sources"), F.sum("rows_loaded").alias("rows_loaded")
    )


@query
def silver_log_append(spark, folder):
    root = scratch_dir(spark, "log")
    for _ in range(2):
        append_rows(feeds.silver_log(spark, folder), root, _RUN_DATE, "silver_log")
    log = read_table(spark, root, _RUN_DATE, "silver_log")
    return log.groupBy("source_name").agg(
        F.count("*").alias("records"),
        F.count("error_message").alias("errors"),
        F.sum("row_count_in").alias("row_count_in"),
    )


@query
def landing_ingest(spark, folder):
    root = scratch_dir(spark, "landing")
    source = BY_CODE["SRC03"]
    delivered = feeds.landed(feeds.customers(spark, folder).drop(ROW_SEQ), source)
    early = F.col("customer_type").contains("building")
    # the files of the second day have their columns in another order and one more
    turned = delivered.select(*reversed(delivered.columns), F.lit("gold").alias("loyalty"))
    for name, part in (("day1", delivered.filter(early)), ("day2", turned.filter(~early))):
        part.write.option("header", True).csv(f"{root}/in/{source.file}/{name}")
        if name == "day2":
            # a file that lacks what the contract asks for must not stop the others
            part.select("phone").limit(1).write.option("header", True).csv(f"{root}/in/{source.file}/bad")
        ingest_new_files(spark, f"{root}/in", f"{root}/bronze", f"{root}/seen", _RUN_DATE, _BATCH)
    table = read_table(spark, f"{root}/bronze", _RUN_DATE, source.name)
    columns = ["customer_id", "customer_name", "phone", "loyalty", "_source_file", "_run_date"]
    return table.select(*columns)


@query
def run_history_latest(spark, folder):
    root = scratch_dir(spark, "history")
    log = feeds.silver_log(spark, folder)
    week = F.date_format(F.trunc(F.col("run_date").cast("date"), "week"), "yyyyMMdd")
    publish_days(log.withColumn("week", week), "week", root, "silver_log")
    latest = latest_per(run_history(spark, root, "silver_log"), ["source_name"])
    return latest.select("source_name", "run_day", "run_date", "row_count_in", "row_count_out")


# --- columns -----------------------------------------------------------------


@query
def bronze_lineage(spark, folder):
    rows = feeds.table(spark, folder, "customer").select("c_custkey", "c_name")
    stamped = bronze.attach_lineage(
        rows, BY_CODE["SRC03"].file, _RUN_DATE, _BATCH, datetime(2026, 7, 22, 1, 2, 3)
    )
    return bronze.cast_to_string(stamped)


@query
def bronze_cast_string(spark, folder):
    return bronze.cast_to_string(
        feeds.table(spark, folder, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            "l_returnflag",
            F.col("l_shipdate").cast("date").alias("l_shipdate"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"),
        )
    )


@query
def silver_money_cast(spark, folder):
    text = F.when(F.col("o_orderkey") % 97 != 0, F.format_number("o_totalprice", 2))
    rows = feeds.table(spark, folder, "orders").select("o_orderkey", text.alias("amount"))
    return silver.cast_numbers(rows, ("amount",))


@query
def silver_date_cast(spark, folder):
    day = F.col("o_orderdate").cast("date").cast("string")
    text = (
        F.when(F.col("o_orderkey") % 89 == 0, "not-a-date")
        .when(F.col("o_orderkey") % 83 == 0, F.concat(day, F.lit(" 00:00:00")))
        .otherwise(day)
    )
    rows = feeds.table(spark, folder, "orders").select("o_orderkey", text.alias("order_date"))
    return silver.cast_dates(rows, ("order_date",), "yyyy-MM-dd")


@query
def silver_text_standardize(spark, folder):
    rows = feeds.table(spark, folder, "customer").select(
        "c_custkey",
        F.concat(F.lit("\t "), F.col("c_name"), F.lit("\u00a0\n")).alias("customer_name"),
        F.concat(F.lit("\u3000"), F.lower("c_mktsegment"), F.lit(" miền nam\u00a0")).alias("segment"),
    )
    return silver.standardize_text(rows, ("customer_name", "segment"))


@query
def silver_fill_null(spark, folder):
    rows = feeds.customers(spark, folder).select("customer_id", "tax_code", "status")
    return silver.fill_null(rows, ("tax_code",), "UNKNOWN")


@query
def log_source_name(spark, folder):
    stem = F.concat(F.col("p_name"), F.lit("."), F.col("p_brand"))
    file = (
        F.when(F.col("p_size") < 10, F.concat(F.lit("."), F.col("p_type")))
        .when(F.col("p_size") < 20, F.col("p_name"))
        .otherwise(F.concat(stem, F.lit(".csv")))
    )
    rows = feeds.table(spark, folder, "part")
    return rows.select("p_partkey", source_name(file).alias("source_name"))


# --- filters and data quality ------------------------------------------------


@query
def silver_drop_null_keys(spark, folder):
    rows = feeds.table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 97 != 0, F.col("o_custkey")).alias("customer"),
        F.when(F.col("o_orderkey") % 89 != 0, F.col("o_orderpriority")).alias("priority"),
    )
    return silver.drop_null_keys(rows, ("customer", "priority"))


@query
def schema_contract_profile(spark, folder):
    delivered = feeds.landed_sales(spark, folder).drop("payment_status")
    return quality.contract_profile(delivered, BY_CODE["SRC01"])


@query
def dq_date_null_ratio(spark, folder):
    day = F.col("l_shipdate").cast("date").cast("string")
    number = F.col("l_orderkey")
    rows = feeds.table(spark, folder, "lineitem").select(
        F.when(number % 89 == 0, "bad").otherwise(day).alias("order_date"),
        F.when(number % 97 != 0, day).alias("expected_delivery_date"),
        F.when(number % 3 == 0, day).otherwise("03/04/2024").alias("actual_delivery_date"),
    )
    return quality.date_null_ratio(rows, BY_CODE["SRC05"])


@query
def dq_grain_check(spark, folder):
    return quality.grain_violations(feeds.sales(spark, folder), ["order_id", "product_id"])


@query
def dq_orphan_fk(spark, folder):
    keys = ["customer_key", "product_key", "date_key", "employee_key"]
    return quality.key_resolution(_fact_sales(spark, folder), keys)


# --- joins -------------------------------------------------------------------


@query
def fact_lookup_unknown(spark, folder):
    fact = feeds.sales(spark, folder).select("order_id", "line_no", "customer_id", "product_id")
    customers = dimensions.build_dim_customers(feeds.customers(spark, folder))
    products = dimensions.build_dim_products(feeds.products(spark, folder))
    lookups = [
        facts.key_lookup(customers, "customer_id", "customer_key"),
        facts.key_lookup(products, "product_id", "product_key"),
    ]
    return star_join(fact, lookups)


@query
def fact_date_key(spark, folder):
    days = dimensions.build_dim_date((feeds.sales(spark, folder), "order_date"))
    rows = feeds.returns(spark, folder).select("return_id", "return_date", "return_amount")
    return star_join(rows, [facts.date_lookup(days, "return_date")])


def _dim_employees(spark, folder):
    return dimensions.build_dim_employees(feeds.employees(spark, folder))


_BY_EMPLOYEE = (["employee_id"], "order_date", "employee_key")


@query
def asof_employee_key(spark, folder):
    rows = feeds.sales(spark, folder).select("order_id", "line_no", "employee_id", "order_date")
    return resolve_asof(rows, _dim_employees(spark, folder), *_BY_EMPLOYEE)


@query
def asof_window_variant(spark, folder):
    rows = feeds.sales(spark, folder).select("order_id", "line_no", "employee_id", "order_date")
    return asof_by_bucket(rows, _dim_employees(spark, folder), *_BY_EMPLOYEE)


def _territories(assigned):
    return dimensions.build_dim_territories(assigned, "territory_id")


def _dim_territory(spark, folder):
    return _territories(feeds.territories(spark, folder))


@query
def asof_territory_key(spark, folder):
    rows = feeds.sales(spark, folder).select(
        "order_id", "line_no", "employee_id", "customer_id", "order_date"
    )
    return facts.resolve_territory(rows, _dim_territory(spark, folder), "order_date")


@query
def promo_bridge(spark, folder):
    sales, offers = feeds.sales(spark, folder), feeds.promotions(spark, folder)
    return promotions.promotion_bridge(sales, offers, ["order_id", "line_no"])


# --- deduplication, keys, calendar -------------------------------------------


@query
def silver_dedup_full_row(spark, folder):
    copies = F.explode(F.expr("sequence(0, if(l_partkey % 50 = 0, 2, 0))"))
    rows = feeds.table(spark, folder, "lineitem").withColumn("copy", copies)
    return silver.drop_copies(
        rows.select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_quantity")
    )


@query
def dedup_keep_first(spark, folder):
    rows = feeds.products(spark, folder).select("product_id", "product_name", ROW_SEQ)
    return dimensions.keep_first(rows, "product_id").drop(ROW_SEQ)


@query
def silver_stats(spark, folder):
    return silver.transform_stats(feeds.landed_sales(spark, folder), BY_CODE["SRC01"])


@query
def silver_transform(spark, folder):
    clean = silver.transform(feeds.landed_sales(spark, folder), BY_CODE["SRC01"])
    return clean.select(
        "order_id",
        "order_date",
        "customer_id",
        "region",
        "channel",
        "employee_id",
        "product_id",
        "quantity",
        "gross_amount",
        "net_amount",
        "payment_status",
    )


@query
def surrogate_key_dense(spark, folder):
    rows = feeds.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    rows = rows.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return dense_key(rows, "order_key", ["o_orderdate", "o_custkey", "o_orderkey"])


@query
def unknown_member(spark, folder):
    rows = feeds.table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + 1).alias("supplier_key"),
        F.col("s_name").alias("supplier_id"),
        feeds.ident("mail", "s_suppkey").alias("email"),
        F.col("s_acctbal").alias("balance"),
        F.lit(True).alias("is_current"),
    )
    return dimensions.add_unknown_member(
        rows, "supplier_key", "supplier_id", {"is_current": False}
    )


@query
def scd2_valid_dates(spark, folder):
    rows = dimensions.add_valid_dates(feeds.employees(spark, folder))
    return rows.select("employee_id", "version", "resign_date", "valid_from", "valid_to")


@query
def scd2_is_current(spark, folder):
    rows = dimensions.add_valid_dates(feeds.employees(spark, folder))
    return dimensions.add_is_current(rows).select("employee_id", "valid_from", "is_current")


# --- dimensions and facts ----------------------------------------------------


@query
def dim_customers(spark, folder):
    return dimensions.build_dim_customers(feeds.customers(spark, folder))


@query
def dim_products(spark, folder):
    return dimensions.build_dim_products(feeds.products(spark, folder))


@query
def dim_distributors(spark, folder):
    return dimensions.build_dim_distributors(feeds.distributors(spark, folder))


@query
def dim_date(spark, folder):
    return dimensions.build_dim_date((feeds.sales(spark, folder), "order_date"))


@query
def dim_employees(spark, folder):
    return _dim_employees(spark, folder)


@query
def dim_territory(spark, folder):
    return _dim_territory(spark, folder)


@query
def dim_promotion(spark, folder):
    offers = feeds.promotions(spark, folder).withColumn(ROW_SEQ, F.xxhash64("promotion_id"))
    rows = offers.select("promotion_id", "promotion_type", "target_region", "start_date", "end_date",
                         "actual_cost_vnd", "applicable_products", ROW_SEQ)
    return dimensions.build_dim_promotions(rows, "promotion_id")


# Dimensions with a key of their own lie in a scratch table already; other tables that
# several steps look at are written down, as they would lie in Gold.


def _customers(spark, folder):
    return dimensions.build_dim_customers(feeds.customers(spark, folder))


def _products(spark, folder):
    return dimensions.build_dim_products(feeds.products(spark, folder))


def _fact_sales(spark, folder, with_territory=False):
    sales = stored(feeds.sales(spark, folder), "sales")
    return facts.build_fact_sales(
        sales,
        _customers(spark, folder),
        _products(spark, folder),
        _dim_employees(spark, folder),
        dimensions.build_dim_date((sales, "order_date")),
        _territories(feeds.territories_of(sales)) if with_territory else None,
    )


@query
def fact_sales(spark, folder):
    return _fact_sales(spark, folder)


@query
def fact_sales_territory(spark, folder):
    return _fact_sales(spark, folder, with_territory=True)


@query
def fact_targets(spark, folder):
    fact = facts.build_fact_targets(feeds.targets(spark, folder), _dim_employees(spark, folder))
    return fact.select("employee_id", "year", "month", "target_revenue", "employee_key")


def _wide_calendar(spark, folder):
    dates = feeds.all_dates(spark, folder)
    return dimensions.build_dim_date(*[(dates, column) for column in dates.columns])


@query
def fact_returns(spark, folder):
    return facts.build_fact_returns(
        stored(feeds.returns(spark, folder), "returns"),
        _customers(spark, folder),
        _products(spark, folder),
        _dim_employees(spark, folder),
        stored(_wide_calendar(spark, folder), "dates"),
        _dim_territory(spark, folder),
    )


@query
def fact_distributor_orders(spark, folder):
    return facts.build_fact_distributor_orders(
        stored(feeds.distributor_orders(spark, folder), "orders"),
        _products(spark, folder),
        stored(_wide_calendar(spark, folder), "dates"),
        stored(
            dimensions.build_dim_distributors(feeds.distributors(spark, folder)), "distributors"
        ),
    )


# --- marts and key figures ---------------------------------------------------


def _mart(spark, folder):
    return marts.sales_vs_target(
        feeds.sales(spark, folder), feeds.targets(spark, folder), _dim_employees(spark, folder)
    )


@query
def mart_sales_vs_target(spark, folder):
    columns = ["region", "year", "month", "actual_revenue", "target_revenue", "variance"]
    return _mart(spark, folder).select(*columns, F.round("variance_pct", 6).alias("variance_pct"))


@query
def kpi_achievement(spark, folder):
    rate = F.round("achievement_rate", 6).alias("achievement_rate")
    return _mart(spark, folder).select("region", "year", "month", rate)


@query
def kpi_worst_region(spark, folder):
    return marts.furthest_from_target(_mart(spark, folder))


@query
def kpi_revenue(spark, folder):
    sales = feeds.sales(spark, folder)
    month = sales.withColumns({"year": F.year("order_date"), "month": F.month("order_date")})
    return marts.revenue(month, ["year", "month", "region", "channel"])


@query
def kpi_top5(spark, folder):
    return marts.top_groups(feeds.sales(spark, folder), ["region", "channel"])


@query
def kpi_growth(spark, folder):
    rows = marts.growth(feeds.sales(spark, folder), ["region", "channel"])
    rounded = {name: F.round(name, 6) for name in ("mom_growth", "yoy_growth")}
    return rows.withColumns(rounded)


@query
def kpi_promo_sales(spark, folder):
    return promotions.promotion_sales(feeds.sales(spark, folder), feeds.promotions(spark, folder))


def _uplift(spark, folder):
    return promotions.promotion_uplift(feeds.sales(spark, folder), feeds.promotions(spark, folder))


@query
def kpi_promo_uplift(spark, folder):
    names = ["in_period_daily_revenue", "before_period_daily_revenue", "daily_uplift"]
    rounded = [F.round(name, 4).alias(name) for name in names]
    return _uplift(spark, folder).select("promotion_id", *rounded)


@query
def kpi_promo_roi(spark, folder):
    rounded = [F.round(name, 4).alias(name) for name in ("uplift_revenue", "roi")]
    return _uplift(spark, folder).select("promotion_id", *rounded)


@query
def kpi_fill_rate(spark, folder):
    rows = marts.fill_rate(feeds.distributor_orders(spark, folder), ["distributor_id"])
    return rows.withColumn("fill_rate", F.round("fill_rate", 6))


@query
def kpi_ontime(spark, folder):
    rows = marts.on_time_rate(feeds.distributor_orders(spark, folder), ["distributor_id"])
    return rows.withColumn("on_time_rate", F.round("on_time_rate", 6))


@query
def kpi_return_rate(spark, folder):
    rows = marts.return_rate(feeds.returns(spark, folder), feeds.sales(spark, folder), ["region"])
    return rows.withColumn("return_rate", F.round("return_rate", 6))


@query
def kpi_sales_by_hist_region(spark, folder):
    employees = _dim_employees(spark, folder)
    sales = feeds.sales(spark, folder).select("employee_id", "order_date", "net_amount")
    fact = resolve_asof(sales, employees, *_BY_EMPLOYEE)
    return marts.sales_by_historical_region(fact, employees)


@query
def kpi_run_success(spark, folder):
    rows = quality.run_success(feeds.run_log(spark, folder))
    return rows.withColumn("success_rate", F.round("success_rate", 6))


@query
def kpi_rows_lost(spark, folder):
    return quality.rows_lost(feeds.silver_log(spark, folder))


# --- layer jobs --------------------------------------------------------------

_FEEDS = {
    "SRC01": feeds.sales,
    "SRC02": feeds.targets,
    "SRC03": feeds.customers,
    "SRC04": feeds.products,
    "SRC05": feeds.distributor_orders,
    "SRC06": feeds.distributors,
    "SRC07": feeds.employees,
    "SRC08": feeds.territories,
    "SRC09": feeds.returns,
    "SRC10": feeds.promotions,
}


# those made of order lines
_OF_LINES = {"SRC01", "SRC02", "SRC08", "SRC09"}


def _feeds(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    """All feeds by code; lines and orders are joined once and stored for those made of them."""
    lines = stored(feeds.order_lines(spark, folder), "order-lines")
    return {
        code: partial(feed, spark, folder, lines) if code in _OF_LINES else partial(feed, spark, folder)
        for code, feed in _FEEDS.items()
    }


def _feed_readers(spark: SparkSession, folder: str, faults: dict) -> dict[str, jobs.Reader]:
    """Readers that deliver the feeds in place of files, some of them faulty."""
    delivered_by = _feeds(spark, folder)

    def read(source: SourceSpec, _paths: list[str]) -> DataFrame:
        code = source.file[:5]
        delivered = feeds.landed(delivered_by[code](), source)
        return faults[code](delivered) if code in faults else delivered

    return {"csv": read, "xlsx": read}


@query
def bronze_job(spark, folder):
    def unreadable(_: DataFrame) -> DataFrame:
        raise OSError("cannot read")

    faults = {"SRC08": unreadable, "SRC10": lambda df: df.drop("created_by")}
    root = scratch_dir(spark, "bronze")
    readers = _feed_readers(spark, folder, faults)
    jobs.run_bronze(spark, _RUN_DATE, _BATCH, "unused", root, readers)
    log = read_table(spark, root, _RUN_DATE, "ingest_log")
    return log.drop("duration_sec")


@query
def silver_job(spark, folder):
    bad_price = F.when(F.col("product_id") == "PRD1", "12 VND").otherwise(F.col("unit_price"))
    faults = {"SRC04": lambda df: df.withColumn("unit_price", bad_price)}
    root = scratch_dir(spark, "silver")
    readers = _feed_readers(spark, folder, faults)
    jobs.run_bronze(spark, _RUN_DATE, _BATCH, "unused", f"{root}/bronze", readers)
    jobs.run_silver(spark, _RUN_DATE, f"{root}/bronze", f"{root}/silver")
    log = read_table(spark, f"{root}/silver", _RUN_DATE, "silver_log")
    return log.withColumn("has_error", F.col("error_message").isNotNull()).drop("error_message")


@query
def silver_read_back(spark, folder):
    """The customer table as the jobs wrote it, from a feed with an empty key."""
    source = BY_CODE["SRC03"]
    nameless = F.when(F.col("customer_id") == "CUS1", None).otherwise(F.col("customer_id"))
    faults = {"SRC03": lambda df: df.withColumn("customer_id", nameless)}
    root = scratch_dir(spark, "read-back")
    readers = _feed_readers(spark, folder, faults)
    jobs.run_bronze(spark, _RUN_DATE, _BATCH, "unused", f"{root}/bronze", readers, (source,))
    jobs.run_silver(spark, _RUN_DATE, f"{root}/bronze", f"{root}/silver", (source,))
    rows = read_table(spark, f"{root}/silver", _RUN_DATE, source.name)
    columns = ["customer_id", "customer_name", "tax_code", "join_date", "credit_limit"]
    return rows.select(*columns, "_source_file", "_batch_id")


def _gold(spark, folder) -> str:
    """All Gold tables, written; the folder they are in."""
    root = scratch_dir(spark, "gold")
    with scratch_of_job(spark), shuffles_removed(spark):
        typed_by = _feeds(spark, folder)

        def clean(source: SourceSpec) -> None:
            typed = typed_by[source.file[:5]]()
            if ROW_SEQ not in typed.columns:
                typed = typed.withColumn(ROW_SEQ, F.monotonically_increasing_id())
            publish(typed, f"{root}/silver", _RUN_DATE, source.name, SMALL)

        for _ in jobs.each_source(clean, SOURCES):
            pass
    jobs.run_gold(spark, _RUN_DATE, f"{root}/silver", f"{root}/gold")
    return f"{root}/gold"


@query
def gold_read_back(spark, folder):
    """The sales fact as the Gold run wrote it."""
    return read_table(spark, _gold(spark, folder), _RUN_DATE, "fact_sales")


@query
def gold_job(spark, folder):
    log = read_table(spark, _gold(spark, folder), _RUN_DATE, "gold_log").where("status = 'success'")
    return log.select("table_name", F.col("rows").alias("row_count"))
