"""The given tables in the shape of the ten sources.

The tables are clean, so faults are put in by fixed rules: customers and
products the masters do not know, sales without an employee, repeated master
rows. The comparison SQL states the same rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crateflow.contracts import BY_CODE, ROW_SEQ, SourceSpec
from crateflow.functions.columns import money_sum
from crateflow.plans.spread import spread_join


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ident(prefix: str, number: Column | str) -> Column:
    """Business identifier such as ``CUS17``."""
    number = F.col(number) if isinstance(number, str) else number
    return F.concat(F.lit(prefix), number.cast("string"))


def astray(name: str) -> Column:
    """A number that its master does not have, for every eleventh."""
    return F.when(F.col(name) % 11 == 0, F.col(name) + 10_000_000).otherwise(F.col(name))


def _repeated(key: str, every: int = 50) -> Column:
    """Explode to one row, or two for some keys: the second is a later copy."""
    both = F.array(F.lit(0), F.lit(1))
    return F.explode(F.when(F.col(key) % every == 0, both).otherwise(F.array(F.lit(0))))


def _copy_mark(name: str) -> Column:
    return F.when(F.col("copy") == 1, F.concat(F.col(name), F.lit(" (copy)"))).otherwise(F.col(name))


def _places(spark: SparkSession, folder: str) -> DataFrame:
    """Nations with the name of their region."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("province"), F.col("r_name").alias("region")
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customer master; every fiftieth customer comes twice."""
    rows = table(spark, folder, "customer").withColumn("copy", _repeated("c_custkey"))
    places = _places(spark, folder)
    return rows.join(places, rows.c_nationkey == places.n_nationkey).select(
        ident("CUS", "c_custkey").alias("customer_id"),
        _copy_mark("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_type"),
        F.lit("RETAIL").alias("channel"),
        "province",
        "region",
        ident("Street ", "c_custkey").alias("address"),
        ident("09", "c_custkey").alias("phone"),
        F.when(F.col("c_custkey") % 7 != 0, ident("TAX", "c_custkey")).alias("tax_code"),
        F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")).alias(
            "join_date"
        ),
        F.col("c_acctbal").alias("credit_limit"),
        F.lit("ACTIVE").alias("status"),
        (F.col("c_custkey") * 2 + F.col("copy")).alias(ROW_SEQ),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Product master; every fiftieth product comes twice."""
    rows = table(spark, folder, "part").withColumn("copy", _repeated("p_partkey"))
    return rows.select(
        ident("PRD", "p_partkey").alias("product_id"),
        _copy_mark("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.lit("BOX").alias("unit"),
        F.col("p_retailprice").alias("unit_price"),
        (F.col("p_retailprice") * 0.5).alias("cost_price"),
        (F.col("p_size") * 10.0).alias("weight_gram"),
        F.lit("ACTIVE").alias("status"),
        F.date_add(F.lit("1994-01-01").cast("date"), F.col("p_size")).alias("launch_date"),
        (F.col("p_partkey") * 2 + F.col("copy")).alias(ROW_SEQ),
    )


def distributors(spark: SparkSession, folder: str) -> DataFrame:
    """Distributor master; every tenth distributor comes twice."""
    rows = table(spark, folder, "supplier").withColumn("copy", _repeated("s_suppkey", 10))
    places = _places(spark, folder)
    return rows.join(places, rows.s_nationkey == places.n_nationkey).select(
        ident("DIS", "s_suppkey").alias("distributor_id"),
        _copy_mark("s_name").alias("distributor_name"),
        F.lit("GOLD").alias("tier"),
        F.lit("RETAIL").alias("channel"),
        "province",
        "region",
        ident("Person ", "s_suppkey").alias("contact_person"),
        ident("08", "s_suppkey").alias("phone"),
        ident("mail", "s_suppkey").alias("email"),
        ident("TAX", "s_suppkey").alias("tax_code"),
        F.lit("1994-01-01").cast("date").alias("join_date"),
        F.col("s_acctbal").alias("credit_limit"),
        F.lit("ACTIVE").alias("status"),
        F.lit("EMP1").alias("assigned_supervisor_id"),
        (F.col("s_suppkey") * 2 + F.col("copy")).alias(ROW_SEQ),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their order, as narrow as sales, returns and their days need them.

    Feeds that are made of order lines take a stored copy as ``lines``, so that a
    run with several of them joins lines and orders once.
    """
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderpriority").alias("channel"),
    )
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.col("l_suppkey") % 130).alias("employee"),
        "l_returnflag",
        "l_quantity",
        "l_discount",
        "l_extendedprice",
        F.col("l_shipdate").cast("date").alias("shipped"),
    )
    return spread_join(lines, orders, ["l_orderkey"], "inner")


def _in_region(spark: SparkSession, folder: str, lines: DataFrame | None) -> DataFrame:
    """Order lines with the region of the customer."""
    lines = order_lines(spark, folder) if lines is None else lines
    region = table(spark, folder, "region").select(
        F.col("r_regionkey"), F.col("r_name").alias("region")
    )
    return lines.join(region, lines.o_custkey % 5 == region.r_regionkey)


def _employee() -> Column:
    """Employee of an order line; number 77 is not filled in, 120 to 129 have no versions."""
    return F.when(F.col("employee") != 77, ident("EMP", "employee"))


def sales(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Sales lines."""
    return _in_region(spark, folder, lines).select(
        ident("ORD", "l_orderkey").alias("order_id"),
        "order_date",
        ident("CUS", astray("o_custkey")).alias("customer_id"),
        "region",
        "channel",
        _employee().alias("employee_id"),
        ident("PRD", astray("l_partkey")).alias("product_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount_pct"),
        F.col("l_extendedprice").alias("gross_amount"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_amount"),
    )


def returns(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Returned order lines."""
    return (
        _in_region(spark, folder, lines)
        .filter("l_returnflag = 'R'")
        .select(
            F.concat(ident("RET", "l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("return_id"),
            ident("ORD", "l_orderkey").alias("original_order_id"),
            F.col("shipped").alias("return_date"),
            ident("CUS", astray("o_custkey")).alias("customer_id"),
            _employee().alias("employee_id"),
            ident("PRD", astray("l_partkey")).alias("product_id"),
            "region",
            F.col("l_quantity").alias("return_quantity"),
            F.col("l_extendedprice").alias("return_amount"),
        )
    )


def all_dates(spark: SparkSession, folder: str) -> DataFrame:
    """The days of sales, returns and distributor orders, from one pass over the lines."""
    return _in_region(spark, folder, None).select(
        "order_date",
        F.when(F.col("l_returnflag") == "R", F.col("shipped")).alias("return_date"),
        F.col("shipped").alias("delivery_date"),
    )


def distributor_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as orders of a distributor."""
    delivered = F.floor(F.col("l_quantity") * (1 - F.col("l_discount"))).cast("double")
    return table(spark, folder, "lineitem").select(
        ident("DOR", "l_orderkey").alias("order_id"),
        F.col("l_shipdate").cast("date").alias("order_date"),
        ident("DIS", "l_suppkey").alias("distributor_id"),
        ident("PRD", astray("l_partkey")).alias("product_id"),
        F.col("l_quantity").alias("qty_ordered"),
        delivered.alias("qty_delivered"),
        F.col("l_extendedprice").alias("gross_amount"),
        F.when(F.col("l_linestatus") == "F", " True ").otherwise("false").alias("ontime_delivery"),
    )


def employees(spark: SparkSession, folder: str) -> DataFrame:
    """Employee versions: one per employee and day of an urgent order.

    120 employees, so at most 120 versions per day of the calendar.
    """
    picked = (
        table(spark, folder, "orders")
        .filter("o_orderpriority = '1-URGENT'")
        .groupBy(
            (F.col("o_custkey") % 120).alias("number"),
            F.col("o_orderdate").cast("date").alias("effective_date"),
        )
        .agg(
            F.min("o_orderkey").alias("version"),
            (F.min_by("o_custkey", "o_orderkey") % 5).alias("place"),
        )
    )
    region = table(spark, folder, "region").select("r_regionkey", F.col("r_name").alias("region"))
    rows = picked.join(region, picked.place == region.r_regionkey)
    last_day = F.max("effective_date").over(Window.partitionBy("number"))
    return rows.select(
        ident("EMP", "number").alias("employee_id"),
        ident("Employee ", "number").alias("full_name"),
        F.lit("F").alias("gender"),
        F.lit("1980-01-01").cast("date").alias("date_of_birth"),
        F.lit("1990-01-01").cast("date").alias("join_date"),
        F.lit("SALES").alias("position"),
        "region",
        ident("TEAM", "place").alias("team"),
        ident("mail", "number").alias("email"),
        ident("07", "number").alias("phone"),
        F.lit("ACTIVE").alias("status"),
        F.col("version").cast("string").alias("version"),
        "effective_date",
        F.when(F.col("number") % 7 == 0, F.date_add(last_day, 30)).alias("resign_date"),
        F.lit(None).cast("string").alias("transfer_note"),
    )


def targets(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Target of an employee for a month: gross sales of the month before, whole units."""
    month = F.add_months(F.trunc("order_date", "month"), 1)
    return (
        _in_region(spark, folder, lines)
        .filter("employee <> 77")
        .groupBy("employee", month.cast("date").alias("effective_from"))
        .agg(
            F.floor(money_sum("l_extendedprice")).cast("double").alias("target_revenue"),
            F.sum("l_quantity").alias("target_quantity"),
        )
        .withColumn("employee_id", _employee())
        .select(
            F.lit("V1").alias("plan_version"),
            F.col("effective_from").alias("version_date"),
            "effective_from",
            F.last_day("effective_from").alias("effective_to"),
            "employee_id",
            F.year("effective_from").cast("string").alias("year"),
            F.month("effective_from").cast("string").alias("month"),
            "target_revenue",
            "target_quantity",
        )
    )


def territories(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Assignments of customers to employees, opened by sales that were kept.

    One lasts until the next of the same pair. The days of a pair are distinct,
    so a window group is bounded by the calendar. Numbers travel and names are
    made of them at the end; one shuffle by pair serves both copies and window.
    """
    kept = _in_region(spark, folder, lines).filter("l_returnflag = 'N' AND employee <> 77")
    opened = (
        kept.withColumn("customer", astray("o_custkey"))
        .select("employee", "customer", "region", F.col("order_date").alias("effective_date"))
        .repartition("employee", "customer")
        .distinct()
        .withColumns({"employee_id": _employee(), "customer_id": ident("CUS", "customer")})
    )
    return _assignments(opened, ["employee", "customer"])


def territories_of(sales: DataFrame) -> DataFrame:
    """``territories`` from a stored copy of ``sales``, so that lines and orders are joined once."""
    kept = sales.filter("return_flag = 'N' AND employee_id IS NOT NULL")
    pair = ["employee_id", "customer_id"]
    opened = kept.select(*pair, "region", F.col("order_date").alias("effective_date"))
    return _assignments(opened.repartition(*pair).distinct(), pair)


def _assignments(opened: DataFrame, pair: list[str]) -> DataFrame:
    following = Window.partitionBy(*pair).orderBy("effective_date")
    return opened.select(
        F.concat_ws("/", "employee_id", "customer_id", "effective_date").alias("territory_id"),
        "employee_id",
        "customer_id",
        "region",
        F.lit("TEAM1").alias("team"),
        "effective_date",
        F.lead("effective_date").over(following).alias("expiry_date"),
        F.lit("1").alias("version"),
    )


PARTS_PER_BLOCK = 500


def promotions(spark: SparkSession, folder: str) -> DataFrame:
    """Promotions of 90 days, one per product type and block of 500 part numbers.

    A block covers at most 500 parts, so the packed list is bounded. In the first
    block, large parts say ``ALL`` and small ones leave the list out: both mean
    every product. Half of the blocks run in one region only, half of the types in one channel.
    """
    block = F.floor(F.col("p_partkey") / PARTS_PER_BLOCK).cast("int")
    listed = (
        table(spark, folder, "part")
        .groupBy("p_type", block.alias("block"))
        .agg(F.array_sort(F.collect_list(ident("PRD", "p_partkey"))).alias("items"))
    )
    region = table(spark, folder, "region").select("r_regionkey", F.col("r_name").alias("name"))
    rows = listed.join(region, listed.block % 5 == region.r_regionkey)
    start = F.date_add(
        F.lit("1996-06-29").cast("date"), 180 * F.pmod(F.col("block") + F.length("p_type"), F.lit(8))
    )
    return rows.select(
        F.concat(F.lit("PRO-"), F.col("p_type"), F.lit("-"), F.col("block")).alias("promotion_id"),
        F.concat(F.lit("Sale of "), F.col("p_type")).alias("promotion_name"),
        F.lit("DISCOUNT").alias("promotion_type"),
        F.when(F.col("p_type").isin("ECONOMY", "LARGE", "PROMO"), "ALL")
        .otherwise("1-URGENT")
        .alias("target_channel"),
        F.when(F.col("block") % 2 == 1, "ALL").otherwise(F.col("name")).alias("target_region"),
        start.alias("start_date"),
        F.date_add(start, 89).alias("end_date"),
        F.when((F.col("block") == 0) & (F.col("p_type") == "LARGE"), "ALL")
        .when((F.col("block") == 0) & (F.col("p_type") == "SMALL"), None)
        .otherwise(F.array_join("items", ", "))
        .alias("applicable_products"),
        F.lit(10.0).alias("discount_pct"),
        F.lit(1.0).alias("min_order_quantity"),
        F.lit(5000.0).alias("budget_vnd"),
        (F.col("block") * 1000.0 + 1000.0).alias("actual_cost_vnd"),
        F.lit("ACTIVE").alias("status"),
        F.lit("MARKETING").alias("created_by"),
    )


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Ingest log out of the event stream: one source per user, one batch per day."""
    return table(spark, folder, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("batch_id"),
        ident("SRC", "user_id").alias("source_name"),
        F.concat(ident("SRC", "user_id"), F.lit(".csv")).alias("source_file"),
        F.lit("google_drive").alias("source_platform"),
        F.floor("value").cast("long").alias("rows_loaded"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.col("value").alias("duration_sec"),
    )


def silver_log(spark: SparkSession, folder: str) -> DataFrame:
    """Silver log out of the event stream: one source per event type, one run per day."""
    by_day = table(spark, folder, "events").groupBy(
        "event_type", F.date_format("ts", "yyyy-MM-dd").alias("run_date")
    )
    counts = by_day.agg(
        F.count("*").alias("row_count_in"),
        F.count_if(F.col("value") < 1).alias("null_count"),
        F.count_if(F.col("value") > 20).alias("dedup_count"),
    )
    kept = F.col("row_count_in") - F.col("null_count") - F.col("dedup_count")
    return counts.select(
        F.col("event_type").alias("source_name"),
        "run_date",
        "row_count_in",
        kept.alias("row_count_out"),
        "null_count",
        "dedup_count",
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.when(F.col("event_type") == "error", "bad file").alias("error_message"),
    )


def landed(df: DataFrame, source: SourceSpec) -> DataFrame:
    """A typed feed as a source would deliver it: all strings, all contract columns.

    Numbers get thousands separators, text is lower-case and padded with tab
    and no-break space; columns the feed does not have are empty.
    """
    pad_left, pad_right = F.lit("\t "), F.lit("\u00a0 ")
    columns = []
    for name in source.columns:
        if name not in df.columns:
            value = F.lit(None).cast("string")
        elif name in source.numbers:
            value = F.format_number(name, 2)
        elif name in source.texts:
            value = F.concat(pad_left, F.lower(name), pad_right)
        else:
            value = F.col(name).cast("string")
        columns.append(value.alias(name))
    if ROW_SEQ in df.columns:
        columns.append(F.col(ROW_SEQ).cast("string").alias(ROW_SEQ))
    return df.select(*columns)


def landed_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales as delivered, with empty order numbers, bad dates and repeated rows."""
    rows = landed(sales(spark, folder), BY_CODE["SRC01"])
    number = F.regexp_extract("order_id", r"(\d+)", 1).cast("long")
    return (
        rows.withColumn("_number", number)
        .withColumn("_copy", F.explode(F.expr("sequence(0, if(_number % 50 = 0, 1, 0))")))
        .withColumns(
            {
                "order_id": F.when(F.col("_number") % 97 != 0, F.col("order_id")),
                "order_date": F.when(F.col("_number") % 89 == 0, "not-a-date").otherwise(
                    F.col("order_date")
                ),
            }
        )
        .drop("_number", "_copy")
    )
