"""Marts and key figures over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crateflow.functions.columns import first_of_month, money_sum, share, whole
from crateflow.operators.asof import resolve_asof, version_attribute
from crateflow.session import stored

UNKNOWN_REGION = "Unknown"


def revenue(fact: DataFrame, by: list[str]) -> DataFrame:
    """Net revenue per group."""
    return fact.groupBy(*by).agg(money_sum("net_amount").alias("revenue"))


def top_groups(fact: DataFrame, by: list[str], n: int = 5) -> DataFrame:
    """The ``n`` groups with the highest revenue; equal ones in name order."""
    return revenue(fact, by).orderBy(F.desc("revenue"), *by).limit(n)


def growth(fact: DataFrame, by: list[str], date: str = "order_date") -> DataFrame:
    """Monthly revenue per group with its growth over last month and last year.

    Months without a sale are filled in before looking back, so ``lag`` counts
    calendar months. A window group holds the months of one group.
    """
    month = F.trunc(date, "month").cast("date")
    sales = fact.filter(F.col(date).isNotNull()).groupBy(*by, month.alias("month_start"))
    monthly = sales.agg(F.sum(F.col("net_amount").cast("decimal(18,4)")).alias("_revenue"))
    span = F.expr("sequence(min(month_start), max(month_start), interval 1 month)")
    months = monthly.groupBy(*by).agg(span.alias("_months"))
    empty = months.select(*by, F.explode("_months").alias("month_start"))
    # an empty row per month joins the real one in the same group
    dense = (
        monthly.unionByName(empty.withColumn("_revenue", F.lit(None).cast(monthly.schema["_revenue"].dataType)))
        .groupBy(*by, "month_start")
        .agg(F.coalesce(F.sum("_revenue").cast("double"), F.lit(0.0)).alias("revenue"))
    )
    order = Window.partitionBy(*by).orderBy("month_start")
    now = F.col("revenue")

    def change(months_back: int):
        then = F.lag("revenue", months_back).over(order)
        return share(now - then, then)

    return dense.withColumns({"mom_growth": change(1), "yoy_growth": change(12)})


def sales_vs_target(
    fact_sales: DataFrame, fact_targets: DataFrame, dim_employees: DataFrame
) -> DataFrame:
    """Actual against target revenue per region and month.

    Targets are set per employee, so both sides are brought to employee and
    month first and meet in a full outer join of equal grain. The region is
    that of the employee version in force on the first of the month.
    """
    keys = ["employee_id", "year", "month"]
    actual = fact_sales.groupBy(
        "employee_id",
        F.year("order_date").alias("year"),
        F.month("order_date").alias("month"),
    ).agg(money_sum("net_amount").alias("actual"))
    target = fact_targets.groupBy(
        "employee_id", whole("year").alias("year"), whole("month").alias("month")
    ).agg(money_sum("target_revenue").alias("target"))
    grain = actual.join(target, keys, "full_outer")
    # looked at for its dates and for its keys, and small: a row per employee and month
    dated = stored(grain.withColumn("_day", first_of_month(F.col("year"), F.col("month"))), "grain")
    keyed = resolve_asof(dated, dim_employees, ["employee_id"], "_day", "employee_key")
    placed = version_attribute(keyed, dim_employees, "employee_key", {"region": "_region"})
    region = F.when(F.col("employee_key") == -1, UNKNOWN_REGION).otherwise(F.col("_region"))
    sums = placed.groupBy(region.alias("region"), "year", "month").agg(
        F.coalesce(money_sum("actual"), F.lit(0.0)).alias("actual_revenue"),
        F.coalesce(money_sum("target"), F.lit(0.0)).alias("target_revenue"),
    )
    variance = F.col("actual_revenue") - F.col("target_revenue")
    return sums.withColumns(
        {
            "variance": variance,
            "variance_pct": share(F.lit(100) * variance, F.col("target_revenue")),
            "achievement_rate": share(F.col("actual_revenue"), F.col("target_revenue")),
        }
    )


def furthest_from_target(mart: DataFrame) -> DataFrame:
    """Per month the region whose revenue is furthest from its target.

    An aggregate, so no month has to be sorted; equal distances go to the
    region that comes first by name.
    """
    place = F.struct(-F.abs(F.col("variance")), F.col("region"))
    row = F.struct("region", "actual_revenue", "target_revenue", "variance")
    first = mart.groupBy("year", "month").agg(F.min_by(row, place).alias("_first"))
    return first.select("year", "month", "_first.*")


def fill_rate(orders: DataFrame, by: list[str]) -> DataFrame:
    """Mean of delivered over ordered per line; lines without an order quantity do not count."""
    ratio = share(F.col("qty_delivered"), F.col("qty_ordered"))
    return orders.groupBy(*by).agg(F.avg(ratio).alias("fill_rate"))


def on_time_rate(orders: DataFrame, by: list[str]) -> DataFrame:
    """Share of lines delivered on time; the flag is text and may be padded."""
    on_time = F.count_if(F.lower(F.trim("ontime_delivery")) == "true")
    return orders.groupBy(*by).agg(share(on_time, F.count("*")).alias("on_time_rate"))


def return_rate(returns: DataFrame, sales: DataFrame, by: list[str]) -> DataFrame:
    """Returned over gross amount per group, each side added up before they meet."""
    back = returns.groupBy(*by).agg(money_sum("return_amount").alias("return_amount"))
    gross = sales.groupBy(*by).agg(money_sum("gross_amount").alias("gross_amount"))
    joined = back.join(gross, by, "full_outer")
    return joined.withColumn("return_rate", share(F.col("return_amount"), F.col("gross_amount")))


def sales_by_historical_region(fact_sales: DataFrame, dim_employees: DataFrame) -> DataFrame:
    """Revenue per employee and the region held when each sale was made.

    Sales are added up per employee version first; only those sums meet the
    dimension.
    """
    per_version = fact_sales.groupBy("employee_key").agg(
        F.sum(F.col("net_amount").cast("decimal(18,4)")).alias("_revenue"),
        F.count("*").alias("_lines"),
    )
    placed = version_attribute(
        per_version, dim_employees, "employee_key",
        {"employee_id": "employee_id", "region": "region"},
    )
    return placed.groupBy("employee_id", "region").agg(
        F.sum("_revenue").cast("double").alias("revenue"), F.sum("_lines").alias("order_lines")
    )
