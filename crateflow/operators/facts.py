"""Gold facts: source rows with surrogate keys in place of lookups at query time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.contracts import ROW_SEQ, UNKNOWN_KEY
from crateflow.functions.columns import first_of_month, whole
from crateflow.operators.asof import asof_lookup
from crateflow.plans.spread import Lookup, star_join


def key_lookup(dimension: DataFrame, business_key: str, key: str) -> Lookup:
    """The surrogate key of ``business_key``, -1 where the dimension has none."""
    unknown = F.lit(UNKNOWN_KEY).cast("long")
    narrow = dimension.select(business_key, key)
    return Lookup(narrow, {business_key: F.col(business_key)}, key, lambda row: F.coalesce(row[key], unknown))


def date_lookup(dim_date: DataFrame, date: str) -> Lookup:
    """``date_key``; a date outside the calendar has none.

    The calendar is broadcast when its size allows: a single date in the
    year 9999 makes it millions of rows.
    """
    narrow = dim_date.select("full_date", "date_key")
    return Lookup(narrow, {"full_date": F.col(date)}, "date_key", lambda row: row["date_key"])


def employee_lookup(dim_employees: DataFrame, date: str) -> Lookup:
    """The key of the employee version in force on a date."""
    return asof_lookup(dim_employees, ["employee_id"], date, "employee_key")


def territory_lookup(dim_territories: DataFrame, date: str) -> Lookup:
    """The territory that covered employee and customer on a date.

    The latest assignment on or before the date counts; once it has expired
    there is none.
    """
    by = ["employee_id", "customer_id"]
    return asof_lookup(dim_territories, by, date, "territory_key", "effective_date", "expiry_date")


def build_fact_sales(
    sales: DataFrame,
    dim_customers: DataFrame,
    dim_products: DataFrame,
    dim_employees: DataFrame,
    dim_date: DataFrame,
    dim_territories: DataFrame | None = None,
) -> DataFrame:
    """One row per order line, with customer, product, date and employee keys.

    With ``dim_territories`` also the territory in force on the order date.
    """
    lookups = [
        key_lookup(dim_customers, "customer_id", "customer_key"),
        key_lookup(dim_products, "product_id", "product_key"),
        date_lookup(dim_date, "order_date"),
        employee_lookup(dim_employees, "order_date"),
    ]
    if dim_territories is not None:
        lookups.append(territory_lookup(dim_territories, "order_date"))
    return star_join(sales.drop(ROW_SEQ), lookups, keys_from=sales)


def build_fact_targets(targets: DataFrame, dim_employees: DataFrame) -> DataFrame:
    """One row per employee and month, keyed as of the first of the month."""
    fact = targets.drop(ROW_SEQ).withColumn("_day", first_of_month(whole("year"), whole("month")))
    return resolve_employee(fact, dim_employees, "_day").drop("_day")


def resolve_employee(fact: DataFrame, dim_employees: DataFrame, date: str) -> DataFrame:
    """Add the key of the employee version in force on a date."""
    return star_join(fact, [employee_lookup(dim_employees, date)])


def resolve_territory(fact: DataFrame, dim_territories: DataFrame, date: str) -> DataFrame:
    """Add the territory that covered employee and customer on a date."""
    return star_join(fact, [territory_lookup(dim_territories, date)])


def build_fact_returns(
    returns: DataFrame,
    dim_customers: DataFrame,
    dim_products: DataFrame,
    dim_employees: DataFrame,
    dim_date: DataFrame,
    dim_territories: DataFrame,
) -> DataFrame:
    """One row per return, with customer, product, date, employee and territory keys."""
    lookups = [
        key_lookup(dim_customers, "customer_id", "customer_key"),
        key_lookup(dim_products, "product_id", "product_key"),
        date_lookup(dim_date, "return_date"),
        employee_lookup(dim_employees, "return_date"),
        territory_lookup(dim_territories, "return_date"),
    ]
    return star_join(returns.drop(ROW_SEQ), lookups, keys_from=returns)


def build_fact_distributor_orders(
    orders: DataFrame, dim_products: DataFrame, dim_date: DataFrame, dim_distributors: DataFrame
) -> DataFrame:
    """One row per distributor order line, with product, date and distributor keys."""
    lookups = [
        key_lookup(dim_products, "product_id", "product_key"),
        date_lookup(dim_date, "order_date"),
        key_lookup(dim_distributors, "distributor_id", "distributor_key"),
    ]
    return star_join(orders.drop(ROW_SEQ), lookups, keys_from=orders)
