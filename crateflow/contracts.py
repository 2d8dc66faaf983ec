"""Source contracts, lineage columns, log schemas and personal columns.

A contract names the columns a source must carry and the part each plays in
Silver: ``key`` must be filled, ``date`` is parsed, ``num`` becomes a double,
``text`` is trimmed and uppercased, and a column without a part stays a string.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class SourceSpec:
    """What one source file has to deliver."""

    file: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    dates: tuple[str, ...]
    numbers: tuple[str, ...]
    texts: tuple[str, ...]
    fills: tuple[tuple[str, str], ...] = ()
    date_format: str = "yyyy-MM-dd"
    # a quoted line break makes a CSV file unsplittable, so a feed that is
    # known to have none may turn this off and be read in parallel splits
    multiline: bool = True

    @property
    def name(self) -> str:
        return self.file.rsplit(".", 1)[0]

    @property
    def format(self) -> str:
        return self.file.rsplit(".", 1)[1]


# File names, column names and their parts are the interface to
# the upstream systems, in the order the files carry them. SRC01 and SRC09 carry
# no free text, so no line breaks: their files are read in parallel splits.
SOURCES: tuple[SourceSpec, ...] = (
    SourceSpec(
        file="SRC01_sales_transactions.csv",
        columns=(
            "order_id", "order_date", "order_month", "order_quarter", "order_year",
            "customer_id", "region", "province", "channel", "employee_id", "product_id",
            "product_category", "quantity", "unit_price", "discount_pct", "discount_amount",
            "gross_amount", "net_amount", "delivery_status", "payment_method", "payment_status",
        ),
        keys=("order_id", "customer_id", "product_id"),
        dates=("order_date",),
        numbers=(
            "quantity", "unit_price", "discount_pct", "discount_amount", "gross_amount",
            "net_amount",
        ),
        texts=(
            "region", "province", "channel", "product_category", "delivery_status",
            "payment_method", "payment_status",
        ),
        multiline=False,
    ),
    SourceSpec(
        file="SRC03_customer_master.csv",
        columns=(
            "customer_id", "customer_name", "customer_type", "channel", "province", "region",
            "address", "phone", "tax_code", "join_date", "credit_limit", "status",
        ),
        keys=("customer_id",),
        dates=("join_date",),
        numbers=("credit_limit",),
        texts=("customer_type", "channel", "province", "region", "status"),
        fills=(("tax_code", "UNKNOWN"),),
    ),
    SourceSpec(
        file="SRC06_distributor_master.csv",
        columns=(
            "distributor_id", "distributor_name", "tier", "channel", "province", "region",
            "contact_person", "phone", "email", "tax_code", "join_date", "credit_limit",
            "status", "assigned_supervisor_id",
        ),
        keys=("distributor_id",),
        dates=("join_date",),
        numbers=("credit_limit",),
        texts=("tier", "channel", "province", "region", "status"),
    ),
    SourceSpec(
        file="SRC09_return_transactions.csv",
        columns=(
            "return_id", "original_order_id", "return_date", "return_month", "customer_id",
            "employee_id", "product_id", "region", "province", "return_quantity", "unit_price",
            "return_amount", "return_reason", "status",
        ),
        keys=("return_id", "customer_id", "product_id"),
        dates=("return_date",),
        numbers=("return_quantity", "unit_price", "return_amount"),
        texts=("region", "province", "return_reason", "status"),
        multiline=False,
    ),
    SourceSpec(
        file="SRC02_sales_target_plan.xlsx",
        columns=(
            "plan_version", "version_date", "effective_from", "effective_to", "employee_id",
            "employee_name", "region", "team", "year", "month", "target_revenue",
            "target_quantity", "target_new_customers",
        ),
        keys=("employee_id",),
        dates=("version_date", "effective_from", "effective_to"),
        numbers=("target_revenue", "target_quantity", "target_new_customers"),
        texts=("region", "team"),
    ),
    SourceSpec(
        file="SRC04_product_master.xlsx",
        columns=(
            "product_id", "product_name", "category", "sub_category", "unit", "unit_price",
            "cost_price", "weight_gram", "status", "launch_date",
        ),
        keys=("product_id",),
        dates=("launch_date",),
        numbers=("unit_price", "cost_price", "weight_gram"),
        texts=("category", "sub_category", "unit", "status"),
    ),
    SourceSpec(
        file="SRC05_distributor_orders.xlsx",
        columns=(
            "order_id", "order_date", "order_month", "order_quarter", "distributor_id", "region",
            "channel", "product_id", "product_category", "qty_ordered", "qty_delivered",
            "fill_rate_pct", "unit_price_list", "distributor_price", "gross_amount",
            "delivered_amount", "expected_delivery_date", "actual_delivery_date",
            "ontime_delivery", "delivery_status", "payment_terms",
        ),
        keys=("order_id", "distributor_id", "product_id"),
        dates=("order_date", "expected_delivery_date", "actual_delivery_date"),
        numbers=(
            "qty_ordered", "qty_delivered", "fill_rate_pct", "unit_price_list",
            "distributor_price", "gross_amount", "delivered_amount",
        ),
        texts=(
            "region", "channel", "product_category", "delivery_status", "payment_terms",
        ),
    ),
    SourceSpec(
        file="SRC07_employee_master.xlsx",
        columns=(
            "employee_id", "full_name", "gender", "date_of_birth", "join_date", "position",
            "region", "team", "email", "phone", "status", "version", "effective_date",
            "resign_date", "transfer_note",
        ),
        keys=("employee_id",),
        dates=("date_of_birth", "join_date", "effective_date", "resign_date"),
        numbers=(),
        texts=("gender", "position", "region", "team", "status"),
    ),
    SourceSpec(
        file="SRC08_territory_mapping.xlsx",
        columns=(
            "territory_id", "employee_id", "customer_id", "region", "team", "effective_date",
            "expiry_date", "version",
        ),
        keys=("territory_id", "employee_id", "customer_id"),
        dates=("effective_date", "expiry_date"),
        numbers=(),
        texts=("region", "team"),
    ),
    SourceSpec(
        file="SRC10_promotion_program.xlsx",
        columns=(
            "promotion_id", "promotion_name", "promotion_type", "target_channel",
            "target_region", "start_date", "end_date", "applicable_products", "discount_pct",
            "min_order_quantity", "budget_vnd", "actual_cost_vnd", "status", "created_by",
        ),
        keys=("promotion_id",),
        dates=("start_date", "end_date"),
        numbers=(
            "discount_pct", "min_order_quantity", "budget_vnd", "actual_cost_vnd",
        ),
        texts=("promotion_type", "target_channel", "target_region", "status"),
    ),
)

# SRC01 … SRC10, the short handle used inside the library
BY_CODE: dict[str, SourceSpec] = {source.file[:5]: source for source in SOURCES}

# Lineage columns of Bronze and Silver.
LINEAGE = ("_source_file", "_source_platform", "_run_date", "_ingested_at", "_batch_id")
PLATFORM = "google_drive"
# position of a row in its source file; "keep the first" and row-numbered keys
# need it because a distributed table has no row order
ROW_SEQ = "_row_seq"

# Personal columns that must not reach Gold.
PERSONAL = {
    "dim_customers": ("address", "phone", "tax_code"),
    "dim_distributors": ("phone", "tax_code"),
    "dim_employees": ("phone", "date_of_birth"),
}

UNKNOWN_KEY = -1

INGEST_LOG = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("source_platform", T.StringType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("duration_sec", T.DoubleType()),
    ]
)

SILVER_LOG = T.StructType(
    [
        T.StructField("source_name", T.StringType()),
        T.StructField("run_date", T.StringType()),
        T.StructField("row_count_in", T.LongType()),
        T.StructField("row_count_out", T.LongType()),
        T.StructField("null_count", T.LongType()),
        T.StructField("dedup_count", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)

GOLD_LOG = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("run_date", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("copies_dropped", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)

LANDING_LOG = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
