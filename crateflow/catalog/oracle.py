"""What each query should give, in DuckDB SQL that does not follow the Spark plan."""

from __future__ import annotations

from textwrap import dedent

# Shared sub-queries, each over the given tables or over those before it.
_PARTS = {
    "customers": """
        SELECT 'CUS' || c_custkey AS customer_id, c_custkey, c_name, n_name, r_name,
               c_mktsegment, c_acctbal, row_number() OVER (ORDER BY c_custkey) AS customer_key
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "products": """
        SELECT 'PRD' || p_partkey AS product_id, *,
               row_number() OVER (ORDER BY p_partkey) AS product_key
        FROM part""",
    "distributors": """
        SELECT 'DIS' || s_suppkey AS distributor_id, s_suppkey, s_name, s_acctbal, n_name, r_name,
               row_number() OVER (ORDER BY s_suppkey) AS distributor_key
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "lines": """
        SELECT lineitem.*, o_custkey, CAST(o_orderdate AS DATE) AS order_date,
               o_orderpriority AS channel, r_name AS region,
               'CUS' || CASE WHEN o_custkey % 11 = 0 THEN o_custkey + 10000000 ELSE o_custkey END
                   AS customer_id,
               'PRD' || CASE WHEN l_partkey % 11 = 0 THEN l_partkey + 10000000 ELSE l_partkey END
                   AS product_id,
               CASE WHEN l_suppkey % 130 <> 77 THEN 'EMP' || (l_suppkey % 130) END AS employee_id,
               l_extendedprice * (1 - l_discount) AS net_amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN region ON r_regionkey = o_custkey % 5""",
    "sales": """
        SELECT 'ORD' || l_orderkey AS order_id, order_date, customer_id, region, channel,
               employee_id, product_id, l_linenumber AS line_no, l_returnflag AS return_flag,
               l_quantity AS quantity, l_discount AS discount_pct,
               l_extendedprice AS gross_amount, net_amount
        FROM lines""",
    "returns": """
        SELECT 'RET' || l_orderkey || '-' || l_linenumber AS return_id,
               'ORD' || l_orderkey AS original_order_id, CAST(l_shipdate AS DATE) AS return_date,
               customer_id, employee_id, product_id, region,
               l_quantity AS return_quantity, l_extendedprice AS return_amount
        FROM lines WHERE l_returnflag = 'R'""",
    "supply": """
        SELECT 'DOR' || l_orderkey AS order_id, CAST(l_shipdate AS DATE) AS order_date,
               'DIS' || l_suppkey AS distributor_id,
               'PRD' || CASE WHEN l_partkey % 11 = 0 THEN l_partkey + 10000000 ELSE l_partkey END
                   AS product_id,
               l_quantity AS qty_ordered, floor(l_quantity * (1 - l_discount)) AS qty_delivered,
               l_extendedprice AS gross_amount,
               CASE WHEN l_linestatus = 'F' THEN ' True ' ELSE 'false' END AS ontime_delivery
        FROM lineitem""",
    "picked": """
        SELECT o_custkey % 120 AS number, CAST(o_orderdate AS DATE) AS effective_date,
               min(o_orderkey) AS version, arg_min(o_custkey, o_orderkey) % 5 AS place
        FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2""",
    "employees": """
        SELECT 'EMP' || number AS employee_id, number, r_name AS region, place,
               CAST(version AS VARCHAR) AS version, effective_date,
               CASE WHEN number % 7 = 0 THEN CAST(last_day + 30 AS DATE) END AS resign_date
        FROM picked JOIN region ON r_regionkey = place
        JOIN (SELECT number, max(effective_date) AS last_day FROM picked GROUP BY number)
            USING (number)""",
    "emp": """
        SELECT *, effective_date AS valid_from,
               coalesce((SELECT min(n.effective_date) FROM employees n
                         WHERE n.employee_id = e.employee_id
                           AND n.effective_date > e.effective_date), resign_date) AS valid_to,
               row_number() OVER (ORDER BY employee_id, effective_date) AS employee_key
        FROM employees e""",
    "asof_days": """
        SELECT employee_id, order_date AS day FROM sales
        UNION SELECT employee_id, return_date FROM returns
        UNION SELECT employee_id, CAST(date_trunc('month', order_date) AS DATE) FROM sales
        UNION SELECT employee_id,
                     CAST(date_trunc('month', order_date) + INTERVAL 1 MONTH AS DATE) FROM sales""",
    "in_force": """
        SELECT d.employee_id, d.day, e.employee_key, e.region
        FROM (SELECT d.employee_id, d.day, max(v.valid_from) AS started
              FROM asof_days d JOIN emp v
                ON v.employee_id = d.employee_id AND v.valid_from <= d.day
              GROUP BY d.employee_id, d.day) d
        JOIN emp e ON e.employee_id = d.employee_id AND e.valid_from = d.started
        WHERE e.valid_to IS NULL OR d.day < e.valid_to""",
    "targets": """
        SELECT employee_id, CAST(year(effective_from) AS VARCHAR) AS year,
               CAST(month(effective_from) AS VARCHAR) AS month, effective_from, target_revenue
        FROM (SELECT employee_id,
                     CAST(date_trunc('month', order_date) + INTERVAL 1 MONTH AS DATE)
                         AS effective_from,
                     floor(CAST(sum(CAST(gross_amount AS DECIMAL(18, 4))) AS DOUBLE))
                         AS target_revenue
              FROM sales WHERE employee_id IS NOT NULL GROUP BY 1, 2)""",
    "opened": """
        SELECT DISTINCT employee_id, customer_id, region, order_date AS effective_date
        FROM sales WHERE return_flag = 'N' AND employee_id IS NOT NULL""",
    "territories": """
        SELECT employee_id || '/' || customer_id || '/' || effective_date AS territory_id, *,
               (SELECT min(n.effective_date) FROM opened n
                WHERE n.employee_id = o.employee_id AND n.customer_id = o.customer_id
                  AND n.effective_date > o.effective_date) AS expiry_date
        FROM opened o""",
    "terr": """
        SELECT *, row_number() OVER (ORDER BY territory_id) AS territory_key FROM territories""",
    "promos": """
        SELECT DISTINCT 'PRO-' || p_type || '-' || (p_partkey // 500) AS promotion_id, p_type,
               p_partkey // 500 AS block,
               CASE WHEN p_type IN ('ECONOMY', 'LARGE', 'PROMO') THEN 'ALL' ELSE '1-URGENT' END
                   AS target_channel,
               CASE WHEN (p_partkey // 500) % 2 = 1 THEN 'ALL' ELSE r_name END AS target_region,
               CAST(DATE '1996-06-29' + CAST(180 * ((p_partkey // 500 + length(p_type)) % 8)
                   AS INTEGER) AS DATE) AS start_date,
               CAST(DATE '1996-06-29' + CAST(180 * ((p_partkey // 500 + length(p_type)) % 8) + 89
                   AS INTEGER) AS DATE) AS end_date,
               (p_partkey // 500) * 1000.0::DOUBLE + 1000.0::DOUBLE AS cost
        FROM part JOIN region ON r_regionkey = (p_partkey // 500) % 5""",
    "hits": """
        SELECT s.*, m.promotion_id, m.start_date, m.end_date
        FROM sales s
        LEFT JOIN part p ON s.product_id = 'PRD' || p.p_partkey
        JOIN promos m ON (m.block = 0 AND m.p_type IN ('LARGE', 'SMALL'))
                      OR (m.p_type = p.p_type AND m.block = p.p_partkey // 500)
        WHERE m.target_channel IN ('ALL', s.channel) AND m.target_region IN ('ALL', s.region)""",
    "uplift": """
        SELECT promotion_id, days, cost, inside / days AS in_avg, before / days AS before_avg
        FROM (SELECT m.promotion_id, m.cost, 90 AS days,
                     coalesce(CAST(sum(CAST(net_amount AS DECIMAL(18, 4))) FILTER (
                         h.order_date BETWEEN m.start_date AND m.end_date) AS DOUBLE), 0) AS inside,
                     coalesce(CAST(sum(CAST(net_amount AS DECIMAL(18, 4))) FILTER (
                         h.order_date BETWEEN m.start_date - 90 AND m.start_date - 1) AS DOUBLE), 0)
                         AS before
              FROM promos m LEFT JOIN hits h ON h.promotion_id = m.promotion_id
              GROUP BY m.promotion_id, m.cost)""",
    "run_log": """
        SELECT strftime(ts, '%Y-%m-%d') AS batch_id, 'SRC' || user_id AS source_name,
               CAST(floor(value) AS BIGINT) AS rows_loaded,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status
        FROM events""",
    "silver_log": """
        SELECT event_type AS source_name, strftime(ts, '%Y-%m-%d') AS run_date,
               count(*) AS row_count_in,
               count(*) FILTER (value < 1) AS null_count,
               count(*) FILTER (value > 20) AS dedup_count,
               count(*) FILTER (NOT (value < 1 OR value > 20)) AS row_count_out
        FROM events GROUP BY 1, 2""",
    "delivered": """
        SELECT CASE WHEN l_orderkey % 97 <> 0 THEN 'ORD' || l_orderkey END AS order_id,
               CASE WHEN l_orderkey % 89 <> 0 THEN order_date END AS order_date,
               customer_id, upper(region) AS region, upper(channel) AS channel, employee_id,
               product_id, l_quantity AS quantity, l_discount AS discount_pct,
               l_extendedprice AS gross_amount,
               CAST(format('{:.2f}', net_amount) AS DOUBLE) AS net_amount,
               CAST(NULL AS VARCHAR) AS payment_status, l_orderkey
        FROM lines,
             LATERAL (SELECT unnest(range(CASE WHEN l_orderkey % 50 = 0 THEN 2 ELSE 1 END)) AS n)""",
    "clean": """
        SELECT DISTINCT * EXCLUDE (l_orderkey, discount_pct),
               round(discount_pct, 2) AS discount_pct FROM delivered""",
    "facts": """
        SELECT s.*, coalesce(c.customer_key, -1) AS customer_key,
               coalesce(p.product_key, -1) AS product_key,
               CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key,
               coalesce(a.employee_key, -1) AS employee_key
        FROM sales s LEFT JOIN customers c USING (customer_id)
        LEFT JOIN products p USING (product_id)
        LEFT JOIN in_force a ON a.employee_id = s.employee_id AND a.day = s.order_date""",
    "mart": """
        SELECT region, year, month, actual_revenue, target_revenue,
               actual_revenue - target_revenue AS variance
        FROM (SELECT coalesce(a.region, 'Unknown') AS region, CAST(year(g.day) AS INTEGER) AS year,
                     CAST(month(g.day) AS INTEGER) AS month,
                     coalesce(CAST(sum(actual) AS DOUBLE), 0) AS actual_revenue,
                     coalesce(CAST(sum(target) AS DOUBLE), 0) AS target_revenue
              FROM (SELECT employee_id, CAST(date_trunc('month', order_date) AS DATE) AS day,
                           CAST(net_amount AS DECIMAL(18, 4)) AS actual, NULL AS target FROM sales
                    UNION ALL
                    SELECT employee_id, effective_from, NULL,
                           CAST(target_revenue AS DECIMAL(18, 4)) FROM targets) g
              LEFT JOIN in_force a ON a.employee_id = g.employee_id AND a.day = g.day
              GROUP BY 1, 2, 3)""",
}
# what each sub-query is built on
_NEEDS = {
    "sales": ["lines"],
    "returns": ["lines"],
    "employees": ["picked"],
    "emp": ["employees"],
    "asof_days": ["sales", "returns"],
    "in_force": ["asof_days", "emp"],
    "targets": ["sales"],
    "opened": ["sales"],
    "territories": ["opened"],
    "terr": ["territories"],
    "hits": ["sales", "promos"],
    "uplift": ["promos", "hits"],
    "delivered": ["lines"],
    "clean": ["delivered"],
    "facts": ["sales", "customers", "products", "in_force"],
    "mart": ["sales", "targets", "in_force"],
}


def _sql(select: str, *parts: str) -> str:
    """``select`` behind the sub-queries it names and those they are built on."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in parts:
        add(name)
    heads = [f"{name} AS ({dedent(_PARTS[name])}\n)" for name in order]
    return f"WITH {', '.join(heads)}\n{dedent(select).strip()}"


_DIM_CUSTOMERS = """
    SELECT customer_key, customer_id, c_name AS customer_name, c_mktsegment AS customer_type,
           'RETAIL' AS channel, n_name AS province, r_name AS region,
           CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS join_date,
           c_acctbal AS credit_limit, 'ACTIVE' AS status
    FROM customers
    UNION ALL
    SELECT -1, 'UNKNOWN', 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown', NULL, NULL,
           'Unknown'"""

_DIM_EMPLOYEES = """
    SELECT employee_key, employee_id, 'Employee ' || number AS full_name, 'F' AS gender,
           DATE '1990-01-01' AS join_date, 'SALES' AS position, region, 'TEAM' || place AS team,
           'mail' || number AS email, 'ACTIVE' AS status, version, effective_date, resign_date,
           CAST(NULL AS VARCHAR) AS transfer_note, valid_from, valid_to,
           valid_to IS NULL AS is_current
    FROM emp
    UNION ALL
    SELECT -1, 'UNKNOWN', 'Unknown', 'Unknown', NULL, 'Unknown', 'Unknown', 'Unknown', 'Unknown',
           'Unknown', 'Unknown', NULL, NULL, 'Unknown', NULL, NULL, false"""

_RETURNS_FACT = """
    SELECT r.*, coalesce(customer_key, -1) AS customer_key,
           coalesce(product_key, -1) AS product_key,
           CAST(strftime(return_date, '%Y%m%d') AS INTEGER) AS date_key,
           coalesce(employee_key, -1) AS employee_key,
           coalesce(territory_key, -1) AS territory_key
    FROM returns r LEFT JOIN customers c USING (customer_id)
    LEFT JOIN products p USING (product_id)
    LEFT JOIN in_force a ON a.employee_id = r.employee_id AND a.day = r.return_date
    LEFT JOIN terr t ON t.employee_id = r.employee_id AND t.customer_id = r.customer_id
        AND r.return_date >= t.effective_date
        AND (t.expiry_date IS NULL OR r.return_date < t.expiry_date)"""

_PROFILE = {
    "order_id": ("text", "order_id"),
    "order_date": ("date", "order_date"),
    "order_month": None,
    "order_quarter": None,
    "order_year": None,
    "customer_id": ("text", "customer_id"),
    "region": ("text", "region"),
    "province": None,
    "channel": ("text", "channel"),
    "employee_id": ("text", "employee_id"),
    "product_id": ("text", "product_id"),
    "product_category": None,
    "quantity": ("number", "quantity"),
    "unit_price": None,
    "discount_pct": ("number", "discount_pct"),
    "discount_amount": None,
    "gross_amount": ("number", "gross_amount"),
    "net_amount": ("number", "net_amount"),
    "delivery_status": None,
    "payment_method": None,
}


def _profile_sql() -> str:
    rows = []
    for name, known in _PROFILE.items():
        role = "number" if name in ("unit_price", "discount_amount") else "text"
        filled = parsed = "0"
        if known:
            role, column = known
            parsed = f"count({column})"
            filled = "count(*)" if role == "date" else parsed
        rows.append(
            f"SELECT '{name}' AS column_name, '{role}' AS role, true AS is_present,"
            f" count(*) AS row_count, {filled} AS filled_rows, {parsed} AS parseable_rows"
            " FROM delivered"
        )
    rows.append("SELECT 'payment_status', 'text', false, count(*), 0, 0 FROM delivered")
    return _sql(" UNION ALL ".join(rows), "delivered")


def _source_counts(names: dict[str, str]) -> str:
    """One row count per source code."""
    return " UNION ALL ".join(
        f"SELECT '{code}' AS code, ({count}) AS n" for code, count in names.items()
    )


# rows as delivered, per source
_DELIVERED_ROWS = {
    "SRC01": "SELECT count(*) FROM sales",
    "SRC02": "SELECT count(*) FROM targets",
    "SRC03": "SELECT count(*) + count(*) FILTER (c_custkey % 50 = 0) FROM customer",
    "SRC04": "SELECT count(*) + count(*) FILTER (p_partkey % 50 = 0) FROM part",
    "SRC05": "SELECT count(*) FROM supply",
    "SRC06": "SELECT count(*) + count(*) FILTER (s_suppkey % 10 = 0) FROM supplier",
    "SRC07": "SELECT count(*) FROM emp",
    "SRC08": "SELECT count(*) FROM terr",
    "SRC09": "SELECT count(*) FROM returns",
    "SRC10": "SELECT count(*) FROM promos",
}
# rows left after equal ones are merged; the feeds have no empty keys
_DISTINCT_ROWS = {
    **_DELIVERED_ROWS,
    "SRC01": """SELECT count(*) FROM (SELECT DISTINCT order_id, order_date, customer_id, region,
                channel, employee_id, product_id, quantity, discount_pct, gross_amount,
                format('{:,.2f}', net_amount) FROM sales)""",
    "SRC05": "SELECT count(*) FROM (SELECT DISTINCT * FROM supply)",
    "SRC09": "SELECT count(*) FROM (SELECT DISTINCT * FROM returns)",
}
_FILES = """
    SELECT * FROM (VALUES
        ('SRC01', 'SRC01_sales_transactions', 'csv'), ('SRC02', 'SRC02_sales_target_plan', 'xlsx'),
        ('SRC03', 'SRC03_customer_master', 'csv'), ('SRC04', 'SRC04_product_master', 'xlsx'),
        ('SRC05', 'SRC05_distributor_orders', 'xlsx'),
        ('SRC06', 'SRC06_distributor_master', 'csv'), ('SRC07', 'SRC07_employee_master', 'xlsx'),
        ('SRC08', 'SRC08_territory_mapping', 'xlsx'),
        ('SRC09', 'SRC09_return_transactions', 'csv'), ('SRC10', 'SRC10_promotion_program', 'xlsx')
    ) f(code, source_name, ext)"""
_ALL_FEEDS = ("sales", "targets", "supply", "emp", "terr", "returns", "promos")

ORACLE: dict[str, str] = {
    "scan_csv_strings": """
        SELECT 'ORD' || o_orderkey AS order_id,
               strftime(o_orderdate, '%Y-%m-%d') AS order_date,
               CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS amount,
               'say "' || o_orderpriority || '",' || chr(10) || 'then go' AS note
        FROM orders""",
    "scan_workbook_strings": """
        SELECT 'PRD' || p_partkey AS product_id, p_name AS product_name,
               CAST(p_size AS VARCHAR) AS size,
               CASE WHEN p_retailprice = floor(p_retailprice)
                    THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR)
                    ELSE CAST(p_retailprice AS VARCHAR) END AS price,
               strftime(DATE '1994-01-01' + p_size, '%Y-%m-%d') AS launched
        FROM part""",
    "idempotent_overwrite": """
        SELECT 'ORD' || o_orderkey AS order_id,
               strftime(o_orderdate, '%Y-%m-%d') AS order_date,
               CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS amount
        FROM orders""",
    "ingest_log_overwrite": _sql(
        """SELECT batch_id, status, count(*) AS sources,
                  CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded
           FROM run_log GROUP BY 1, 2""",
        "run_log",
    ),
    "silver_log_append": _sql(
        """SELECT source_name, 2 * count(*) AS records,
                  CASE WHEN source_name = 'error' THEN 2 * count(*) ELSE 0 END AS errors,
                  CAST(2 * sum(row_count_in) AS BIGINT) AS row_count_in
           FROM silver_log GROUP BY 1""",
        "silver_log",
    ),
    "landing_ingest": """
        SELECT 'CUS' || c_custkey AS customer_id,
               c_name || CASE WHEN n = 1 THEN ' (copy)' ELSE '' END AS customer_name,
               '09' || c_custkey AS phone,
               CASE WHEN lower(c_mktsegment) NOT LIKE '%building%' THEN 'gold' END AS loyalty, 'SRC03_customer_master.csv' AS _source_file,
               '2026-07-22' AS _run_date
        FROM customer,
             LATERAL (SELECT unnest(range(CASE WHEN c_custkey % 50 = 0 THEN 2 ELSE 1 END)) AS n)""",
    "run_history_latest": _sql(
        """SELECT source_name,
                  strftime(date_trunc('week', CAST(run_date AS DATE)), '%Y%m%d') AS run_day,
                  run_date, row_count_in, row_count_out
           FROM silver_log s
           WHERE date_trunc('week', CAST(run_date AS DATE)) =
                 (SELECT max(date_trunc('week', CAST(n.run_date AS DATE))) FROM silver_log n
                  WHERE n.source_name = s.source_name)""",
        "silver_log",
    ),
    "bronze_lineage": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
               'SRC03_customer_master.csv' AS _source_file, 'google_drive' AS _source_platform,
               '2026-07-22' AS _run_date, '2026-07-22T01:02:03.000000Z' AS _ingested_at,
               'batch-1' AS _batch_id
        FROM customer""",
    "bronze_cast_string": """
        SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey,
               CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_returnflag,
               strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate,
               CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR) AS l_extendedprice
        FROM lineitem""",
    "silver_money_cast": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END AS amount
        FROM orders""",
    "silver_date_cast": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 89 <> 0 AND o_orderkey % 83 <> 0
                                THEN CAST(o_orderdate AS DATE) END AS order_date
        FROM orders""",
    "silver_text_standardize": """
        SELECT c_custkey, upper(c_name) AS customer_name,
               c_mktsegment || ' MIỀN NAM' AS segment
        FROM customer""",
    "silver_fill_null": """
        SELECT 'CUS' || c_custkey AS customer_id,
               CASE WHEN c_custkey % 7 = 0 THEN 'UNKNOWN' ELSE 'TAX' || c_custkey END AS tax_code,
               'ACTIVE' AS status
        FROM customer,
             LATERAL (SELECT unnest(range(CASE WHEN c_custkey % 50 = 0 THEN 2 ELSE 1 END)) AS n)""",
    "log_source_name": """
        SELECT p_partkey, CASE WHEN p_size < 10 THEN '.' || p_type
                               WHEN p_size < 20 THEN p_name
                               ELSE p_name || '.' || p_brand END AS source_name
        FROM part""",
    "silver_drop_null_keys": """
        SELECT o_orderkey, o_custkey AS customer, o_orderpriority AS priority
        FROM orders WHERE o_custkey % 97 <> 0 AND o_orderkey % 89 <> 0""",
    "schema_contract_profile": _profile_sql(),
    "dq_date_null_ratio": """
        SELECT column_name, row_count, null_rows, newly_null_rows,
               CAST(null_rows AS DOUBLE) / row_count AS null_ratio,
               CASE WHEN CAST(null_rows AS DOUBLE) / row_count > 0.5 THEN 'warning' ELSE 'info' END
                   AS level
        FROM (SELECT 'order_date' AS column_name, count(*) AS row_count,
                     count(*) FILTER (l_orderkey % 89 = 0) AS null_rows,
                     count(*) FILTER (l_orderkey % 89 = 0) AS newly_null_rows FROM lineitem
              UNION ALL
              SELECT 'expected_delivery_date', count(*),
                     count(*) FILTER (l_orderkey % 97 = 0), 0 FROM lineitem
              UNION ALL
              SELECT 'actual_delivery_date', count(*), count(*) FILTER (l_orderkey % 3 <> 0),
                     count(*) FILTER (l_orderkey % 3 <> 0) FROM lineitem)""",
    "dq_grain_check": _sql(
        """SELECT order_id, product_id, count(*) AS row_count FROM sales
           GROUP BY 1, 2 HAVING count(*) > 1""",
        "sales",
    ),
    "dq_orphan_fk": _sql(
        """SELECT key_name, row_count, unknown_rows, null_rows,
                  CAST(unknown_rows AS DOUBLE) / row_count AS unknown_ratio
           FROM (SELECT 'customer_key' AS key_name, count(*) AS row_count,
                        count(*) FILTER (customer_key = -1) AS unknown_rows,
                        count(*) FILTER (customer_key IS NULL) AS null_rows FROM facts
                 UNION ALL
                 SELECT 'product_key', count(*), count(*) FILTER (product_key = -1),
                        count(*) FILTER (product_key IS NULL) FROM facts
                 UNION ALL
                 SELECT 'date_key', count(*), count(*) FILTER (date_key = -1),
                        count(*) FILTER (date_key IS NULL) FROM facts
                 UNION ALL
                 SELECT 'employee_key', count(*), count(*) FILTER (employee_key = -1),
                        count(*) FILTER (employee_key IS NULL) FROM facts)""",
        "facts",
    ),
    "fact_lookup_unknown": _sql(
        """SELECT order_id, line_no, customer_id, product_id,
                  coalesce(customer_key, -1) AS customer_key,
                  coalesce(product_key, -1) AS product_key
           FROM sales LEFT JOIN customers USING (customer_id)
           LEFT JOIN products USING (product_id)""",
        "sales", "customers", "products",
    ),
    "fact_date_key": _sql(
        """SELECT return_id, return_date, return_amount,
                  CASE WHEN return_date BETWEEN (SELECT min(order_date) FROM sales)
                                            AND (SELECT max(order_date) FROM sales)
                       THEN CAST(strftime(return_date, '%Y%m%d') AS INTEGER) END AS date_key
           FROM returns""",
        "sales", "returns",
    ),
    "asof_employee_key": (
        asof := _sql(
            "SELECT order_id, line_no, employee_id, order_date, employee_key FROM facts", "facts"
        )
    ),
    "asof_window_variant": asof,
    "asof_territory_key": _sql(
        """SELECT order_id, line_no, s.employee_id, s.customer_id, order_date,
                  coalesce(territory_key, -1) AS territory_key
           FROM sales s LEFT JOIN terr t
             ON t.employee_id = s.employee_id AND t.customer_id = s.customer_id
            AND s.order_date >= t.effective_date
            AND (t.expiry_date IS NULL OR s.order_date < t.expiry_date)""",
        "sales", "terr",
    ),
    "promo_bridge": _sql(
        """SELECT order_id, line_no, product_id, order_date, channel, region, net_amount,
                  promotion_id
           FROM hits WHERE order_date BETWEEN start_date AND end_date""",
        "hits",
    ),
    "silver_dedup_full_row": """
        SELECT DISTINCT l_orderkey, l_partkey, l_linenumber, l_returnflag, l_quantity
        FROM lineitem""",
    "dedup_keep_first": "SELECT 'PRD' || p_partkey AS product_id, p_name AS product_name FROM part",
    "silver_stats": _sql(
        """SELECT (SELECT count(*) FROM delivered) AS row_count_in,
                  count(order_id) AS row_count_out,
                  (SELECT count(*) FROM delivered) - count(*) AS dedup_count,
                  count(*) - count(order_id) AS null_count
           FROM clean""",
        "clean",
    ),
    "silver_transform": _sql(
        """SELECT order_id, order_date, customer_id, region, channel, employee_id, product_id,
                  quantity, gross_amount, net_amount, payment_status
           FROM clean WHERE order_id IS NOT NULL""",
        "clean",
    ),
    "surrogate_key_dense": """
        SELECT row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_custkey, o_orderkey)
                   AS order_key,
               o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate
        FROM orders""",
    "unknown_member": """
        SELECT s_suppkey + 1 AS supplier_key, s_name AS supplier_id, 'mail' || s_suppkey AS email,
               s_acctbal AS balance, true AS is_current FROM supplier
        UNION ALL SELECT -1, 'UNKNOWN', 'Unknown', NULL, false""",
    "scd2_valid_dates": _sql(
        "SELECT employee_id, version, resign_date, valid_from, valid_to FROM emp", "emp"
    ),
    "scd2_is_current": _sql(
        "SELECT employee_id, valid_from, valid_to IS NULL AS is_current FROM emp", "emp"
    ),
    "dim_customers": _sql(_DIM_CUSTOMERS, "customers"),
    "dim_products": _sql(
        """SELECT product_key, product_id, p_name AS product_name, p_type AS category,
                  p_brand AS sub_category, 'BOX' AS unit, p_retailprice AS unit_price,
                  p_retailprice * 0.5::DOUBLE AS cost_price, p_size * 10.0::DOUBLE AS weight_gram,
                  'ACTIVE' AS status, CAST(DATE '1994-01-01' + p_size AS DATE) AS launch_date
           FROM products
           UNION ALL
           SELECT -1, 'UNKNOWN', 'Unknown', 'Unknown', 'Unknown', 'Unknown', NULL, NULL, NULL,
                  'Unknown', NULL""",
        "products",
    ),
    "dim_distributors": _sql(
        """SELECT distributor_key, distributor_id, s_name AS distributor_name, 'GOLD' AS tier,
                  'RETAIL' AS channel, n_name AS province, r_name AS region,
                  'Person ' || s_suppkey AS contact_person, 'mail' || s_suppkey AS email,
                  DATE '1994-01-01' AS join_date, s_acctbal AS credit_limit, 'ACTIVE' AS status,
                  'EMP1' AS assigned_supervisor_id
           FROM distributors
           UNION ALL
           SELECT -1, 'UNKNOWN', 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown',
                  'Unknown', NULL, NULL, 'Unknown', 'Unknown'""",
        "distributors",
    ),
    "dim_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
               CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day
        FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d
              FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))""",
    "dim_employees": _sql(_DIM_EMPLOYEES, "emp"),
    "dim_territory": _sql(
        """SELECT territory_key, territory_id, employee_id, customer_id, region, 'TEAM1' AS team,
                  effective_date, expiry_date, '1' AS version FROM terr
           UNION ALL
           SELECT -1, 'UNKNOWN', 'Unknown', 'Unknown', 'Unknown', 'Unknown', NULL, NULL,
                  'Unknown'""",
        "terr",
    ),
    "dim_promotion": _sql(
        """SELECT row_number() OVER (ORDER BY promotion_id) AS promotion_key, promotion_id,
                  'DISCOUNT' AS promotion_type, target_region, start_date, end_date,
                  cost AS actual_cost_vnd,
                  CASE WHEN block = 0 AND p_type = 'LARGE' THEN 'ALL'
                       WHEN block = 0 AND p_type = 'SMALL' THEN NULL
                       ELSE (SELECT string_agg('PRD' || p_partkey, ', ' ORDER BY 'PRD' || p_partkey)
                   FROM part p WHERE p.p_type = m.p_type AND p.p_partkey // 500 = m.block)
                  END AS applicable_products
           FROM promos m
           UNION ALL
           SELECT -1, 'UNKNOWN', 'Unknown', 'Unknown', NULL, NULL, NULL, 'Unknown'""",
        "promos",
    ),
    "fact_sales": _sql("SELECT * FROM facts", "facts"),
    "fact_sales_territory": _sql(
        """SELECT f.*, coalesce(territory_key, -1) AS territory_key
           FROM facts f LEFT JOIN terr t
             ON t.employee_id = f.employee_id AND t.customer_id = f.customer_id
            AND f.order_date >= t.effective_date
            AND (t.expiry_date IS NULL OR f.order_date < t.expiry_date)""",
        "facts", "terr",
    ),
    "fact_targets": _sql(
        """SELECT t.employee_id, year, month, target_revenue,
                  coalesce(employee_key, -1) AS employee_key
           FROM targets t LEFT JOIN in_force a
             ON a.employee_id = t.employee_id AND a.day = t.effective_from""",
        "targets", "in_force",
    ),
    "fact_returns": _sql(_RETURNS_FACT, "returns", "customers", "products", "in_force", "terr"),
    "fact_distributor_orders": _sql(
        """SELECT s.*, coalesce(product_key, -1) AS product_key,
                  CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key,
                  coalesce(distributor_key, -1) AS distributor_key
           FROM supply s LEFT JOIN products USING (product_id)
           LEFT JOIN distributors USING (distributor_id)""",
        "supply", "products", "distributors",
    ),
    "mart_sales_vs_target": _sql(
        """SELECT region, year, month, actual_revenue, target_revenue, variance,
                  CASE WHEN target_revenue <> 0
                       THEN round(100 * variance / target_revenue, 6) END AS variance_pct
           FROM mart""",
        "mart",
    ),
    "kpi_achievement": _sql(
        """SELECT region, year, month,
                  CASE WHEN target_revenue <> 0
                       THEN round(actual_revenue / target_revenue, 6) END AS achievement_rate
           FROM mart""",
        "mart",
    ),
    "kpi_worst_region": _sql(
        """SELECT year, month, region, actual_revenue, target_revenue, variance
           FROM (SELECT *, row_number() OVER (PARTITION BY year, month
                                              ORDER BY abs(variance) DESC, region) AS place
                 FROM mart) WHERE place = 1""",
        "mart",
    ),
    "kpi_revenue": _sql(
        """SELECT CAST(year(order_date) AS INTEGER) AS year,
                  CAST(month(order_date) AS INTEGER) AS month, region, channel,
                  CAST(sum(CAST(net_amount AS DECIMAL(18, 4))) AS DOUBLE) AS revenue
           FROM sales GROUP BY 1, 2, 3, 4""",
        "sales",
    ),
    "kpi_top5": _sql(
        """SELECT region, channel, CAST(sum(CAST(net_amount AS DECIMAL(18, 4))) AS DOUBLE) AS revenue
           FROM sales GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 5""",
        "sales",
    ),
    "kpi_growth": _sql(
        """, monthly AS (
               SELECT region, channel, CAST(date_trunc('month', order_date) AS DATE) AS month_start,
                      CAST(sum(CAST(net_amount AS DECIMAL(18, 4))) AS DOUBLE) AS revenue
               FROM sales GROUP BY 1, 2, 3),
           dense AS (
               SELECT c.region, c.channel, c.month_start, coalesce(revenue, 0) AS revenue
               FROM (SELECT region, channel,
                            CAST(unnest(generate_series(min(month_start), max(month_start),
                                                        INTERVAL 1 MONTH)) AS DATE) AS month_start
                     FROM monthly GROUP BY 1, 2) c
               LEFT JOIN monthly USING (region, channel, month_start))
           SELECT d.region, d.channel, d.month_start, d.revenue,
                  CASE WHEN m.revenue <> 0
                       THEN round((d.revenue - m.revenue) / m.revenue, 6) END AS mom_growth,
                  CASE WHEN y.revenue <> 0
                       THEN round((d.revenue - y.revenue) / y.revenue, 6) END AS yoy_growth
           FROM dense d
           LEFT JOIN dense m ON m.region = d.region AND m.channel = d.channel
                AND m.month_start = d.month_start - INTERVAL 1 MONTH
           LEFT JOIN dense y ON y.region = d.region AND y.channel = d.channel
                AND y.month_start = d.month_start - INTERVAL 1 YEAR""",
        "sales",
    ),
    "kpi_promo_sales": _sql(
        """SELECT m.promotion_id,
                  coalesce(CAST(sum(CAST(net_amount AS DECIMAL(18, 4))) FILTER (
                      order_date BETWEEN m.start_date AND m.end_date) AS DOUBLE), 0)
                      AS in_period_revenue,
                  coalesce(CAST(sum(CAST(net_amount AS DECIMAL(18, 4))) FILTER (
                      order_date NOT BETWEEN m.start_date AND m.end_date) AS DOUBLE), 0)
                      AS out_of_period_revenue
           FROM promos m LEFT JOIN hits h ON h.promotion_id = m.promotion_id
           GROUP BY m.promotion_id""",
        "hits",
    ),
    "kpi_promo_uplift": _sql(
        """SELECT promotion_id, round(in_avg, 4) AS in_period_daily_revenue,
                  round(before_avg, 4) AS before_period_daily_revenue,
                  round(in_avg - before_avg, 4) AS daily_uplift
           FROM uplift""",
        "uplift",
    ),
    "kpi_promo_roi": _sql(
        """SELECT promotion_id, round((in_avg - before_avg) * days, 4) AS uplift_revenue,
                  round(((in_avg - before_avg) * days - cost) / cost, 4) AS roi
           FROM uplift""",
        "uplift",
    ),
    "kpi_fill_rate": _sql(
        """SELECT distributor_id, round(avg(qty_delivered / qty_ordered), 6) AS fill_rate
           FROM supply GROUP BY 1""",
        "supply",
    ),
    "kpi_ontime": """
        SELECT 'DIS' || l_suppkey AS distributor_id,
               round(CAST(count(*) FILTER (l_linestatus = 'F') AS DOUBLE) / count(*), 6)
                   AS on_time_rate
        FROM lineitem GROUP BY 1""",
    "kpi_return_rate": _sql(
        """SELECT region, return_amount, gross_amount,
                  round(return_amount / gross_amount, 6) AS return_rate
           FROM (SELECT region,
                        CAST(sum(CAST(gross_amount AS DECIMAL(18, 4))) AS DOUBLE) AS gross_amount
                 FROM sales GROUP BY 1)
           LEFT JOIN (SELECT region,
                             CAST(sum(CAST(return_amount AS DECIMAL(18, 4))) AS DOUBLE)
                                 AS return_amount
                      FROM returns GROUP BY 1) USING (region)""",
        "sales", "returns",
    ),
    "kpi_sales_by_hist_region": _sql(
        """SELECT coalesce(a.employee_id, 'UNKNOWN') AS employee_id,
                  coalesce(a.region, 'Unknown') AS region,
                  CAST(sum(CAST(net_amount AS DECIMAL(18, 4))) AS DOUBLE) AS revenue,
                  count(*) AS order_lines
           FROM sales s LEFT JOIN in_force a
             ON a.employee_id = s.employee_id AND a.day = s.order_date
           GROUP BY 1, 2""",
        "sales", "in_force",
    ),
    "kpi_run_success": _sql(
        """SELECT batch_id, count(*) AS sources, count(*) FILTER (status = 'success') AS succeeded,
                  round(avg(CASE WHEN status = 'success' THEN 1.0 ELSE 0.0 END), 6) AS success_rate,
                  CASE WHEN bool_and(status = 'success') THEN 'OK' ELSE 'FAILED' END AS outcome
           FROM run_log GROUP BY 1""",
        "run_log",
    ),
    "kpi_rows_lost": """
        SELECT event_type AS source_name, count(*) AS row_count_in,
               count(*) FILTER (value >= 1 AND value <= 20) AS row_count_out,
               count(*) FILTER (value > 20) AS dedup_count,
               count(*) FILTER (value < 1) AS null_count,
               count(*) FILTER (value < 1 OR value > 20) AS rows_lost
        FROM events GROUP BY 1""",
    "bronze_job": _sql(
        f"""SELECT 'batch-1' AS batch_id, source_name, source_name || '.' || ext AS source_file,
                   'google_drive' AS source_platform,
                   CASE WHEN code IN ('SRC08', 'SRC10') THEN 0 ELSE n END AS rows_loaded,
                   CASE code WHEN 'SRC08' THEN 'failed' WHEN 'SRC10' THEN 'schema_mismatch'
                             ELSE 'success' END AS status
            FROM ({_FILES}) JOIN ({_source_counts(_DELIVERED_ROWS)}) USING (code)""",
        *_ALL_FEEDS,
    ),
    "silver_job": _sql(
        f"""SELECT source_name, '2026-07-22' AS run_date, d.n AS row_count_in,
                   CASE WHEN code = 'SRC04' THEN 0 ELSE u.n END AS row_count_out,
                   0 AS null_count,
                   CASE WHEN code = 'SRC04' THEN 0 ELSE d.n - u.n END AS dedup_count,
                   CASE WHEN code = 'SRC04' THEN 'failed' ELSE 'success' END AS status,
                   code = 'SRC04' AS has_error
            FROM ({_FILES}) JOIN ({_source_counts(_DELIVERED_ROWS)}) d USING (code)
            JOIN ({_source_counts(_DISTINCT_ROWS)}) u USING (code)""",
        *_ALL_FEEDS,
    ),
    "silver_read_back": """
        SELECT 'CUS' || c_custkey AS customer_id,
               c_name || CASE WHEN n = 1 THEN ' (copy)' ELSE '' END AS customer_name,
               CASE WHEN c_custkey % 7 <> 0 THEN 'TAX' || c_custkey ELSE 'UNKNOWN' END AS tax_code,
               CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS join_date,
               c_acctbal AS credit_limit, 'SRC03_customer_master.csv' AS _source_file,
               'batch-1' AS _batch_id
        FROM customer,
             LATERAL (SELECT unnest(range(CASE WHEN c_custkey % 50 = 0 THEN 2 ELSE 1 END)) AS n)
        WHERE c_custkey <> 1""",
    "gold_read_back": _sql("SELECT * FROM facts", "facts"),
    "gold_job": _sql(
        """SELECT 'dim_customers' AS table_name, count(*) + 1 AS row_count FROM customer
           UNION ALL SELECT 'dim_products', count(*) + 1 FROM part
           UNION ALL SELECT 'dim_distributors', count(*) + 1 FROM supplier
           UNION ALL SELECT 'dim_employees', count(*) + 1 FROM emp
           UNION ALL SELECT 'dim_territory', count(*) + 1 FROM terr
           UNION ALL SELECT 'dim_promotion', count(*) + 1 FROM promos
           UNION ALL SELECT 'dim_date', max(order_date) - min(order_date) + 1 FROM sales
           UNION ALL SELECT 'fact_sales', count(*) FROM sales
           UNION ALL SELECT 'fact_targets', count(*) FROM targets
           UNION ALL SELECT 'fact_returns', count(*) FROM returns
           UNION ALL SELECT 'fact_distributor_orders', count(*) FROM supply
           UNION ALL SELECT 'bridge_sales_promotion', count(*) FROM hits
                     WHERE order_date BETWEEN start_date AND end_date
           UNION ALL SELECT 'mart_sales_vs_target', count(*) FROM mart""",
        *_ALL_FEEDS, "hits", "mart",
    ),
}
ORACLE = {name: dedent(sql).strip() for name, sql in ORACLE.items()}
