import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from crateflow.operators import facts, marts, promotions, quality
from crateflow.session import stored


@pytest.fixture
def star(spark):
    employees = spark.createDataFrame(
        [
            (-1, "UNKNOWN", "Unknown", None, None),
            (1, "EMP001", "NORTH", date(2024, 1, 1), date(2024, 6, 1)),
            (2, "EMP001", "SOUTH", date(2024, 6, 1), None),
        ],
        "employee_key long, employee_id string, region string, valid_from date, valid_to date",
    )
    return {
        "customers": spark.createDataFrame([(-1, "UNKNOWN"), (5, "C1")], "customer_key long, customer_id string"),
        "products": spark.createDataFrame([(-1, "UNKNOWN"), (7, "P1")], "product_key long, product_id string"),
        "employees": employees,
        "dates": spark.createDataFrame(
            [(20240201, date(2024, 2, 1)), (20240701, date(2024, 7, 1))], "date_key int, full_date date"
        ),
    }


SALES = (
    "order_id string, customer_id string, product_id string, employee_id string, order_date date,"
    " net_amount double, gross_amount double, region string, channel string, _batch_id string"
)


def sales(spark, *rows):
    return spark.createDataFrame(rows, SALES)


def test_fact_sales(spark, star):
    df = sales(
        spark,
        ("O1", "C1", "P1", "EMP001", date(2024, 2, 1), 1.0, 2.0, "N", "R", "b"),
        ("O2", "C9", "P9", "EMP999", date(2024, 7, 1), 1.0, 2.0, "N", "R", "b"),
        ("O3", None, "P1", None, None, 1.0, 2.0, "N", "R", "b"),
        ("O4", "C1", "P1", "EMP001", date(2024, 7, 1), 1.0, 2.0, "N", "R", "b"),
    )
    out = facts.build_fact_sales(df, star["customers"], star["products"], star["employees"], star["dates"])
    assert out.columns == [*df.columns, "customer_key", "product_key", "date_key", "employee_key"]
    got = {r["order_id"]: tuple(r)[-4:] for r in out.collect()}
    assert got == {
        "O1": (5, 7, 20240201, 1), "O2": (-1, -1, 20240701, -1), "O3": (-1, 7, None, -1), "O4": (5, 7, 20240701, 2),
    }


def test_large_dimensions_give_the_same_keys(spark, star, monkeypatch):
    df = sales(
        spark,
        *[(f"O{i}", "C1" if i % 3 else "C9", "P1", "EMP001", date(2024, 2, 1), 1.0, 2.0, "N", "R", "b") for i in range(300)],
    )
    dims = (star["customers"], star["products"], star["employees"], star["dates"])
    small = sorted(facts.build_fact_sales(df, *dims).collect())
    monkeypatch.setattr("crateflow.plans.sizing.BROADCAST_ROWS", 0)
    assert sorted(facts.build_fact_sales(df, *dims).collect()) == small


def test_wide_facts_are_not_sorted_for_a_large_dimension(spark, star, monkeypatch):
    df = sales(spark, ("O1", "C1", "P1", "EMP001", date(2024, 2, 1), 1.0, 2.0, "N", "R", "b"))
    monkeypatch.setattr("crateflow.plans.sizing.BROADCAST_ROWS", 0)
    out = facts.build_fact_sales(df, star["customers"], star["products"], star["employees"], star["dates"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_fact_targets(spark, star):
    rows = [("EMP001", "2024", "2", 1.0), ("EMP001", "2024", "7.0", 1.0), ("EMP999", "2024", "3", 1.0), ("EMP001", "2024", "13", 1.0)]
    df = spark.createDataFrame(rows, "employee_id string, year string, month string, target_revenue double")
    out = facts.build_fact_targets(df, star["employees"])
    assert out.columns == [*df.columns, "employee_key"]
    assert {(r["employee_id"], r["month"]): r["employee_key"] for r in out.collect()} == {
        ("EMP001", "2"): 1, ("EMP001", "7.0"): 2, ("EMP999", "3"): -1, ("EMP001", "13"): -1,
    }


TERRITORIES = (
    "territory_key long, territory_id string, employee_id string, customer_id string,"
    " effective_date date, expiry_date date"
)


def test_fact_returns_and_territory(spark, star):
    territories = spark.createDataFrame(
        [
            (-1, "UNKNOWN", "Unknown", "Unknown", None, None),
            (1, "T1", "EMP001", "C1", date(2024, 1, 1), date(2024, 3, 1)),
            (2, "T2", "EMP001", "C1", date(2024, 2, 1), None),
            (3, "T3", "EMP001", "C2", date(2024, 1, 1), None),
        ],
        TERRITORIES,
    )
    df = spark.createDataFrame(
        [("R1", "C1", "P1", "EMP001", date(2024, 2, 1), 3.0), ("R2", "C1", "P1", "EMP001", date(2023, 2, 1), 3.0)],
        "return_id string, customer_id string, product_id string, employee_id string, return_date date, return_amount double",
    )
    out = facts.build_fact_returns(df, star["customers"], star["products"], star["employees"], star["dates"], territories)
    assert {r["return_id"]: tuple(r)[-5:] for r in out.collect()} == {
        "R1": (5, 7, 20240201, 1, 2), "R2": (5, 7, None, -1, -1),
    }


def test_fact_distributor_orders(spark, star):
    distributors = spark.createDataFrame([(4, "D1")], "distributor_key long, distributor_id string")
    df = spark.createDataFrame(
        [("O1", "D1", "P1", date(2024, 2, 1)), ("O2", "D2", "P2", date(2025, 1, 1))],
        "order_id string, distributor_id string, product_id string, order_date date",
    )
    out = facts.build_fact_distributor_orders(df, star["products"], star["dates"], distributors)
    assert {r["order_id"]: tuple(r)[-3:] for r in out.collect()} == {"O1": (7, 20240201, 4), "O2": (-1, None, -1)}


PROMOTIONS = (
    "promotion_id string, applicable_products string, target_channel string, target_region string,"
    " start_date date, end_date date, actual_cost_vnd double"
)


@pytest.fixture
def offers(spark):
    return spark.createDataFrame(
        [
            ("A", "P1, P2", "ALL", None, date(2024, 1, 11), date(2024, 1, 20), 10.0),
            ("B", "P1", "R", "N", date(2024, 1, 15), date(2024, 1, 16), 0.0),
            ("C", "P9", "ALL", "ALL", date(2024, 1, 1), date(2024, 1, 2), 5.0),
            # no list and ALL mean every product, also one that no list names
            ("D", None, "ALL", "ALL", date(2024, 1, 15), date(2024, 1, 15), None),
            ("E", "all", "R", "S", date(2024, 1, 1), date(2024, 3, 2), 1.0),
        ],
        PROMOTIONS,
    )


@pytest.fixture
def january(spark):
    def line(order, product, day, amount, region="N", channel="R"):
        return (order, "C1", product, "E", day, amount, amount, region, channel, "b")

    return sales(
        spark,
        line("before", "P1", date(2024, 1, 10), 40.0), line("first", "P1", date(2024, 1, 11), 100.0),
        line("both", "P1", date(2024, 1, 15), 7.0), line("other region", "P1", date(2024, 1, 15), 3.0, "S"),
        line("other channel", "P1", date(2024, 1, 15), 2.0, "N", "W"), line("last", "P2", date(2024, 1, 20), 5.0),
        line("after", "P2", date(2024, 1, 21), 1.0), line("too early", "P2", date(2023, 12, 31), 1000.0),
        line("no promotion", "P3", date(2024, 1, 15), 9.0),
    )


def test_promotion_bridge(spark, january, offers):
    out = promotions.promotion_bridge(january, offers, ["order_id"])
    assert sorted((r["promotion_id"], r["order_id"]) for r in out.collect()) == [
        ("A", "both"), ("A", "first"), ("A", "last"), ("A", "other channel"), ("A", "other region"), ("B", "both"),
        ("D", "both"), ("D", "no promotion"), ("D", "other channel"), ("D", "other region"), ("E", "other region"),
    ]


def test_promotion_sales(january, offers):
    out = {r[0]: tuple(r)[1:] for r in promotions.promotion_sales(january, offers).collect()}
    assert out == {"A": (117.0, 1041.0), "B": (7.0, 140.0), "C": (0.0, 0.0), "D": (21.0, 1146.0), "E": (3.0, 0.0)}


def test_promotion_uplift(january, offers):
    out = {r["promotion_id"]: r for r in promotions.promotion_uplift(january, offers).collect()}
    a = out["A"]
    assert (a["days"], a["in_period_daily_revenue"], a["before_period_daily_revenue"]) == (10, 11.7, 4.0)
    assert a["uplift_revenue"] == pytest.approx(77.0) and a["roi"] == pytest.approx(6.7)
    assert out["B"]["roi"] is None and out["B"]["before_period_daily_revenue"] == 0.0
    assert out["C"]["uplift_revenue"] == 0.0 and out["C"]["roi"] == -1.0
    assert out["D"]["in_period_daily_revenue"] == 21.0 and out["D"]["roi"] is None
    assert out["E"]["uplift_revenue"] == pytest.approx(3.0)


def test_mart(spark, star):
    df = sales(
        spark,
        ("O1", "C1", "P1", "EMP001", date(2024, 5, 20), 30.0, 0.0, "N", "R", "b"),
        ("O2", "C1", "P1", "EMP001", date(2024, 6, 20), 50.0, 0.0, "N", "R", "b"),
        ("O3", "C1", "P1", None, date(2024, 6, 21), 5.0, 0.0, "N", "R", "b"),
    )
    targets = spark.createDataFrame(
        [("EMP001", "2024", "5", 60.0), ("EMP001", "2024", "7", 80.0), ("EMP009", "2024", "6", 0.0)],
        "employee_id string, year string, month string, target_revenue double",
    )
    mart = marts.sales_vs_target(df, targets, star["employees"])
    got = {(r["region"], r["month"]): (r["actual_revenue"], r["target_revenue"], r["variance_pct"]) for r in mart.collect()}
    assert got == {
        ("NORTH", 5): (30.0, 60.0, -50.0), ("SOUTH", 6): (50.0, 0.0, None),
        ("SOUTH", 7): (0.0, 80.0, -100.0), ("Unknown", 6): (5.0, 0.0, None),
    }
    worst = {r["month"]: r["region"] for r in marts.furthest_from_target(mart).collect()}
    assert worst == {5: "NORTH", 6: "SOUTH", 7: "SOUTH"}


def test_growth_fills_empty_months(spark):
    def line(day, amount):
        return ("o", "c", "p", "e", day, amount, amount, "N", "R", "b")

    df = sales(spark, line(date(2023, 1, 5), 10.0), line(date(2023, 3, 5), 5.0), line(date(2024, 1, 9), 30.0), line(None, 99.0))
    out = {r["month_start"]: r for r in marts.growth(df, ["region"]).collect()}
    assert len(out) == 13
    assert out[date(2023, 2, 1)]["revenue"] == 0.0 and out[date(2023, 2, 1)]["mom_growth"] == -1.0
    assert out[date(2023, 3, 1)]["mom_growth"] is None
    assert out[date(2024, 1, 1)]["yoy_growth"] == 2.0 and out[date(2024, 1, 1)]["mom_growth"] is None


def test_rates(spark):
    orders = spark.createDataFrame(
        [("D", 10.0, 5.0, " True "), ("D", 10.0, 10.0, "false"), ("D", 0.0, 0.0, None), ("D", 100.0, 100.0, "TRUE")],
        "distributor_id string, qty_ordered double, qty_delivered double, ontime_delivery string",
    )
    # mean of ratios, not ratio of sums
    assert marts.fill_rate(orders, ["distributor_id"]).first()["fill_rate"] == pytest.approx(2.5 / 3)
    assert marts.on_time_rate(orders, ["distributor_id"]).first()["on_time_rate"] == 0.5
    returns = spark.createDataFrame([("N", 3.0), ("N", 1.0), ("S", 1.0)], "region string, return_amount double")
    sold = spark.createDataFrame([("N", 10.0), ("N", 6.0)], "region string, gross_amount double")
    got = {r["region"]: r["return_rate"] for r in marts.return_rate(returns, sold, ["region"]).collect()}
    assert got == {"N": 0.25, "S": None}


def test_top_groups_break_ties_by_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 3.0)], "region string, net_amount double")
    assert [r[0] for r in marts.top_groups(df, ["region"], 2).collect()] == ["c", "a"]


def test_sales_by_historical_region(spark, star):
    df = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 4.0), (-1, 1.0)], "employee_key long, net_amount double")
    out = marts.sales_by_historical_region(df, star["employees"])
    assert sorted(map(tuple, out.collect())) == [
        ("EMP001", "NORTH", 5.0, 2), ("EMP001", "SOUTH", 4.0, 1), ("UNKNOWN", "Unknown", 1.0, 1),
    ]


def test_money_sum_does_not_depend_on_order(spark):
    values = [0.1, 1e9, -0.3, 7.7777, 1e-3] * 40
    one = spark.createDataFrame([(v,) for v in values], "net_amount double")
    other = one.repartition(7).orderBy(F.rand(3))
    assert marts.revenue(one, []).first() == marts.revenue(other, []).first()


def test_log_figures(spark):
    log = spark.createDataFrame([("b1", "success"), ("b1", "failed"), ("b2", "success")], "batch_id string, status string")
    got = {r["batch_id"]: tuple(r)[1:] for r in quality.run_success(log).collect()}
    assert got == {"b1": (2, 1, 0.5, "FAILED"), "b2": (1, 1, 1.0, "OK")}
    counts = spark.createDataFrame(
        [("s", 10, 7, 2, 1), ("s", 5, 5, 0, 0)],
        "source_name string, row_count_in long, row_count_out long, dedup_count long, null_count long",
    )
    assert quality.rows_lost(counts).first()["rows_lost"] == 3


def test_territory_on_sales(spark, star):
    df = sales(
        spark,
        ("O1", "C1", "P1", "EMP001", date(2024, 2, 1), 1.0, 2.0, "N", "R", "b"),
        ("O2", "C1", "P1", "EMP001", date(2024, 7, 1), 1.0, 2.0, "N", "R", "b"),
        ("O3", "C2", "P1", "EMP001", date(2024, 2, 1), 1.0, 2.0, "N", "R", "b"),
        ("O4", "C1", "P1", None, None, 1.0, 2.0, "N", "R", "b"),
    )
    terms = "territory_key long, employee_id string, customer_id string, effective_date date, expiry_date date"
    rows = [(-1, None, "UNKNOWN", None, None), (4, "EMP001", "C1", date(2024, 1, 1), date(2024, 6, 1))]
    territories = spark.createDataFrame(rows, terms)
    out = facts.build_fact_sales(
        df, star["customers"], star["products"], star["employees"], star["dates"], territories
    )
    assert out.columns[-2:] == ["employee_key", "territory_key"]
    assert {r["order_id"]: r["territory_key"] for r in out.collect()} == {"O1": 4, "O2": -1, "O3": -1, "O4": -1}


def rule_days(spark, *periods):
    rows = [(str(n), "P", *period) for n, period in enumerate(periods)]
    return spark.createDataFrame(rows, "promotion_id string, product_id string, start_date date, end_date date")


def test_blocks_cover_a_period_once(spark):
    rng = random.Random(5)
    def some_day(top):
        return date(1995, 1, 1) + timedelta(rng.randrange(top))

    spans = [sorted([some_day(top), some_day(top)]) for top in (40, 400, 4000, 40_000) for _ in range(12)]
    spans += [[date(1, 1, 1), date(9999, 12, 31)], [date(2024, 5, 5), date(2024, 5, 5)]]
    cover = promotions._cover(rule_days(spark, *spans), F.col("start_date")).collect()
    for n, (first, last) in enumerate(spans):
        blocks = {(r["_level"], r["_block"]) for r in cover if r["promotion_id"] == str(n)}
        days = [first, last, *[first + timedelta(rng.randrange((last - first).days + 1)) for _ in range(40)]]
        for day in days:
            own = [(k, (day - date(1970, 1, 1)).days // (32 * 8**k)) for k in range(7)]
            assert sum(block in blocks for block in own) == 1
        reach = sum(32 * 8**k for k, _ in blocks)
        assert (last - first).days < reach <= (last - first).days + 63


def test_rules_without_an_end_are_some_tens_of_rows(spark):
    rules = rule_days(
        spark, (date(2024, 1, 15), date(9999, 12, 31)), (date(2024, 3, 1), date(2024, 2, 1)),
        (None, date(2024, 1, 1)), (date(2024, 1, 1), None),
    )
    cover = promotions._cover(rules, F.col("start_date"))
    assert cover.select("promotion_id").distinct().collect() == [("0",)]
    assert cover.count() <= 60


def test_bridge_equals_the_rule_line_by_line(spark):
    rng = random.Random(3)
    def some_day(top=900):
        return date(2023, 1, 1) + timedelta(rng.randrange(top))

    places = [("N", "R"), ("S", "R"), ("N", "W")]
    lines = [
        (f"O{i}", "C", f"P{rng.randrange(4)}", "E", rng.choice([None] + [some_day()] * 20), 1.0, 1.0, *rng.choice(places), "b")
        for i in range(200)
    ]
    rules = []
    for n in range(40):
        first = some_day()
        last = rng.choice([first + timedelta(rng.randrange(-5, 300)), date(9999, 12, 31), None])
        items = rng.choice(["P0", "P1,P2", "ALL", None, "P3"])
        rules.append((f"M{n}", items, rng.choice(["R", "ALL", None]), rng.choice(["N", "", "S"]), first, last))
    offers = spark.createDataFrame(
        rules,
        "promotion_id string, applicable_products string, target_channel string, target_region string,"
        " start_date date, end_date date",
    )
    expected = sorted(
        (line[0], rule[0])
        for line in lines for rule in rules
        if line[4] and rule[5] and rule[4] <= line[4] <= rule[5]
        and (rule[1] in (None, "ALL") or line[2] in rule[1].split(","))
        and rule[2] in (None, "ALL", line[8]) and rule[3] in ("", line[7])
    )
    out = promotions.promotion_bridge(sales(spark, *lines), offers, ["order_id"])
    assert expected and sorted((r["order_id"], r["promotion_id"]) for r in out.collect()) == expected


@pytest.mark.parametrize("items", ["P1", "ALL"])
def test_sales_on_days_without_a_rule_are_not_carried_on(spark, monkeypatch, items):
    tables = {}
    def kept(df, label):
        tables[label] = stored(df, label)
        return tables[label]

    monkeypatch.setattr(promotions, "stored", kept)
    monkeypatch.setattr("crateflow.plans.sizing.BROADCAST_ROWS", 0)
    days = [date(2024, 1, 1) + timedelta(n) for n in range(366)]
    lines = sales(spark, *[(f"O{n}", "C", "P1", "E", day, 1.0, 1.0, "N", "R", "b") for n, day in enumerate(days)])
    offers = spark.createDataFrame(
        [("M", items, None, None, date(2024, 3, 1), date(2024, 3, 30), 1.0)],
        "promotion_id string, applicable_products string, target_channel string, target_region string,"
        " start_date date, end_date date, actual_cost_vnd double",
    )
    assert promotions.promotion_bridge(lines, offers, ["order_id"]).count() == 30
    assert tables["asked"].count() == 30
    assert tuple(promotions.promotion_sales(lines, offers).first()) == ("M", 30.0, 336.0)
    assert tables["asked"].count() == 30
    assert promotions.promotion_uplift(lines, offers).first()["uplift_revenue"] == 0.0
    assert tables["asked"].count() == 60
