from datetime import date

import pytest
from pyspark.sql import functions as F

from crateflow.contracts import BY_CODE, LINEAGE, ROW_SEQ
from crateflow.functions.columns import first_of_month, packed_list, source_name, whole
from crateflow.operators import quality, silver


def frame(spark, code, *rows):
    """All-string table of a source; each row gives some columns, the others are NULL."""
    source = BY_CODE[code]
    columns = [*source.columns, *sorted({k for row in rows for k in row} - set(source.columns))]
    schema = ", ".join(f"{name} string" for name in columns)
    return spark.createDataFrame([tuple(row.get(c) for c in columns) for row in rows], schema)


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_money(spark):
    df = spark.createDataFrame([("1,000,000", "x"), ("278,000,000", "1,0"), (None, "y")], "a string, b string")
    out = silver.cast_numbers(df, ("a",))
    assert values(out, "a") == [1000000.0, 278000000.0, None]
    assert values(out, "b") == ["x", "1,0", "y"]
    assert dict(out.dtypes) == {"a": "double", "b": "string"}


@pytest.mark.parametrize("good", ["1", "-2.5", "+.5", "3.", "1e3", "1.5E-2"])
def test_money_takes_plain_numbers(spark, good):
    df = spark.createDataFrame([(good,)], "a string")
    assert values(silver.cast_numbers(df, ("a",)), "a") == [float(good)]


@pytest.mark.parametrize("bad", ["abc", "1d", " 1 ", "", "1.2.3", "NaN", "0x1"])
def test_money_rejects_everything_else(spark, bad):
    df = spark.createDataFrame([(bad,)], "a string")
    with pytest.raises(Exception, match="not a number"):
        silver.cast_numbers(df, ("a",)).collect()


def test_dates_are_lenient(spark):
    texts = ["2024-08-22", "not-a-date", "2024-12-28", "2024-1-5", "2024-01-05 00:00:00", "2023-02-29", None]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    out = silver.cast_dates(df, ("d",), "yyyy-MM-dd")
    assert values(out, "d") == [date(2024, 8, 22), None, date(2024, 12, 28), None, None, None, None]


def test_text(spark):
    texts = ["  Miền Nam  ", "\t a b ", "　x\n", "", None]
    df = spark.createDataFrame([(t, t) for t in texts], "t string, u string")
    out = silver.standardize_text(df, ("t",))
    assert values(out, "t") == ["MIỀN NAM", "A B", "X", "", None]
    assert values(out, "u") == texts


def test_copies_go_near_copies_stay(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), ("a", "2"), (None, "1"), (None, "1")], "k string, v string")
    assert sorted(silver.drop_copies(df).collect(), key=str) == [("a", "1"), ("a", "2"), (None, "1")]


def test_copies_keep_the_first_position(spark):
    df = spark.createDataFrame([("a", 5), ("a", 3), ("b", 4)], f"k string, {ROW_SEQ} long")
    assert sorted(silver.drop_copies(df).collect()) == [("a", 3), ("b", 4)]


def test_null_keys(spark):
    df = spark.createDataFrame(
        [("CUS001", "PRD001"), (None, "PRD002"), ("CUS003", None)], "c string, p string"
    )
    assert silver.drop_null_keys(df, ("c", "p")).collect() == [("CUS001", "PRD001")]


def test_fill_null_leaves_other_columns(spark):
    df = spark.createDataFrame([(None, None), ("1", "2")], "a string, b string")
    assert sorted(silver.fill_null(df, ("a",), "UNKNOWN").collect()) == [("1", "2"), ("UNKNOWN", None)]


def test_contract_names_missing_columns_and_keeps_extra_ones(spark, caplog):
    df = frame(spark, "SRC04", {"product_id": "P1", "surprise": "x"})
    silver.check_contract(df, BY_CODE["SRC04"])
    assert "surprise" in caplog.text
    assert "surprise" in silver.transform(df, BY_CODE["SRC04"]).columns
    with pytest.raises(silver.ContractError, match="SRC04_product_master.*2 of 10.*category, unit"):
        silver.check_contract(df.drop("unit", "category"), BY_CODE["SRC04"])


def stats(df, code):
    return silver.transform_stats(df, BY_CODE[code]).first().asDict()


def test_transform_counts(spark):
    row = {"customer_id": "C1", "region": " north ", "credit_limit": "1,000", "join_date": "2024-01-01"}
    df = frame(
        spark, "SRC03", row, {**row, "region": "NORTH"}, {**row, "customer_id": None},
        {**row, "customer_id": None}, {**row, "customer_id": "C2", "tax_code": "T"},
    )
    # the first two are equal only after the text was standardised
    assert stats(df, "SRC03") == {
        "row_count_in": 5, "row_count_out": 2, "dedup_count": 2, "null_count": 1,
    }
    out = {r["customer_id"]: r for r in silver.transform(df, BY_CODE["SRC03"]).collect()}
    assert set(out) == {"C1", "C2"}
    assert out["C1"]["tax_code"] == "UNKNOWN" and out["C2"]["tax_code"] == "T"
    assert out["C1"]["credit_limit"] == 1000.0 and out["C1"]["region"] == "NORTH"
    assert silver.null_key_rows(df, BY_CODE["SRC03"]).count() == 1


def test_transform_of_an_empty_source(spark):
    df = frame(spark, "SRC03", {"customer_id": "x"}).limit(0)
    assert stats(df, "SRC03") == dict.fromkeys(
        ("row_count_in", "row_count_out", "dedup_count", "null_count"), 0
    )
    assert silver.transform(df, BY_CODE["SRC03"]).count() == 0


def test_lineage_and_untyped_columns_survive(spark):
    lineage = dict.fromkeys(LINEAGE, "x")
    df = frame(spark, "SRC02", {"employee_id": "E1", "year": "2024", "month": "2", **lineage})
    out = silver.transform(df, BY_CODE["SRC02"])
    assert set(LINEAGE) <= set(out.columns)
    assert dict(out.dtypes)["year"] == "string"


def test_date_null_ratio_alarm(spark):
    rows = [{"product_id": "1", "launch_date": d} for d in ("2024-01-01", "x", None)]
    row = quality.date_null_ratio(frame(spark, "SRC04", *rows), BY_CODE["SRC04"]).first()
    assert (row["row_count"], row["null_rows"], row["newly_null_rows"]) == (3, 2, 1)
    assert row["level"] == "warning"
    fine = quality.date_null_ratio(frame(spark, "SRC04", rows[0]), BY_CODE["SRC04"]).first()
    assert fine["level"] == "info" and fine["null_ratio"] == 0
    empty = quality.date_null_ratio(frame(spark, "SRC04", rows[0]).limit(0), BY_CODE["SRC04"]).first()
    assert empty["null_ratio"] is None and empty["level"] == "info"


def test_contract_profile(spark):
    df = frame(spark, "SRC04", {"product_id": "1", "unit_price": "1,0"}, {"unit_price": "1d", "launch_date": "x"})
    out = {r["column_name"]: tuple(r)[1:] for r in quality.contract_profile(df.drop("unit"), BY_CODE["SRC04"]).collect()}
    assert out["product_id"] == ("text", True, 2, 1, 1)
    assert out["unit_price"] == ("number", True, 2, 2, 1)
    assert out["launch_date"] == ("date", True, 2, 1, 0)
    assert out["unit"] == ("text", False, 2, 0, 0)


def test_grain_and_keys(spark):
    df = spark.createDataFrame([("a", -1), ("a", 3), ("b", None)], "id string, k long")
    assert quality.grain_violations(df, ["id"]).collect() == [("a", 2)]
    assert tuple(quality.key_resolution(df, ["k"]).first())[:4] == ("k", 3, 1, 1)


def test_source_name(spark):
    files = ["SRC01_sales.csv", "a.b.xlsx", "plain", ".hidden", "..x", "a..csv", "end."]
    df = spark.createDataFrame([(f,) for f in files], "f string").select(source_name(F.col("f")))
    assert [r[0] for r in df.collect()] == ["SRC01_sales", "a.b", "plain", ".hidden", "..x", "a.", "end"]


def test_packed_list_and_month(spark):
    df = spark.createDataFrame([("A, B;C|A||", "2.0", "13"), (None, "x", "2")], "l string, y string, m string")
    assert values(df, packed_list("l")) == [["A", "B", "C"], None]
    assert values(df, whole("y")) == [2, None]
    assert values(df, first_of_month(F.lit(2024), whole("m"))) == [None, date(2024, 2, 1)]


def test_few_copies_go_without_a_shuffle_of_every_row(spark, monkeypatch):
    row = {"order_id": "O1", "customer_id": "C1", "product_id": "P1", "quantity": "1,000", "region": " north "}
    bronze = frame(
        spark, "SRC01", row, row | {"quantity": "1000", "region": "NORTH"}, row | {"quantity": "1001"},
        row | {"order_id": "O2", "quantity": "0"}, row | {"order_id": "O2", "quantity": "-0"},
        row | {"order_id": "O3"}, row | {"customer_id": None}, row | {"customer_id": None},
    )
    source = BY_CODE["SRC01"]
    keys = ["order_id", "quantity"]
    whole_rows = sorted(map(tuple, silver.transform(bronze, source).select(keys).collect()))
    assert whole_rows == [("O1", 1000.0), ("O1", 1001.0), ("O2", 0.0), ("O3", 1000.0)]
    found = silver.transform(bronze, source, few_copies=True).select(keys)
    assert sorted(map(tuple, found.collect())) == whole_rows
    # too many hashes to broadcast: every row is compared
    monkeypatch.setattr("crateflow.plans.sizing.BROADCAST_ROWS", 0)
    found = silver.transform(bronze, source, few_copies=True).select(keys)
    assert sorted(map(tuple, found.collect())) == whole_rows
    monkeypatch.undo()

    distinct = bronze.where("order_id = 'O3'")
    plan = silver.transform(distinct, source, few_copies=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_few_copies_keep_the_first_position(spark):
    row = {"customer_id": "C1", "status": "a"}
    bronze = frame(
        spark, "SRC03", row | {ROW_SEQ: "7"}, row | {ROW_SEQ: "3", "status": " A"}, {"customer_id": "C2", ROW_SEQ: "1"}
    )
    out = silver.transform(bronze, BY_CODE["SRC03"], few_copies=True).select("customer_id", ROW_SEQ)
    assert sorted(map(tuple, out.collect())) == [("C1", 3), ("C2", 1)]
