from datetime import datetime, timedelta, timezone

import pytest

from crateflow.contracts import LINEAGE, ROW_SEQ
from crateflow.operators.bronze import attach_lineage, cast_to_string
from crateflow.sources.delimited import scan_csv


def test_lineage_adds_five_constant_columns(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    out = attach_lineage(df, "SRC03_customer_master.csv", "2026-07-22", "b1", datetime(2026, 1, 2))
    assert out.columns == ["a", *LINEAGE]
    for row in out.collect():
        assert row[1:] == (
            "SRC03_customer_master.csv", "google_drive", "2026-07-22",
            "2026-01-02T00:00:00.000000Z", "b1",
        )


def test_lineage_time_is_utc_in_any_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
    try:
        noon = datetime(2026, 1, 2, 12, tzinfo=timezone(timedelta(hours=7)))
        row = cast_to_string(attach_lineage(spark.range(1), "f.csv", "2026-07-22", "b1", noon)).first()
        assert row["_ingested_at"] == "2026-01-02T05:00:00.000000Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_csv_files_are_bound_by_their_own_header(spark, tmp_path):
    (tmp_path / "in put").mkdir()
    (tmp_path / "in put" / "a.csv").write_text("name,street\nAn,Street1\n")
    (tmp_path / "in put" / "b%20.csv").write_text("street,extra,name\nStreet2,x,Binh\n")
    rows = scan_csv(spark, str(tmp_path / "in put"), row_seq=True).orderBy("name").collect()
    assert [(r["name"], r["street"], r["extra"]) for r in rows] == [
        ("An", "Street1", None), ("Binh", "Street2", "x"),
    ]
    assert len({r[ROW_SEQ] for r in rows}) == 2


def test_csv_names_may_hold_signs_of_a_pattern(spark, tmp_path):
    names = ["s[1].csv", "s1.csv", "a{b,c}.csv", "q?.csv", "st*r.csv"]
    for at, name in enumerate(names):
        (tmp_path / name).write_text(f"id,{'a' if at % 2 else 'b'}\n{at},x\n")
    for at, name in enumerate(names):
        assert [r["id"] for r in scan_csv(spark, str(tmp_path / name)).collect()] == [str(at)]
    everything = scan_csv(spark, [str(tmp_path / name) for name in names])
    assert sorted(r["id"] for r in everything.collect()) == ["0", "1", "2", "3", "4"]
    assert sorted(r["id"] for r in scan_csv(spark, str(tmp_path)).collect()) == ["0", "1", "2", "3", "4"]
    # no file of that name: a pattern
    assert sorted(r["id"] for r in scan_csv(spark, str(tmp_path / "s*.csv")).collect()) == ["0", "1", "4"]


def test_csv_without_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\n")
    (tmp_path / "b.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        scan_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])


def test_lineage_time_is_one_value_per_call(spark):
    out = attach_lineage(spark.range(100).repartition(8), "f.csv", "2026-07-22", "b1")
    assert out.select("_ingested_at").distinct().count() == 1


def test_cast_to_string_keeps_order_and_nulls(spark):
    df = spark.createDataFrame([(1, 2.5, True, None)], "z int, a double, m boolean, n int")
    out = cast_to_string(df)
    assert out.columns == ["z", "a", "m", "n"]
    assert {t for _, t in out.dtypes} == {"string"}
    assert out.first() == ("1", "2.5", "true", None)


def test_csv_is_all_strings_by_header(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,amount,note\n1,100.5,ok\n2,200.75,\n3,300,ok\n")
    df = scan_csv(spark, str(tmp_path / "s.csv"))
    assert {t for _, t in df.dtypes} == {"string"}
    assert [tuple(r) for r in df.collect()] == [
        ("1", "100.5", "ok"), ("2", "200.75", None), ("3", "300", "ok"),
    ]


def test_csv_quoted_line_break_is_one_row(spark, tmp_path):
    (tmp_path / "s.csv").write_text('id,note\n1,"a ""b"",\nc"\n2,d\n')
    rows = scan_csv(spark, str(tmp_path / "s.csv"), row_seq=True).orderBy(ROW_SEQ).collect()
    assert [r["note"] for r in rows] == ['a "b",\nc', "d"]


def test_csv_ragged_row_fails(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,note\n1,a\n2,b,c\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_csv(spark, str(tmp_path / "s.csv")).collect()


def test_csv_missing_file(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_csv(spark, str(tmp_path / "none.csv"))
