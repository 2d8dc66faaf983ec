import csv
import os
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest

from crateflow import jobs
from crateflow.catalog import feeds, queries
from crateflow.catalog.workbooks import encode_workbook
from crateflow.contracts import BY_CODE, LINEAGE, ROW_SEQ, SOURCES
from crateflow.session import _CLEANUP, in_this_job, scratch_of_job, shuffles_removed, stored
from crateflow.sources import tables as layer_tables
from crateflow.sources.tables import append_rows, latest_per, publish, read_table, run_history, take_back
from crateflow.streaming.landing import ingest_new_files

DAY = "2026-07-22"

# a small company; columns not given stay empty
ROWS = {
    "SRC01": [
        {"order_id": "O1", "order_date": "2024-02-01", "customer_id": "C1", "product_id": "P1",
         "employee_id": "E1", "net_amount": "1,000", "gross_amount": "1,100", "region": " north "},
        {"order_id": "O1", "order_date": "2024-02-01", "customer_id": "C1", "product_id": "P1",
         "employee_id": "E1", "net_amount": "1,000", "gross_amount": "1,100", "region": "NORTH"},
        {"order_id": "O2", "order_date": "2024-07-01", "customer_id": "C2", "product_id": "P9",
         "employee_id": "E1", "net_amount": "500", "gross_amount": "500", "region": "SOUTH"},
        {"order_id": "O3", "order_date": "bad", "product_id": "P1", "net_amount": "1"},
    ],
    "SRC02": [{"employee_id": "E1", "year": "2024", "month": "2", "target_revenue": "2,000"}],
    "SRC03": [
        {"customer_id": "C1", "customer_name": "first", "credit_limit": "1,000"},
        {"customer_id": "C2", "customer_name": "two"},
        {"customer_id": "C1", "customer_name": "later"},
    ],
    "SRC04": [{"product_id": "P1", "unit_price": "10.5"}, {"product_id": "P2", "unit_price": "3"}],
    "SRC05": [{"order_id": "D1", "order_date": "2024-12-01", "distributor_id": "S1", "product_id": "P1",
               "qty_ordered": "10", "qty_delivered": "5", "ontime_delivery": "true"}],
    "SRC06": [{"distributor_id": "S1"}],
    "SRC07": [
        {"employee_id": "E1", "version": "1", "region": "north", "effective_date": "2024-01-01"},
        {"employee_id": "E1", "version": "2", "region": "south", "effective_date": "2024-06-01"},
    ],
    "SRC08": [{"territory_id": "T1", "employee_id": "E1", "customer_id": "C1", "effective_date": "2024-01-01"}],
    "SRC09": [{"return_id": "R1", "return_date": "2024-11-05", "customer_id": "C1", "product_id": "P1",
               "employee_id": "E1", "return_amount": "100", "region": "north"}],
    "SRC10": [{"promotion_id": "M1", "applicable_products": "P1,P2", "start_date": "2024-02-01",
               "end_date": "2024-02-28", "actual_cost_vnd": "10"}],
}


def write_source(folder, code, rows, columns=None):
    source = BY_CODE[code]
    columns = columns or source.columns
    path = os.path.join(folder, source.file)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if source.format == "csv":
        with open(path, "w", newline="", encoding="utf-8") as out:
            writer = csv.DictWriter(out, columns)
            writer.writeheader()
            writer.writerows(rows)
    else:
        with open(path, "wb") as out:
            out.write(encode_workbook(list(columns), [tuple(r.get(c) for c in columns) for r in rows]))


@pytest.fixture
def layers(tmp_path):
    raw = str(tmp_path / "raw")
    for code, rows in ROWS.items():
        write_source(raw, code, rows)
    return {name: str(tmp_path / name) for name in ("raw", "bronze", "silver", "gold")}


def bronze(spark, layers, **kwargs):
    return jobs.run_bronze(spark, DAY, "b1", layers["raw"], layers["bronze"], **kwargs)


def silver(spark, layers):
    return jobs.run_silver(spark, DAY, layers["bronze"], layers["silver"])


def tables(folder):
    return sorted(n for n in os.listdir(f"{folder}/20260722") if not n.startswith("_"))


def test_files_to_gold(spark, layers):
    records = bronze(spark, layers)
    assert jobs.outcome(records) == (True, "OK: 10/10 sources")
    assert {r["source_name"][:5]: r["rows_loaded"] for r in records} == {c: len(r) for c, r in ROWS.items()}
    assert tables(layers["bronze"]) == sorted([f"{s.name}.parquet" for s in SOURCES] + ["ingest_log.parquet"])
    raw = read_table(spark, layers["bronze"], DAY, BY_CODE["SRC03"].name)
    assert {t for _, t in raw.dtypes} == {"string"} and set(LINEAGE) <= set(raw.columns)

    assert all(r == {"source_file": r["source_file"], "status": "success", "error": None} for r in silver(spark, layers))
    log = read_table(spark, layers["silver"], DAY, "silver_log")
    assert log.columns[:2] == ["source_name", "run_date"] and log.count() == 10
    sales = log.filter("source_name = 'SRC01_sales_transactions'").first()
    assert (sales["row_count_in"], sales["row_count_out"], sales["dedup_count"], sales["null_count"]) == (4, 2, 1, 1)
    clean = read_table(spark, layers["silver"], DAY, BY_CODE["SRC01"].name)
    assert dict(clean.dtypes)["net_amount"] == "double" and dict(clean.dtypes)["order_date"] == "date"
    assert clean.filter("order_id = 'O1'").first()["region"] == "NORTH"

    records = jobs.run_gold(spark, DAY, layers["silver"], layers["gold"])
    assert {r["status"] for r in records} == {"success"} and len(records) == 13
    assert {r["table_name"]: r["copies_dropped"] for r in records if r["copies_dropped"]} == {"dim_customers": 1}
    gold = {r["table_name"]: read_table(spark, layers["gold"], DAY, r["table_name"]) for r in records}
    assert all(gold[r["table_name"]].count() == r["rows"] for r in records)
    fact = {r["order_id"]: r for r in gold["fact_sales"].collect()}
    assert (fact["O1"]["customer_key"], fact["O1"]["product_key"], fact["O1"]["employee_key"]) == (1, 1, 1)
    assert (fact["O2"]["customer_key"], fact["O2"]["product_key"], fact["O2"]["employee_key"]) == (2, -1, 2)
    assert fact["O1"]["date_key"] == 20240201 and fact["O1"]["_batch_id"] == "b1"
    assert ROW_SEQ not in gold["fact_sales"].columns
    customers = {r["customer_id"]: r for r in gold["dim_customers"].collect()}
    assert customers["C1"]["customer_name"] == "first" and "tax_code" not in gold["dim_customers"].columns
    # a return after the last sale still has a date
    assert gold["fact_returns"].first()["date_key"] == 20241105
    assert gold["fact_returns"].first()["territory_key"] == 1
    assert gold["fact_distributor_orders"].first()["distributor_key"] == 1
    assert [r["promotion_id"] for r in gold["bridge_sales_promotion"].collect()] == ["M1"]
    mart = {(r["region"], r["month"]): r for r in gold["mart_sales_vs_target"].collect()}
    assert mart[("NORTH", 2)]["variance_pct"] == -50.0
    assert mart[("SOUTH", 7)]["target_revenue"] == 0.0


def test_one_bad_source_does_not_stop_bronze(spark, layers):
    write_source(layers["raw"], "SRC04", ROWS["SRC04"], columns=("product_name", "unit"))
    os.remove(os.path.join(layers["raw"], BY_CODE["SRC06"].file))
    records = bronze(spark, layers)
    status = {r["source_name"][:5]: r["status"] for r in records if r["status"] != "success"}
    assert status == {"SRC04": "schema_mismatch", "SRC06": "failed"}
    assert all(r["rows_loaded"] == 0 for r in records if r["status"] != "success")
    assert jobs.outcome(records) == (False, "FAILED: 2/10 sources")
    assert len(tables(layers["bronze"])) == 9
    # Silver logs the two that are missing and goes on
    failed = {r["source_file"][:5] for r in silver(spark, layers) if r["status"] == "failed"}
    assert failed == {"SRC04", "SRC06"}
    log = read_table(spark, layers["silver"], DAY, "silver_log")
    assert log.filter("status = 'failed' AND error_message IS NOT NULL").count() == 2


def test_one_bad_table_does_not_stop_gold(spark, layers):
    bronze(spark, layers)
    sources = tuple(s for s in SOURCES if s != BY_CODE["SRC04"])
    jobs.run_silver(spark, DAY, layers["bronze"], layers["silver"], sources)
    records = jobs.run_gold(spark, DAY, layers["silver"], layers["gold"])
    failed = {r["table_name"]: r["error_message"] for r in records if r["status"] == "failed"}
    assert set(failed) == {
        "dim_products", "fact_sales", "fact_returns", "fact_distributor_orders",
        "bridge_sales_promotion", "mart_sales_vs_target",
    }
    assert failed["fact_sales"] == "needs dim_products"
    assert read_table(spark, layers["gold"], DAY, "fact_targets").count() == len(ROWS["SRC02"])
    log = read_table(spark, layers["gold"], DAY, "gold_log")
    assert log.where("status = 'failed'").count() == 6 and log.count() == 13


def test_a_reader_gets_a_bucket_root_unchanged(spark, tmp_path):
    asked = []

    def read(source, paths):
        asked.extend(paths)
        raise OSError("not here")

    source = (BY_CODE["SRC04"],)
    for root in ("s3a://bucket/raw", "hdfs://name/raw/"):
        jobs.run_bronze(spark, DAY, "b", root, str(tmp_path), {"xlsx": read}, source)
    assert asked == [f"s3a://bucket/raw/{source[0].file}", f"hdfs://name/raw/{source[0].file}"]


def test_a_replacement_that_did_not_end_is_not_seen(spark, tmp_path):
    root = str(tmp_path)
    target = publish(spark.range(3), root, DAY, "t")
    # the driver is lost after the rows are written, before they are made current
    spark.range(7).write.parquet(f"{target}/_versions/unfinished")
    assert read_table(spark, root, DAY, "t").count() == 3
    publish(spark.range(5), root, DAY, "t")
    assert read_table(spark, root, DAY, "t").count() == 5
    with pytest.raises(Exception):
        publish(spark.range(2).selectExpr("assert_true(id < 1) AS id"), root, DAY, "t")
    assert read_table(spark, root, DAY, "t").count() == 5


def test_a_reader_beside_a_replacement_has_the_old_table_or_the_new_one(spark, tmp_path, monkeypatch):
    root, seen = str(tmp_path), []
    publish(spark.range(3), root, DAY, "t")
    early = read_table(spark, root, DAY, "t")
    commit = layer_tables._commit

    def between(*args):
        seen.append(read_table(spark, root, DAY, "t").count())
        commit(*args)
        seen.append(read_table(spark, root, DAY, "t").count())

    monkeypatch.setattr(layer_tables, "_commit", between)
    publish(spark.range(5), root, DAY, "t")
    assert seen == [3, 5] and early.count() == 3
    assert read_table(spark, root, DAY, "t").count() == 5


def test_writers_at_once_never_mix_their_rows(spark, tmp_path):
    root = str(tmp_path)
    frames = [spark.range(n).selectExpr("id", f"{n} AS n") for n in (3, 4, 5, 6)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda df: publish(df, root, DAY, "t"), frames * 2))
    rows = read_table(spark, root, DAY, "t").collect()
    assert len({r["n"] for r in rows}) == 1 and len(rows) == rows[0]["n"]


def test_a_day_is_taken_back(spark, tmp_path):
    root = str(tmp_path)

    def rows():
        history = run_history(spark, root, "t")
        return sorted((r["run_day"], r["id"]) for r in history.collect())

    publish(spark.range(1), root, "2026-07-21", "t")
    publish(spark.range(2), root, DAY, "t")
    publish(spark.range(50), root, DAY, "t")
    assert len(rows()) == 51
    take_back(spark, root, DAY, "t")
    assert rows() == [("20260721", 0), ("20260722", 0), ("20260722", 1)]
    assert read_table(spark, root, DAY, "t").count() == 2
    take_back(spark, root, DAY, "t")
    assert rows() == [("20260721", 0)]
    with pytest.raises(FileNotFoundError):
        read_table(spark, root, DAY, "t")
    # a new try, rows added to it, and the parts of a table go and come with its version
    publish(spark.range(4), root, DAY, "t")
    append_rows(spark.range(1), root, DAY, "t")
    assert len(rows()) == 6
    publish(spark.range(9), root, DAY, "t")
    take_back(spark, root, DAY, "t")
    assert len(rows()) == 6


def test_only_the_last_versions_are_kept(spark, tmp_path):
    root = str(tmp_path)
    for n in range(1, 7):
        target = publish(spark.range(n), root, DAY, "t")
    assert len(os.listdir(f"{target}/_versions")) == layer_tables.KEPT_VERSIONS
    for n in (5, 4):
        take_back(spark, root, DAY, "t")
        assert read_table(spark, root, DAY, "t").count() == n
    with pytest.raises(FileNotFoundError):
        take_back(spark, root, DAY, "t")
    assert read_table(spark, root, DAY, "t").count() == 4


def test_jobs_at_once_keep_their_own_intermediate_tables(spark):
    first_is_done, second_has_stored = threading.Event(), threading.Event()

    def short():
        with scratch_of_job(spark):
            table = stored(spark.range(3), "t")
            second_has_stored.wait(60)
            assert table.count() == 3
        first_is_done.set()

    def long():
        with scratch_of_job(spark):
            table = stored(spark.range(4), "t")
            with ThreadPoolExecutor(1) as pool:
                (helped,) = pool.map(in_this_job(lambda n: stored(spark.range(n), "t")), [5])
            second_has_stored.set()
            assert first_is_done.wait(60)
            assert table.count() == 4 and helped.count() == 5
            folders = {table.inputFiles()[0].split("/t-")[0], helped.inputFiles()[0].split("/t-")[0]}
        assert len(folders) == 1 and not os.path.exists(folders.pop().removeprefix("file://"))

    with ThreadPoolExecutor(2) as pool:
        for job in [pool.submit(short), pool.submit(long)]:
            job.result(timeout=120)


def test_a_replayed_batch_replaces_its_part(spark, tmp_path):
    folder = tmp_path / "in" / BY_CODE["SRC03"].file
    for name in ("one", "two"):
        write_source(str(folder / name), "SRC03", ROWS["SRC03"][:1])
    landing(spark, tmp_path)
    before = read_table(spark, str(tmp_path / "bronze"), DAY, BY_CODE["SRC03"].name).count()
    plain = jobs.default_readers(spark)["csv"]

    def only_alone(source, paths):
        if len(paths) > 1:
            raise OSError("busy")
        return plain(source, paths)

    # the checkpoint of the first attempt is lost, and reading many files fails
    ingest_new_files(
        spark, str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "again"), DAY, "b1",
        {"csv": only_alone},
    )
    assert read_table(spark, str(tmp_path / "bronze"), DAY, BY_CODE["SRC03"].name).count() == before == 2


def test_rerun_replaces_tables_and_ingest_log_but_adds_to_silver_log(spark, layers):
    sources = (BY_CODE["SRC03"], BY_CODE["SRC04"])
    for _ in range(2):
        bronze(spark, layers, sources=sources)
        jobs.run_silver(spark, DAY, layers["bronze"], layers["silver"], sources)
    assert read_table(spark, layers["bronze"], DAY, BY_CODE["SRC03"].name).count() == 3
    assert read_table(spark, layers["bronze"], DAY, "ingest_log").count() == 2
    assert read_table(spark, layers["silver"], DAY, BY_CODE["SRC03"].name).count() == 3
    assert read_table(spark, layers["silver"], DAY, "silver_log").count() == 4


def test_a_failing_transform_leaves_the_old_table(spark, layers):
    source = (BY_CODE["SRC04"],)
    bronze(spark, layers, sources=source)
    jobs.run_silver(spark, DAY, layers["bronze"], layers["silver"], source)
    write_source(layers["raw"], "SRC04", [{"product_id": "P1", "unit_price": "ten"}])
    bronze(spark, layers, sources=source)
    record = jobs.run_silver(spark, DAY, layers["bronze"], layers["silver"], source)[0]
    assert record["status"] == "failed" and "not a number: ten" in record["error"]
    assert read_table(spark, layers["silver"], DAY, BY_CODE["SRC04"].name).count() == 2
    # nothing half written is left behind
    table = f"{layers['silver']}/20260722/{BY_CODE['SRC04'].name}.parquet"
    assert len(os.listdir(f"{table}/_versions")) == 1


def test_other_run_dates_are_untouched_and_history_sees_both(spark, tmp_path):
    root = str(tmp_path / "layer")
    first = spark.createDataFrame([("s", 1), ("t", 2)], "source_name string, n int")
    publish(first, root, "2026-07-21", "log")
    publish(first.filter("n = 1").selectExpr("source_name", "n + 10 AS n"), root, "2026-07-22", "log")
    assert read_table(spark, root, "2026-07-21", "log").count() == 2
    history = run_history(spark, root, "log")
    assert sorted(map(tuple, history.collect())) == [("s", 1, "20260721"), ("s", 11, "20260722"), ("t", 2, "20260721")]
    assert sorted(r["n"] for r in latest_per(history, ["source_name"]).collect()) == [2, 11]


def test_reader_can_be_replaced(spark, tmp_path):
    df = spark.createDataFrame([("P1",)], "product_id string")

    def read(source, paths):
        assert paths == ["somewhere/SRC04_product_master.xlsx"]
        return df.selectExpr("product_id", *[f"CAST(NULL AS STRING) AS {c}" for c in source.columns[1:]])

    records = jobs.run_bronze(
        spark, DAY, "b", "somewhere", str(tmp_path), {"xlsx": read}, (BY_CODE["SRC04"],)
    )
    assert records[0]["rows_loaded"] == 1 and records[0]["source_platform"] == "google_drive"


def landing(spark, tmp_path):
    ingest_new_files(
        spark, str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "seen"), DAY, "b1"
    )


def test_landing_takes_each_file_once(spark, tmp_path):
    folder = tmp_path / "in" / BY_CODE["SRC03"].file
    for name, rows in (("one", ROWS["SRC03"][:1]), ("two", ROWS["SRC03"][1:])):
        write_source(str(folder / name), "SRC03", rows)
        landing(spark, tmp_path)
    table = read_table(spark, str(tmp_path / "bronze"), DAY, BY_CODE["SRC03"].name)
    assert sorted(r["customer_name"] for r in table.collect()) == ["first", "later", "two"]
    landing(spark, tmp_path)
    assert read_table(spark, str(tmp_path / "bronze"), DAY, BY_CODE["SRC03"].name).count() == 3
    log = read_table(spark, str(tmp_path / "bronze"), DAY, "landing_log")
    assert [r["status"] for r in log.collect()] == ["success", "success"]


def test_landing_isolates_a_bad_file(spark, tmp_path):
    folder = tmp_path / "in" / BY_CODE["SRC04"].file
    write_source(str(folder / "good"), "SRC04", ROWS["SRC04"])
    (folder / "bad").mkdir()
    (folder / "bad" / "x.xlsx").write_bytes(b"no workbook")
    (tmp_path / "in" / "stray").mkdir()
    (tmp_path / "in" / "stray" / "y.csv").write_text("a\n1\n")
    landing(spark, tmp_path)
    log = read_table(spark, str(tmp_path / "bronze"), DAY, "landing_log").collect()
    assert {r["source_file"]: r["status"] for r in log} == {
        BY_CODE["SRC04"].file: "success", "x.xlsx": "failed", "y.csv": "failed",
    }
    assert read_table(spark, str(tmp_path / "bronze"), DAY, BY_CODE["SRC04"].name).count() == 2


def test_dates_in_workbooks_reach_silver(spark, layers):
    rows = [{**ROWS["SRC07"][0], "effective_date": date(2024, 1, 1)}]
    write_source(layers["raw"], "SRC07", rows)
    source = (BY_CODE["SRC07"],)
    bronze(spark, layers, sources=source)
    jobs.run_silver(spark, DAY, layers["bronze"], layers["silver"], source)
    table = read_table(spark, layers["silver"], DAY, BY_CODE["SRC07"].name)
    assert table.first()["effective_date"] == date(2024, 1, 1)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
@pytest.mark.parametrize("name", ["gold_job", "bronze_job"])
def test_a_job_joins_lines_and_orders_once(spark, monkeypatch, name):
    joins, join = [], feeds.spread_join

    def counted(*args, **kwargs):
        joins.append(args[2])
        return join(*args, **kwargs)

    monkeypatch.setattr(feeds, "spread_join", counted)
    assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    assert joins == [["l_orderkey"]]


def test_bronze_and_silver_are_packed_small(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "k string")
    path = publish(df, str(tmp_path), DAY, "t", layer_tables.SMALL)
    assert any(name.endswith(".zstd.parquet") for _, _, names in os.walk(path) for name in names)
    assert [tuple(r) for r in read_table(spark, str(tmp_path), DAY, "t").collect()] == [("a",)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_territories_from_stored_sales(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    direct, ours = feeds.territories(spark, folder), feeds.territories_of(feeds.sales(spark, folder))
    assert direct.schema == ours.schema and direct.count() == ours.count() > 0
    assert direct.exceptAll(ours).count() == 0
    joins, join = [], feeds.spread_join
    monkeypatch.setattr(feeds, "spread_join", lambda *args: joins.append(args[2]) or join(*args))
    queries.QUERIES["fact_sales_territory"](spark, folder)
    assert joins == [["l_orderkey"]]


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles().iterator()
    return {name for name in iter(lambda: files.next().getName() if files.hasNext() else None, None)
            if name.startswith("shuffle_")}


def test_shuffle_files_go_with_their_execution(spark):
    def kept():
        before = shuffle_files(spark)
        stored(spark.range(1000).repartition(4, "id"), "t")
        for _ in range(50):
            left = shuffle_files(spark) - before
            if not left:
                break
            time.sleep(0.1)
        return len(left)

    assert kept() > 0
    with shuffles_removed(spark):
        with shuffles_removed(spark):
            assert kept() == 0
        assert kept() == 0
    assert spark.conf.get(_CLEANUP, None) is None
    spark.conf.set(_CLEANUP, "false")
    with pytest.raises(KeyError), shuffles_removed(spark):
        raise KeyError
    assert spark.conf.get(_CLEANUP) == "false"
    spark.conf.unset(_CLEANUP)


def test_gold_removes_shuffle_files_packs_tables_and_builds_wide_facts_alone(spark, layers, monkeypatch):
    bronze(spark, layers)
    silver(spark, layers)
    running, together, lock = set(), set(), threading.Lock()
    write = jobs.publish

    def watched(df, root, run_date, name, *codec):
        with lock:
            running.add(name)
            together.update((name, other) for other in running - {name})
        assert spark.conf.get(_CLEANUP) == "true" or name == "gold_log"
        write(df, root, run_date, name, *codec)
        with lock:
            running.discard(name)

    monkeypatch.setattr(jobs, "publish", watched)
    records = jobs.run_gold(spark, DAY, layers["silver"], layers["gold"])
    assert all(record["status"] == "success" for record in records)
    wide = {"fact_sales", "fact_returns", "fact_distributor_orders"}
    assert not any({one, other} <= wide for one, other in together)
    assert spark.conf.get(_CLEANUP, None) is None
    files = read_table(spark, layers["gold"], DAY, "fact_sales").inputFiles()
    assert files and all(name.endswith(".zstd.parquet") for name in files)
