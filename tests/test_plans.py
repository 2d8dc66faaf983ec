from collections import Counter

import pytest
from pyspark.sql import functions as F

from crateflow.plans import spread
from crateflow.plans.dense_key import dense_key
from crateflow.plans.sizing import fits_broadcast, stored_with_size
from crateflow.session import stored


def skewed(spark):
    """2,000 rows: a third with one key, a third without a key, copies included."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 40))
    )
    return spark.range(2000).select(key.alias("k"), (F.col("id") % 7).alias("v")).repartition(8)


def brute(left, right, how, test=lambda v, w: True):
    out = Counter()
    for k, v in left:
        hits = [w for rk, w in right if k is not None and rk == k and test(v, w)]
        for w in hits or ([None] if how == "left" else []):
            out[(k, v, w)] += 1
    return out


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("fits", [True, False])
@pytest.mark.parametrize("bounded", [True, False])
def test_join_equals_brute_force(spark, how, fits, bounded):
    left = skewed(spark)
    rights = [("hot", 2), ("hot", 5), ("k2", 1), ("k5", 9), (None, 3), ("none", 4)]
    right = spark.createDataFrame(rights, "k string, w long")
    condition = F.col("v") <= F.col("w") if bounded else None
    got = spread.spread_join(left, right, ["k"], how, condition, right_fits=fits)
    assert got.columns == ["k", "v", "w"]
    test = (lambda v, w: v <= w) if bounded else (lambda v, w: True)
    expected = brute([tuple(r) for r in left.collect()], rights, how, test)
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_hot_and_missing_keys_are_split(spark):
    left = skewed(spark)
    hot = {r["_h"]: r["_salts"] for r in spread._hot_keys(left, ["k"]).collect()}
    hashes = spark.sql("SELECT xxhash64('hot') AS h, xxhash64(CAST(NULL AS STRING)) AS n").first()
    # a third of the rows over 8 partitions is worth three salts
    assert hot == {hashes["h"]: 3, hashes["n"]: 3}


def test_every_hot_key_is_split_however_many(spark):
    left = spark.range(60_000).select((F.col("id") % 1500).cast("string").alias("k"))
    spark.conf.set("spark.sql.shuffle.partitions", "6000")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        hot = spread._hot_keys(left.coalesce(2), ["k"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
    assert hot.count() == 1500 and {r["_salts"] for r in hot.collect()} == {4}


def test_even_keys_are_not_split(spark):
    left = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    assert spread._hot_keys(left, ["k"]) is None


def test_frequent_keys_are_found_without_a_count_of_every_key(spark, monkeypatch):
    tables = []
    def kept(df, label):
        tables.append(stored(df, label))
        return tables[-1]

    monkeypatch.setattr(spread, "stored", kept)
    # nearly unique keys, and two that are frequent among them
    key = F.when(F.col("id") % 5 == 0, -1).when(F.col("id") % 6 == 0, -2).otherwise(F.col("id"))
    left = spark.range(60_000).select(key.alias("k"))
    hot = {r["_h"]: r["_salts"] for r in spread._hot_keys(left, ["k"]).collect()}
    hashes = spark.sql("SELECT xxhash64(-1L) AS a, xxhash64(-2L) AS b").first()
    # 12,000 and 8,000 of 60,000 rows over 8 partitions
    assert hot == {hashes["a"]: 2, hashes["b"]: 2}
    assert tables and sum(table.count() for table in tables) <= 8 * spread._BINS


def test_copies_of_a_hot_row_spread(spark):
    left = spark.range(4000).select(F.lit("hot").alias("k"), F.lit(1).alias("v")).repartition(16)
    right = spark.createDataFrame([("hot", 1)], "k string, w int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spread.spread_join(left, right, ["k"], right_fits=False)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(n for _, n in sizes) == 4000
    assert max(n for _, n in sizes) < 2500


def test_different_key_types_are_refused(spark):
    with pytest.raises(TypeError, match="'k'"):
        spread.spread_join(
            spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1,)], "k long"), ["k"]
        )
    with pytest.raises(ValueError, match="outer"):
        spread.spread_join(spark.range(1), spark.range(1), ["id"], "full_outer")


def test_size_check_counts_nested_values(spark):
    df = spark.range(10).select(
        F.array_repeat(F.lit("x" * 90), 10).alias("a"),
        F.create_map(F.lit("k"), F.array(F.lit(1), F.lit(2))).alias("m"),
        F.struct(F.lit("y" * 50).alias("s"), F.lit(None).cast("array<int>").alias("none")).alias("t"),
    )
    assert fits_broadcast(df, max_bytes=13_000)
    assert not fits_broadcast(df, max_bytes=10_000)


def test_size_check(spark):
    df = spark.range(100).select(F.lit("x" * 100).alias("s"))
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=99)
    assert not fits_broadcast(df, max_bytes=10_000)
    assert fits_broadcast(df, max_bytes=11_000)
    assert fits_broadcast(df.limit(0))


@pytest.mark.parametrize("parts", [1, 8])
def test_dense_key_is_the_global_row_number(spark, parts):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("n"), "id").repartition(parts)
    out = dense_key(df, "key", ["n"])
    assert out.columns == ["key", "n", "id"]
    rows = out.collect()
    assert sorted(r["key"] for r in rows) == list(range(1, 5001))
    assert all(r["key"] == r["n"] + 1 for r in rows)


def test_dense_key_of_an_empty_table(spark):
    assert dense_key(spark.range(0), "key", ["id"]).count() == 0


def test_dense_key_runs_over_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = dense_key(spark.range(10_000), "key", ["id"])
        plan = out._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "SinglePartition" not in plan
    assert out.rdd.getNumPartitions() > 1


@pytest.mark.parametrize("fits", [True, False])
def test_star_join_equals_one_lookup_after_the_other(spark, fits):
    fact = skewed(spark).withColumn("k2", F.when(F.col("v") < 4, F.lit(1)).otherwise(F.col("v")))
    words = spark.createDataFrame([("hot", 2), ("k2", 1), (None, 3)], "k string, w long")
    numbers = spark.createDataFrame([(1, "one"), (5, "five")], "n long, t string")
    lookups = [
        spread.Lookup(words, {"k": F.col("k")}, "a", lambda row: F.coalesce(row["w"], F.lit(-1)), fits),
        spread.Lookup(numbers, {"n": F.col("k2") + 0}, "b", lambda row: row["t"], fits),
    ]
    out = spread.star_join(fact, lookups)
    assert out.columns == ["k", "v", "k2", "a", "b"]
    w, t = {"hot": 2, "k2": 1}, {1: "one", 5: "five"}
    expected = Counter((k, v, k2, w.get(k, -1), t.get(k2)) for k, v, k2 in fact.collect())
    assert Counter(tuple(row) for row in out.collect()) == expected


def test_frequent_keys_of_several_lookups_come_from_one_pass(spark):
    fact = skewed(spark).withColumn("one", F.lit(1))
    keys = [[F.col("k")], [F.col("v")], [F.col("one")]]
    found = spread._frequent(fact, keys)
    alone = [spread._frequent(fact, [key])[0] for key in keys]
    for together, single in zip(found, alone, strict=True):
        assert sorted(together.collect()) == sorted(single.collect())
    assert [row["_salts"] for row in found[2].collect()] == [8]


def test_size_from_footers(spark, monkeypatch):
    # the same text a thousand times: a dictionary in the file, but not on an executor
    df = spark.range(1000).select(F.lit("x" * 100).alias("s"), F.array(F.lit("y" * 50)).alias("a"))
    assert stored_with_size(df, "t")[1]
    monkeypatch.setattr("crateflow.plans.sizing.BROADCAST_BYTES", 150_000)
    assert not stored_with_size(df, "t")[1]
    monkeypatch.setattr("crateflow.plans.sizing.BROADCAST_BYTES", 190_000)
    kept, fits = stored_with_size(df, "t")
    assert fits and kept.count() == 1000
    monkeypatch.setattr("crateflow.plans.sizing.BROADCAST_ROWS", 999)
    assert not stored_with_size(df, "t")[1]
    assert stored_with_size(df.limit(0), "t")[1]


def test_size_check_from_footers_runs_only_the_write(spark):
    spark.sparkContext.setJobGroup("size", "size")
    try:
        stored_with_size(spark.range(100).select(F.col("id").cast("string")), "t")
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("size")) == 1
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def star_of_three(fact):
    spark = fact.sparkSession
    words = spark.createDataFrame([("hot", 2), ("k2", 1), ("k2", 7), (None, 3)], "k string, w long")
    numbers = spark.createDataFrame([(1, "one"), (5, "five")], "v long, t string")
    return spread.star_join(
        fact,
        [
            spread.Lookup(words, {"k": F.col("k")}, "a", lambda row: F.coalesce(row["w"], F.lit(-1)), False),
            spread.Lookup(numbers, {"v": F.col("v")}, "b", lambda row: row["t"], True),
            spread.Lookup(numbers, {"v": F.col("v") + 1}, "c", lambda row: F.concat(row["t"], F.col("wide")), False),
        ],
    )


@pytest.mark.parametrize("table", [True, False])
def test_star_join_with_several_large_lookups(spark, table):
    fact = skewed(spark).withColumn("wide", F.concat(F.lit("w"), F.col("v")))
    fact = stored(fact, "fact") if table else fact
    assert spread._is_table(fact.drop("none")) == table
    out = star_of_three(fact)
    assert out.columns == ["k", "v", "wide", "a", "b", "c"]
    # a key with two rows gives two, as by a join
    w, t = {"hot": [2], "k2": [1, 7]}, {1: "one", 5: "five"}
    expected = Counter(
        (k, v, wide, a, t.get(v), t[v + 1] + wide if v + 1 in t else None)
        for k, v, wide in fact.collect()
        for a in w.get(k, [-1])
    )
    assert Counter(tuple(row) for row in out.collect()) == expected
    assert star_of_three(fact.limit(0)).count() == 0


def test_whole_rows_are_shuffled_once_for_several_large_lookups(spark):
    fact = stored(skewed(spark).withColumn("wide", F.lit("w" * 50)), "fact")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    numbers = spark.createDataFrame([(1, "one"), (5, "five")], "v long, t string")
    lookups = [
        spread.Lookup(numbers, {"v": F.col("v") + more}, name, lambda row: row["t"], False)
        for more, name in enumerate("abc")
    ]
    try:
        plan = spread.star_join(fact, lookups)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    def shuffled(node):
        found = [node.output().mkString(",")] if node.nodeName() == "Exchange" else []
        children = node.children()
        return found + [out for at in range(children.size()) for out in shuffled(children.apply(at))]

    assert sum("wide#" in columns for columns in shuffled(plan)) == 1


def test_rows_of_a_filter_or_of_chance_are_no_table(spark):
    table = stored(spark.range(9), "t")
    assert spread._is_table(table.select((F.col("id") + 1).alias("n")))
    assert not spread._is_table(table.where("id > 3"))
    assert not spread._is_table(table.withColumn("r", F.rand()))
    assert not spread._is_table(table.join(table.withColumnRenamed("id", "n")))


def test_scratch_tables_are_packed_small(spark):
    tables = [stored(spark.range(3), "t"), stored_with_size(spark.range(3), "t")[0]]
    tables.append(dense_key(spark.range(3), "key", ["id"]))
    for table in tables:
        assert all(name.endswith(".zstd.parquet") for name in table.inputFiles())
