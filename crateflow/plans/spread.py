"""Joins whose work stays even when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateflow.plans import sizing
from crateflow.plans.sizing import fits_broadcast, fits_hashing, stored_measured
from crateflow.session import stored

# Bins of key hashes for each shuffle partition, when frequent keys are looked for.
_BINS = 64
# Bits of a row number within its file, and of the place of a row within a block of rows.
_ROW_BITS, _BLOCK_BITS = 40, 8


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    condition: Column | None = None,
    right_fits: bool | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Join on equal ``on`` columns (and ``condition``); right keys are dropped.

    ``right`` is broadcast when its checked size allows. Beyond that both sides
    are shuffled; keys that hold more rows of ``left`` than one partition should
    take are split into as many salts as they fill partitions, and only their
    ``right`` rows are copied, once per salt. ``how`` is ``left`` or ``inner``.

    ``keys_from`` is a cheaper frame with the ``on`` columns of ``left``: the
    table a chain of lookups started from saves running the chain to find its
    frequent keys.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how={how!r}: left rows are split, so only left and inner hold")
    _same_types(left, right, on)
    right = right.withColumnsRenamed({name: f"_r_{name}" for name in on})
    tests = [F.col(name) == F.col(f"_r_{name}") for name in on]
    if condition is not None:
        tests.append(condition)
    match = reduce(Column.__and__, tests)
    drop = [f"_r_{name}" for name in on]

    if right_fits is None:
        right_fits = fits_broadcast(right)
    if right_fits:
        return left.join(F.broadcast(right), match, how).drop(*drop)

    hot = _hot_keys(left if keys_from is None else keys_from, on)
    keys = {f"_r_{name}": F.col(name) for name in on}
    return _shuffled(left, right, keys, match, how, hot).drop(*drop)


@dataclass(frozen=True)
class Lookup:
    """One row of ``table`` at most for each row that looks, and what comes of it.

    ``on`` gives for each key column of ``table`` its value in the looking row;
    ``found`` makes the new column ``name`` from the other columns of ``table``
    as a struct, NULL where there is no match.
    """

    table: DataFrame
    on: dict[str, Column]
    name: str
    found: Callable[[Column], Column]
    fits: bool | None = None


def star_join(
    fact: DataFrame, lookups: list[Lookup], keys_from: DataFrame | None = None
) -> DataFrame:
    """``fact`` with the new column of every lookup; its rows stay as they are.

    Each lookup table is stored once, which also tells its size: one that fits
    is broadcast. For those that do not, the frequent keys of all of them come
    from one pass over ``fact``, and both sides are shuffled as in
    ``spread_join``; if there are several, only the columns they look at are, and
    whole rows just once (``_looked_up``). ``keys_from`` is a cheaper frame with
    the columns that the keys are made of.
    """
    sides, large = [], []
    for at, lookup in enumerate(lookups):
        keys = {f"_k{at}_{name}": value for name, value in lookup.on.items()}
        rest = [F.col(name) for name in lookup.table.columns if name not in lookup.on]
        table = lookup.table.select(
            *[F.col(name).alias(f"_k{at}_{name}") for name in lookup.on], F.struct(*rest).alias("_found")
        )
        _same_types(fact.select(*[v.alias(k) for k, v in keys.items()]), table, list(keys))
        table, rows, size = stored_measured(table, "lookup")
        fits = lookup.fits
        if fits is None and size is None:
            fits = fits_broadcast(table)
        elif fits is None:
            fits = rows <= sizing.BROADCAST_ROWS and size <= sizing.BROADCAST_BYTES
        sides.append((table, keys, fits, size is not None and fits_hashing(table.sparkSession, size)))
        if not fits:
            large.append(at)
    seen = fact if keys_from is None else keys_from
    hot = dict(zip(large, _frequent(seen, [list(sides[at][1].values()) for at in large]), strict=True))

    def look(df: DataFrame, at: int) -> DataFrame:
        lookup, (table, keys, fits, hashed) = lookups[at], sides[at]
        match = reduce(Column.__and__, [value == F.col(name) for name, value in keys.items()])
        if fits:
            joined = df.join(F.broadcast(table), match, "left")
        else:
            joined = _shuffled(df, table, keys, match, "left", hot[at], hashed)
        return joined.withColumn(lookup.name, lookup.found(F.col("_found"))).drop(*keys, "_found")

    several = large if len(large) > 1 else []
    columns = [*fact.columns, *(lookup.name for lookup in lookups)]
    if several:
        fact = _looked_up(fact, {lookups[at].name: lambda df, at=at: look(df, at) for at in several})
    for at in range(len(lookups)):
        if at not in several:
            fact = look(fact, at)
    return fact.select(*columns)


def _looked_up(fact: DataFrame, looks: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """``fact`` with the columns that ``looks`` add, each by a shuffle, its rows shuffled whole only once.

    A row is known by its file and its number there, which hold however the files
    are read. Each look takes the number and what else it needs, and its results
    come back to blocks of numbers, which whole rows meet by their block. That
    spreads evenly whatever the keys are.
    """
    if not _is_table(fact):
        fact = stored(fact, "fact")
    place = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row")]
    spark, rows = fact.sparkSession, fact.count()
    paths = sorted(row[0] for row in fact.select(*place).select("_path").distinct().collect())
    files = spark.createDataFrame(list(enumerate(paths)), "_file long, _path string")
    number = F.shiftleft("_file", _ROW_BITS).bitwiseOR(F.col("_row")).alias("_fact_row")
    fact = numbered = fact.select("*", *place).join(F.broadcast(files), "_path").select(*fact.columns, number)
    at = F.col("_fact_row").bitwiseAND((1 << _BLOCK_BITS) - 1).cast("int")
    block = F.shiftright("_fact_row", _BLOCK_BITS)
    # a place and a value take up to 32 bytes in the list of a block
    hashed = fits_hashing(spark, rows * 32 * len(looks))
    for name, look in looks.items():
        found = look(numbered).select(block.alias("_block"), at.alias("_at"), F.col(name).alias("_value"))
        listed = found.repartition("_block").groupBy("_block").agg(_by_place().alias("_list"))
        joined = fact.join(listed.hint("shuffle_hash") if hashed else listed, block == F.col("_block"), "left")
        # as many rows as the lookup has found
        fact = joined.select(*fact.columns, F.explode(F.get("_list", at)).alias(name))
    return fact.drop("_fact_row")


def _by_place() -> Column:
    """Values of a block as an array for each place, which has one unless a row has found several."""
    pairs = F.sort_array(F.collect_list(F.struct("_at", "_value")))

    def values(at: Column) -> Column:
        return F.transform(F.filter(pairs, lambda pair: pair["_at"] == at), lambda pair: pair["_value"])

    last = F.element_at(pairs, -1)["_at"]
    single = F.transform(pairs, lambda pair: F.array(pair["_value"]))
    return F.when(last == F.size(pairs) - 1, single).otherwise(F.transform(F.sequence(F.lit(0), last), values))


def _is_table(df: DataFrame) -> bool:
    """Whether ``df`` has the rows of Parquet files as they are, whatever its columns."""
    plan = df._jdf.queryExecution().analyzed()
    fixed = plan.deterministic()
    while plan.nodeName() == "Project":
        plan = plan.child()
    return fixed and plan.nodeName() == "LogicalRelation" and plan.simpleString(0).lower().endswith("parquet")


def _shuffled(
    left: DataFrame,
    right: DataFrame,
    keys: dict[str, Column],
    match: Column,
    how: str,
    hot: DataFrame | None,
    hashed: bool = False,
) -> DataFrame:
    """Join by a shuffle of both sides; ``keys`` says what a right column equals on the left.

    With ``hashed`` a hash table of each partition of ``right`` is made, so rows of
    ``left``, however wide, are not sorted.
    """
    if hot is None:
        return left.join(right.hint("shuffle_hash") if hashed else right, match, how)
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    # The partition id takes part so that copies of one row spread too. A row
    # keeps its partition when a task is run again, so the salt is repeatable.
    row_hash = F.xxhash64(*(["_fact_row"] if "_fact_row" in left.columns else left.columns), F.spark_partition_id())
    salted_left = (
        left.withColumn("_h", F.xxhash64(*keys.values()))
        .join(F.broadcast(hot), "_h", "left")
        .withColumn("_salt", F.pmod(row_hash, salts))
        .drop("_h", "_salts")
    )
    salted_right = (
        right.withColumn("_h", F.xxhash64(*keys))
        .join(F.broadcast(hot), "_h", "left")
        .withColumn("_r_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
        .drop("_h", "_salts")
    )
    salted = match & (F.col("_salt") == F.col("_r_salt"))
    if hashed:
        salted_right = salted_right.hint("shuffle_hash")
    return salted_left.join(salted_right, salted, how).drop("_salt", "_r_salt")


def _hot_keys(left: DataFrame, on: list[str]) -> DataFrame | None:
    """Key hashes and the number of salts each needs, or None when all are small."""
    return _frequent(left, [[F.col(name) for name in on]])[0]


def _frequent(left: DataFrame, keys: list[list[Column]]) -> list[DataFrame | None]:
    """``_hot_keys`` for several keys of one table, mostly from one pass over it.

    A key is worth splitting when it would fill more than one shuffle partition,
    so there are fewer such keys than partitions: the list needs no other bound.
    Counts of every key would be as large as the table where keys are nearly
    unique, so rows are first counted per bin of key hashes, some bins for each
    partition. Only a bin that is itself too large can hold such a key. If all
    its rows have one hash, its count is that of the key; the keys of other
    large bins are counted exactly in a second pass. The list is read on the
    driver because both join sides must see the very same one.
    """
    if not keys:
        return []
    spark = left.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    each = [F.struct(F.lit(at).alias("_at"), F.xxhash64(*key).alias("_h")) for at, key in enumerate(keys)]
    rows = left.select(F.explode(F.array(*each)).alias("_k")).select("_k._at", "_k._h")
    rows = rows.withColumn("_bin", F.pmod("_h", F.lit(parts * _BINS)))
    one = (F.min("_h") == F.max("_h")).alias("_one")
    bins = stored(
        rows.groupBy("_at", "_bin").agg(F.count("*").alias("count"), F.min("_h").alias("_h"), one), "key-counts"
    )
    # every key list counts every row, so the first tells how many there are
    total = bins.where("_at = 0").agg(F.sum("count")).first()[0] or 0
    too_many = F.col("count") * parts > total
    large = bins.where(too_many).collect()
    counts = [(row["_at"], row["_h"], row["count"]) for row in large if row["_one"]]
    mixed = [(row["_at"], row["_bin"]) for row in large if not row["_one"]]
    if mixed:
        listed = F.broadcast(spark.createDataFrame(mixed, "_at int, _bin long"))
        again = rows.join(listed, ["_at", "_bin"], "left_semi").groupBy("_at", "_h").count()
        counts += [tuple(row) for row in again.where(too_many).collect()]
    lists: list[list] = [[] for _ in keys]
    for at, key_hash, count in counts:
        lists[at].append((key_hash, -(-count * parts // total)))
    return [spark.createDataFrame(found, "_h long, _salts long") if found else None for found in lists]


def _same_types(left: DataFrame, right: DataFrame, on: list[str]) -> None:
    """The salt list works on key hashes, and equal numbers of different types hash apart."""
    for name in on:
        ours, theirs = left.schema[name].dataType, right.schema[name].dataType
        if ours != theirs:
            raise TypeError(f"join column {name!r}: {ours.simpleString()} and {theirs.simpleString()}")
