"""As-of lookup: the version of an entity in force on a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crateflow.contracts import UNKNOWN_KEY
from crateflow.plans.spread import Lookup, spread_join, star_join

# Versions that a bucket holds at most or nearly so, as there is one per day at most and
# it is no longer than so many days unless no entity has more versions; and how many it
# is to hold on average. An entity has a row for each bucket its versions touch.
BUCKET_DAYS = 256
_VERSIONS_EACH = 4
# Versions for each bin of entities.
_BIN_VERSIONS = 16


def resolve_asof(
    facts: DataFrame,
    versions: DataFrame,
    by: list[str],
    date: str,
    key: str,
    start: str = "valid_from",
    end: str = "valid_to",
    fits: bool | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Add ``key``: the version that started last on or before ``date``.

    A version that has ended (``date >= end``) gives -1, as does no version at
    all. The number of rows never changes. ``fits`` and ``keys_from`` are as in
    ``star_join``.
    """
    return star_join(facts, [asof_lookup(versions, by, date, key, start, end, fits)], keys_from)


def asof_by_bucket(
    facts: DataFrame,
    versions: DataFrame,
    by: list[str],
    date: str,
    key: str,
    start: str = "valid_from",
    end: str = "valid_to",
) -> DataFrame:
    """``resolve_asof`` for version tables of any size, whatever the skew."""
    return resolve_asof(facts, versions, by, date, key, start, end, fits=False)


def asof_lookup(
    versions: DataFrame,
    by: list[str],
    date: str,
    key: str,
    start: str = "valid_from",
    end: str = "valid_to",
    fits: bool | None = None,
) -> Lookup:
    """The as-of rule as a lookup by equal keys, next to others in ``star_join``.

    Facts and versions meet in (entity, range of days). Each range lists the
    versions in force at some time in it, also one that started long before, so
    a fact needs its own range only. Nothing starts after the last range, so all
    later days share it and a version without an end does not go on for ever.
    The length of a range follows that of the versions, so that a fact looks
    through a few of them and a version stands in a few ranges.
    """
    width, last_day, few = _bucket_days(versions.where(F.col(key) != UNKNOWN_KEY), by, start)
    spans = _spans(_narrow(versions, by, key, start, end, few), by)
    last = last_day // width

    def _bucket(day: Column) -> Column:
        return F.floor(F.unix_date(day) / width).cast("int")

    # the last day, which an end known to be later does not move
    until = F.least(F.coalesce(_bucket(F.date_sub("_stop", 1)), F.lit(last)), F.lit(last))
    buckets = F.explode(F.sequence(_bucket(F.col("_start")), until)).alias("_bucket")
    table = (
        spans.select(*by, buckets, F.struct("_start", "_stop", "_key").alias("_v"))
        .groupBy(*by, "_bucket")
        .agg(F.collect_list("_v").alias("versions"))
    )
    day = F.col(date)
    on = {name: F.col(name) for name in by} | {
        "_bucket": F.when(day.isNotNull(), F.least(_bucket(day), F.lit(last)))
    }

    def found(row: Column) -> Column:
        in_force = F.filter(
            row["versions"], lambda v: (v["_start"] <= day) & (v["_stop"].isNull() | (day < v["_stop"]))
        )
        return F.coalesce(F.get(in_force, 0)["_key"], F.lit(UNKNOWN_KEY).cast("long"))

    return Lookup(table, on, key, found, fits)


def _bucket_days(versions: DataFrame, by: list[str], start: str) -> tuple[int, int, bool]:
    """Days of a bucket, a power of two, the number of the last day on which a version starts,
    and whether each entity is known to have few versions, copies of a day included.

    Entities times days over versions is how long a version lasts on average. A
    bucket is some times as long: an entity then has fewer buckets than versions,
    and few versions in one. The number of entities is estimated; a wrong one
    changes the size of the buckets, not what is found. Versions that last long
    would stand in many short buckets, so theirs may be longer; but then no
    entity may have many versions, which counts per bin of entities tell.
    """
    day = F.unix_date(start)
    entities = F.approx_count_distinct(F.xxhash64(*by))
    known = versions.where(F.col(start).isNotNull())
    first, last, count, several = known.agg(F.min(day), F.max(day), F.count("*"), entities).first()
    if not count:
        return BUCKET_DAYS, 0, False
    wanted = _VERSIONS_EACH * (last - first + 1) * several / count
    few = False
    if wanted > BUCKET_DAYS:
        bins = F.pmod(F.xxhash64(*by), F.lit(max(1, count // _BIN_VERSIONS)))
        most = known.groupBy(bins.alias("_bin")).count().agg(F.max("count")).first()[0]
        few = most <= BUCKET_DAYS
        wanted = wanted if few else BUCKET_DAYS
    width = 1
    while width < wanted:
        width *= 2
    return width, last, few


def _narrow(versions: DataFrame, by: list[str], key: str, start: str, end: str, few: bool) -> DataFrame:
    """One version per entity and start date; of several the highest key counts.

    With ``few`` versions for each entity all are kept, as a window group of ``_spans``
    is small anyway: those that do not count last no day there, and one shuffle is saved.
    """
    known = versions.filter((F.col(key) != UNKNOWN_KEY) & F.col(start).isNotNull())
    if few:
        return known.select(
            *by, F.col(start).alias("_start"), F.col(key).cast("long").alias("_key"), F.col(end).alias("_end")
        )
    return (
        known.groupBy(*by, F.col(start).alias("_start"))
        .agg(F.max(F.struct(F.col(key).alias("key"), F.col(end).alias("end"))).alias("_v"))
        .select(*by, "_start", F.col("_v.key").cast("long").alias("_key"), F.col("_v.end").alias("_end"))
    )


def _spans(narrow: DataFrame, by: list[str]) -> DataFrame:
    """Versions cut where the next one starts, without those that no day falls into."""
    following = F.lead("_start").over(Window.partitionBy(*by).orderBy("_start", "_key", "_end"))
    cut = narrow.withColumn("_next", following).withColumn("_stop", F.least("_end", "_next"))
    return cut.where("_stop IS NULL OR _stop > _start")


def version_attribute(
    facts: DataFrame, versions: DataFrame, key: str, columns: dict[str, str]
) -> DataFrame:
    """Attach columns of the resolved version, ``{column: new name}``."""
    narrow = versions.select(key, *[F.col(old).alias(new) for old, new in columns.items()])
    return spread_join(facts, narrow, [key])
