"""Promotions reach sales through a rule, not a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateflow.functions.columns import packed_list, share
from crateflow.plans.sizing import stored_with_size
from crateflow.plans.spread import spread_join
from crateflow.session import stored

# a promotion without a restriction says so with one of these, or with NULL
_ANYWHERE = ("ALL", "")
# Days of the shortest block, blocks in the next longer one, and levels: the longest
# block is longer than the calendar.
_BLOCK_DAYS, _FACTOR, _LEVELS = 32, 8, 7


def promotion_rules(promotions: DataFrame) -> DataFrame:
    """One row per promotion and product it covers.

    A product list that is NULL, empty or ``ALL`` restricts nothing, as with
    channel and region: such a promotion is one row with a NULL product.
    """
    items = F.filter(packed_list("applicable_products"), lambda item: F.upper(item) != "ALL")
    everything = F.exists(packed_list("applicable_products"), lambda item: F.upper(item) == "ALL")
    listed = F.when(~everything, items)
    return promotions.select(
        F.explode_outer(listed).alias("product_id"),
        "promotion_id",
        "target_channel",
        "target_region",
        "start_date",
        "end_date",
    )


def _cover(rules: DataFrame, first: Column) -> DataFrame:
    """Rules once per aligned block of days that their period is made of.

    Blocks of one level are 8 times as long as those of the level below. A
    block is taken when it lies within the period and the longer one around it
    does not, so blocks do not overlap and a period of any length takes at most
    14 of each level: one up to the year 9999 is some tens of rows. The shortest
    blocks reach over the ends of a period, so days are still to be tested. A
    rule without dates has no block.
    """
    begin = _block(first, 0)
    end = _block(F.col("end_date"), 0) + 1
    pieces = []
    for level in range(_LEVELS):
        low, high = F.ceil(begin / F.lit(_FACTOR**level)), F.floor(end / F.lit(_FACTOR**level))
        left = right = high
        if level + 1 < _LEVELS:
            above = F.lit(_FACTOR ** (level + 1))
            inner_low, inner_high = F.ceil(begin / above), F.floor(end / above)
            left = F.when(inner_low < inner_high, inner_low * _FACTOR).otherwise(high)
            right = F.when(inner_low < inner_high, inner_high * _FACTOR).otherwise(high)
        pieces.append(_blocks(level, low, left))
        pieces.append(_blocks(level, right, high))
    taken = F.when(first <= F.col("end_date"), F.flatten(F.array(*pieces)))
    return rules.withColumn("_at", F.explode(taken)).select(*rules.columns, "_at._level", "_at._block")


def _block(day: Column, level: int) -> Column:
    return F.floor(F.unix_date(day) / F.lit(_BLOCK_DAYS * _FACTOR**level))


def _blocks(level: int, low: Column, high: Column) -> Column:
    """The blocks of a level from ``low`` to before ``high``."""
    numbers = F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(numbers, lambda n: F.struct(F.lit(level).alias("_level"), n.alias("_block")))


def _in_blocks(sales: DataFrame, levels: list[int]) -> DataFrame:
    """Sales once per level, with the block of their day."""
    day = F.col("order_date")
    if len(levels) < 2:
        level = (levels or [0])[0]
        own = {"_level": F.lit(level), "_block": _block(day, level)}
        return sales.select(*sales.columns, *[value.alias(name) for name, value in own.items()])
    own = [F.struct(F.lit(n).alias("_level"), _block(day, n).alias("_block")) for n in levels]
    return sales.withColumn("_at", F.explode(F.array(*own))).select(*sales.columns, "_at._level", "_at._block")


def _on_ruled_days(sales: DataFrame, days: DataFrame) -> DataFrame:
    """Sales in blocks, without those of days that no rule of ``days`` covers.

    ``days`` has a row for each block that occurs among the rules, with the first
    and the last day in it that any of them covers, so it is bounded by the calendar.
    """
    at = {"_level": "_on_level", "_block": "_on_block"}
    equal = [F.col(name) == F.col(other) for name, other in at.items()]
    known = F.broadcast(days.select(*[F.col(old).alias(new) for old, new in at.items()], "_from", "_to"))
    return sales.join(known, [*equal, F.col("order_date").between(F.col("_from"), F.col("_to"))], "left_semi")


def _in_period(sales: DataFrame, rules: DataFrame, first: Column, daily: bool = False) -> DataFrame:
    """Sales with the rules in scope of their day; ``first`` opens the period.

    Both meet by (product, block of days), so a product does not pair its sales
    with every promotion it ever had. A sale looks on the levels that occur
    among the rules, mostly one, and finds a rule once; one on a day without a
    rule is left out before anything is shuffled by product. Rules for all
    products go another way and meet sales by block. With ``daily`` the sales
    are added up first, per product and day, or per day for the second way.
    """
    kept = stored(_cover(rules, first), "rules")
    days = stored(
        kept.groupBy(F.isnull("product_id").alias("_open"), "_level", "_block").agg(
            F.min(first).alias("_from"), F.max("end_date").alias("_to")
        ),
        "ruled-days",
    )
    # a row per level and kind of rule
    seen = days.select("_open", "_level").distinct().collect()
    listed, open_days = days.where("NOT _open"), days.where("_open")
    some, fits = stored_with_size(kept.where("product_id IS NOT NULL"), "listed-rules")
    asked = _on_ruled_days(_in_blocks(sales, sorted({row["_level"] for row in seen})), days)
    if daily:
        asked = daily_sales(asked, "_level", "_block")
    if daily or not fits or any(row["_open"] for row in seen):
        # one pass over the sales for frequent keys and both kinds of rules
        asked = stored(asked, "asked")
    scope = _in_scope("order_date", first)
    found = spread_join(
        _on_ruled_days(asked, listed), some, ["product_id", "_level", "_block"], "inner", scope, right_fits=fits
    )
    if not any(row["_open"] for row in seen):
        return found
    every, fits = stored_with_size(kept.where("product_id IS NULL").drop("product_id"), "open-rules")
    asked = _on_ruled_days(asked, open_days)
    asked = _all_products(asked, "_level", "_block") if daily else asked
    by_block = spread_join(asked, every, ["_level", "_block"], "inner", scope, right_fits=fits)
    return found.unionByName(by_block, allowMissingColumns=True)


def _open(target: str) -> Column:
    return F.col(target).isNull() | F.col(target).isin(*_ANYWHERE)


def _open_or_equal(target: str, value: str) -> Column:
    return _open(target) | (F.col(target) == F.col(value))


def _in_place() -> Column:
    return _open_or_equal("target_channel", "channel") & _open_or_equal("target_region", "region")


def _in_scope(date: str, first: Column) -> Column:
    return F.col(date).between(first, F.col("end_date")) & _in_place()


def promotion_bridge(sales: DataFrame, promotions: DataFrame, line_key: list[str]) -> DataFrame:
    """Pairs of order line and promotion that applies to it.

    A line may fall under several promotions, so this is a bridge and not a
    column of the fact. Product and block of days are equal keys; days, channel and
    region are tested on their matches.
    """
    lines = sales.select(
        *dict.fromkeys([*line_key, "product_id", "order_date", "channel", "region", "net_amount"])
    )
    matched = _in_period(lines, promotion_rules(promotions), F.col("start_date"))
    return matched.select(*lines.columns, "promotion_id")


def promotion_sales(sales: DataFrame, promotions: DataFrame) -> DataFrame:
    """Per promotion: revenue of what it covers inside and outside its period.

    Only the inside is matched day by day. The outside is the rest of all
    revenue in scope, whose sums no longer carry a day when they meet the rules,
    so a product with many promotions does not repeat its sales for each.
    """
    rules = stored(promotion_rules(promotions), "rules")
    lines = stored(sales.select("product_id", "order_date", "channel", "region", "net_amount"), "lines")
    inside = _in_period(lines, rules, F.col("start_date"), daily=True)
    totals = stored(
        lines.groupBy("product_id", "channel", "region").agg(_revenue().alias("revenue")), "totals"
    )
    some, fits = stored_with_size(
        rules.where("product_id IS NOT NULL").drop("start_date", "end_date"), "listed-rules"
    )
    listed = spread_join(totals, some, ["product_id"], "inner", _in_place(), right_fits=fits)
    everywhere = listed.select("promotion_id", "revenue").unionByName(_open_totals(totals, rules))
    sums = (
        inside.select("promotion_id", F.col("revenue").alias("_in"), F.lit(None).alias("_all"))
        .unionByName(
            everywhere.select(
                "promotion_id", F.lit(None).alias("_in"), F.col("revenue").alias("_all")
            )
        )
        .groupBy("promotion_id")
        .agg(F.sum("_in").alias("_in"), F.sum("_all").alias("_all"))
    )
    zero = F.lit(0).cast("decimal(28,4)")
    within, overall = F.coalesce("_in", zero), F.coalesce("_all", zero)
    # one row per promotion on both sides: nothing to split, no size to check
    return promotions.select("promotion_id").join(sums, "promotion_id", "left").select(
        "promotion_id",
        within.cast("double").alias("in_period_revenue"),
        (overall - within).cast("double").alias("out_of_period_revenue"),
    )


def _open_totals(totals: DataFrame, rules: DataFrame) -> DataFrame:
    """All revenue in the place of each rule for all products.

    Sums per channel, per region, per both and over all have a key of their own,
    so a rule finds its one sum by an equal key.
    """
    cube = totals.cube("channel", "region").agg(
        F.sum("revenue").cast("decimal(28,4)").alias("revenue"),
        F.grouping("channel").cast("boolean").alias("_any_channel"),
        F.grouping("region").cast("boolean").alias("_any_region"),
    )
    place = {
        "channel": F.when(F.col("_any_channel"), "").otherwise(F.col("channel")),
        "region": F.when(F.col("_any_region"), "").otherwise(F.col("region")),
    }
    every = rules.where("product_id IS NULL").select(
        "promotion_id",
        _open("target_channel").alias("_any_channel"),
        _open("target_region").alias("_any_region"),
        F.when(_open("target_channel"), "").otherwise(F.col("target_channel")).alias("channel"),
        F.when(_open("target_region"), "").otherwise(F.col("target_region")).alias("region"),
    )
    keys = ["_any_channel", "_any_region", "channel", "region"]
    return every.join(cube.withColumns(place), keys).select("promotion_id", "revenue")


def _revenue() -> Column:
    return F.sum(F.col("net_amount").cast("decimal(18,4)")).cast("decimal(28,4)")


def _all_products(daily: DataFrame, *more: str) -> DataFrame:
    """Daily revenue without the product; ``more`` are further columns to keep apart."""
    return daily.groupBy("order_date", "channel", "region", *more).agg(
        F.sum("revenue").cast("decimal(28,4)").alias("revenue")
    )


def daily_sales(sales: DataFrame, *more: str) -> DataFrame:
    """Revenue per product, day, channel and region; ``more`` are further columns to keep apart."""
    return sales.groupBy("product_id", "order_date", "channel", "region", *more).agg(
        _revenue().alias("revenue")
    )


def promotion_uplift(sales: DataFrame, promotions: DataFrame) -> DataFrame:
    """Per promotion: average daily revenue in its period and in the equal span before.

    Days without a sale count as zero. ``uplift_revenue`` is the daily uplift
    times the days, ``roi`` sets it against the actual cost.
    """
    length = F.datediff("end_date", "start_date") + 1
    before = F.date_sub("start_date", F.datediff("end_date", "start_date") + 1)
    matched = _in_period(sales, promotion_rules(promotions), before, daily=True)
    during = F.col("order_date") >= F.col("start_date")
    # One promotion may hold a third of the matches: the sums are partial per
    # task before the shuffle.
    sums = matched.groupBy("promotion_id").agg(
        F.sum(F.when(during, F.col("revenue"))).cast("double").alias("_during"),
        F.sum(F.when(~during, F.col("revenue"))).cast("double").alias("_before"),
    )
    terms = promotions.select("promotion_id", "actual_cost_vnd", length.alias("days"))
    # one row per promotion on both sides: nothing to split, no size to check
    joined = terms.join(sums, "promotion_id", "left")
    in_avg = share(F.coalesce("_during", F.lit(0.0)), F.col("days"))
    before_avg = share(F.coalesce("_before", F.lit(0.0)), F.col("days"))
    total = (in_avg - before_avg) * F.col("days")
    cost = F.col("actual_cost_vnd")
    return joined.select(
        "promotion_id",
        "days",
        in_avg.alias("in_period_daily_revenue"),
        before_avg.alias("before_period_daily_revenue"),
        (in_avg - before_avg).alias("daily_uplift"),
        total.alias("uplift_revenue"),
        share(total - cost, cost).alias("roi"),
    )
