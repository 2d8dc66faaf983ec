"""Decisions about documents, carried back to their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateflow.plans.sizing import fits_broadcast
from crateflow.session import stored


def row_key() -> Column:
    """Tells rows of one ``doc_id`` apart by their text."""
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("row_key")


# Smaller than elsewhere: several such tables may be copied in one plan.
BROADCAST_BYTES = 16 << 20


def small(table: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast when its checked size allows."""
    return F.broadcast(table) if fits_broadcast(table, max_bytes=BROADCAST_BYTES) else table


def without(docs: DataFrame, losers: DataFrame) -> DataFrame:
    """``docs`` less the rows of ``losers`` (``doc_id, row_key``, stored); ids may be null.

    The losers are broadcast when their checked size allows, so that texts stay
    in place; beyond that both sides are shuffled.
    """
    loser, key = free_names(docs.columns, "loser", "key")
    losers = losers.select(F.col("doc_id").alias(loser), F.col("row_key").alias(key)).distinct()
    losers = small(losers)
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(loser)) & (
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col(key)
    )
    return docs.join(losers, same, "left_anti")


def free_names(taken: list[str], *names: str) -> list[str]:
    """``names`` with a common end that keeps them apart from the columns of a user, in any case."""
    low, end = {name.lower() for name in taken}, ""
    while any(f"_{name}{end}" in low for name in names):
        end += "_"
    return [f"_{name}{end}" for name in names]


def one_row_each(docs: DataFrame, rows: DataFrame, group: str) -> DataFrame:
    """``docs`` with one row for each ``group``, out of its rows with ``kept``.

    ``rows`` is a stored table with a row per document: ``doc_id``, ``row_key``,
    the group and ``kept``. Several kept rows of one group have one ``doc_id``;
    of these the smallest ``row_key`` stays. A null group is a group of its own
    for each row: all of its rows stay. Rows repeated with id and text are one.
    """
    named = rows.where(F.col(group).isNotNull())
    winners = named.where("kept").groupBy(group).agg(
        F.min("row_key").alias("row_key"), F.first("doc_id").alias("_winner")
    )
    winners = winners.select(F.col("_winner").alias("doc_id"), "row_key")
    same = named["doc_id"].eqNullSafe(winners["doc_id"]) & (named["row_key"] == winners["row_key"])
    losers = stored(named.join(winners, same, "left_anti").select("doc_id", "row_key"), "losers")
    out = without(docs, losers)
    repeated = rows.groupBy("doc_id", "row_key").count().where("count > 1")
    return out if repeated.isEmpty() else out.dropDuplicates(["doc_id", "text"])
