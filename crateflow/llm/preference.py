"""Preference formatting: a shared prompt and two masked completions per pair.

Built from DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateflow.plans.dense_key import dense_key

TURN = "struct<turn:bigint,role:string,text:string>"


def rendered(turn: Column) -> Column:
    """One turn as text; a null role or text is empty."""
    return F.concat(
        F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"),
        F.coalesce(turn["text"], F.lit("")), F.lit("\n"),
    )


def rendered_all(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def loss_spans(turns: Column) -> Column:
    """Spans of the completion that count in the loss, as ``start:end`` in characters.

    They are the texts of assistant turns with their closing line break; headers
    and the turns of others are masked out.
    """
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + F.length(F.coalesce(turn["role"], F.lit(""))) + 5
        end = start + F.length(F.coalesce(turn["text"], F.lit(""))) + 1
        span = F.concat_ws(":", start.cast("string"), end.cast("string"))
        own = F.when(turn["role"] == "assistant", F.array(span)).otherwise(F.array().cast("array<string>"))
        return F.struct(end.alias("at"), F.concat(state["spans"], own).alias("spans"))

    return F.aggregate(turns, zero, step)["spans"]


def common_prefix(chosen: Column, rejected: Column) -> Column:
    """Number of leading turns with equal role and text; null equals null."""
    same = F.zip_with(
        chosen, rejected,
        lambda c, r: c.isNotNull() & r.isNotNull()
        & c["role"].eqNullSafe(r["role"]) & c["text"].eqNullSafe(r["text"]),
    )
    stop = F.array_position(same, False)
    return F.when(stop > 0, stop - 1).otherwise(F.size(same)).cast("int")


def format_preferences(pairs: DataFrame) -> DataFrame:
    """One row per pair from ``pair_id, chosen, rejected`` (arrays of turns).

    ``n_prompt_turns``, ``prompt`` (the longest common turn prefix, rendered
    once), and for both sides the completion and the spans of it that count in
    the loss. A null conversation is an empty one. Two equal conversations are
    all prompt, with empty completions; conversations that differ at once have
    an empty prompt. Repeated pairs give a row each.
    """
    empty = F.array().cast(f"array<{TURN}>")
    sides = pairs.select(
        "pair_id",
        F.coalesce("chosen", empty).alias("_chosen"),
        F.coalesce("rejected", empty).alias("_rejected"),
    ).withColumn("n_prompt_turns", common_prefix(F.col("_chosen"), F.col("_rejected")))

    def rest(name: str) -> Column:
        turns = F.col(name)
        return F.slice(turns, F.col("n_prompt_turns") + 1, F.size(turns))

    return sides.select(
        "pair_id",
        "n_prompt_turns",
        rendered_all(F.slice("_chosen", F.lit(1), F.col("n_prompt_turns"))).alias("prompt"),
        rendered_all(rest("_chosen")).alias("chosen_completion"),
        F.array_join(loss_spans(rest("_chosen")), ",").alias("chosen_loss"),
        rendered_all(rest("_rejected")).alias("rejected_completion"),
        F.array_join(loss_spans(rest("_rejected")), ",").alias("rejected_loss"),
    )


def gather_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns of a conversation in order.

    Order is turn, role, text, so ties and repeated turns have one place; a
    repeated row is a repeated turn. A null turn number comes first. Rows
    without a conversation id belong to none and are left out. One conversation
    becomes one training row, so its turns must fit one row.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), "role", "text")
    return (
        conversations.where(F.col("conv_id").isNotNull())
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    )


def answer_pairs(conversations: DataFrame, unpaired: bool = False) -> DataFrame:
    """Preference pairs from plain conversations.

    Chosen is the conversation up to its last assistant turn; later turns are cut.
    Rejected keeps the turns before it and answers with the last assistant text of
    the partner: the next conversation with an assistant turn in order of ids, and
    for the last of them the first. A conversation without an assistant turn gives
    no pair. One that is the only one with such a turn has no partner: it gives
    none either, or with ``unpaired`` one whose rejected side has no answer.
    """
    turns = gather_turns(conversations)
    last = F.array_max(F.transform(
        "turns", lambda t, i: F.when(t["role"] == "assistant", i + 1)
    ))
    turns = dense_key(turns.withColumn("last", last).where("last is not null"), "place", ["conv_id"])
    total = turns.count()
    # The answer of a place serves the one before it.
    answer = turns.select(
        F.when(F.col("place") == 1, total).otherwise(F.col("place") - 1).alias("place"),
        F.element_at("turns", F.col("last"))["text"].alias("other"),
        F.lit(True).alias("paired"),
    ).where(F.lit(total > 1))
    swapped = F.struct(
        F.element_at("turns", F.col("last"))["turn"].alias("turn"),
        F.lit("assistant").alias("role"), F.col("other").alias("text"),
    )
    own = F.when(F.col("paired"), F.array(swapped)).otherwise(F.array().cast(f"array<{TURN}>"))
    return turns.join(answer, "place", "left" if unpaired else "inner").select(
        F.col("conv_id").alias("pair_id"),
        F.slice("turns", F.lit(1), F.col("last")).alias("chosen"),
        F.concat(F.slice("turns", F.lit(1), F.col("last") - 1), own).alias("rejected"),
    )


def op4_chat_preference(spark, sf_dir):
    """A preference row for every conversation with an answer, if there are two of them."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return format_preferences(answer_pairs(conversations))


ORACLE_SQL = r"""
WITH ordered AS (
  SELECT conv_id, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), last_answer AS (
  SELECT conv_id, max(place) AS last, arg_max(text, place) AS text
  FROM ordered WHERE role = 'assistant' GROUP BY conv_id
), partners AS (
  SELECT *, coalesce(lead(conv_id) OVER (ORDER BY conv_id), min(conv_id) OVER ()) AS partner FROM last_answer
), pairs AS (
  SELECT a.conv_id, a.last, a.text AS chosen, b.text AS rejected
  FROM partners a JOIN last_answer b ON b.conv_id = a.partner WHERE a.partner <> a.conv_id
), prompt AS (
  SELECT p.conv_id, string_agg('<|' || coalesce(o.role, '') || '|>' || chr(10) || coalesce(o.text, '') || chr(10), '' ORDER BY o.place) AS prompt
  FROM pairs p JOIN ordered o ON o.conv_id = p.conv_id AND (o.place < p.last OR (o.place = p.last AND p.chosen IS NOT DISTINCT FROM p.rejected))
  GROUP BY p.conv_id
), sides AS (
  SELECT p.conv_id AS pair_id, coalesce(q.prompt, '') AS prompt,
    p.chosen IS NOT DISTINCT FROM p.rejected AS same, p.last,
    coalesce(p.chosen, '') AS chosen, coalesce(p.rejected, '') AS rejected
  FROM pairs p LEFT JOIN prompt q ON q.conv_id = p.conv_id
)
SELECT pair_id, CAST(CASE WHEN same THEN last ELSE last - 1 END AS INTEGER) AS n_prompt_turns, prompt,
  CASE WHEN same THEN '' ELSE '<|assistant|>' || chr(10) || chosen || chr(10) END AS chosen_completion,
  CASE WHEN same THEN '' ELSE '14:' || (15 + length(chosen)) END AS chosen_loss,
  CASE WHEN same THEN '' ELSE '<|assistant|>' || chr(10) || rejected || chr(10) END AS rejected_completion,
  CASE WHEN same THEN '' ELSE '14:' || (15 + length(rejected)) END AS rejected_loss
FROM sides
"""
