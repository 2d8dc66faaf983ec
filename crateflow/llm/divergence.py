"""How the vocabulary of each source differs from other sources and from its language.

Counts are turned into shares, and two shares into a whole-number divergence that
depends on two counts only. So terms are grouped into cells of equal counts, the
divergence is evaluated once per cell, cells are ranked by the number of terms they
hold, and only terms of the highest cells are looked up again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crateflow.llm.rows import small
from crateflow.llm.words import encoded, parts, slices
from crateflow.session import stored, stored_alone

# A term counts when so many documents of its language have it.
MIN_DOCS = 10
# Terms of a group that are reported.
TOP = 10
# Shares are counted in parts of this.
SCALE = 1_000_000_000
# Distinct terms that a task counts before it hands them on, and pairs of
# sources that it counts at a time.
FLUSH, PAIRS = 200_000, 1_000_000

# A-Z becomes a-z, other bytes below 0x80 but a-z become a space.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
COUNTS = "lang string, source string, term string, n long, docs long"
CELLS = "lang string, source string, other string, n long, m long, terms long"


def terms(text: bytes) -> Iterator[list[bytes]]:
    """Runs of letters, A-Z lower-cased; bytes beyond ASCII are letters."""
    for part in parts(text):
        yield part.translate(_FOLD).split()


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(groups: dict) -> pa.RecordBatch:
        rows = [
            (lang, source, term, number, docs[term])
            for (lang, source), (counts, docs) in groups.items()
            for term, number in counts.items()
        ]
        # A row without a term says that the group occurs.
        rows += [(lang, source, None, 0, 0) for lang, source in groups]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        text, number = (pa.binary(), pa.string()), pa.int64()
        arrays = [pa.array(c, text[0]).cast(text[1]) for c in columns[:3]]
        arrays += [pa.array(c, number) for c in columns[3:]]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "n", "docs"])

    groups: dict = {}
    for batch in slices(batches, "text"):
        names = zip(encoded(batch.column("lang")), encoded(batch.column("source")), strict=True)
        for group, text in zip(names, encoded(batch.column("text")), strict=True):
            counts, docs = groups.setdefault(group, (Counter(), Counter()))
            seen: set[bytes] = set()
            for found in terms(text):
                counts.update(found)
                seen.update(found)
            docs.update(seen)
        if sum(len(counts) for counts, _ in groups.values()) > FLUSH:
            yield batch_of(groups)
            groups = {}
    yield batch_of(groups)


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, term, n, total, first``: kept terms by group.

    ``n`` counts occurrences in the group, ``total`` in the language; one row of each
    term has ``first``. A group also has a row without a term, so that one without
    kept terms is there. Terms are counted in tasks before the one shuffle, by
    (lang, term); a term holds at most a row per group from there on.
    """
    rows = docs.select("text", "lang", "source").mapInArrow(_count, COUNTS).repartition("lang", "term")
    counts = rows.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term")
    return (
        counts.withColumn("total", F.sum("n").over(same))
        .withColumn("in_docs", F.sum("docs").over(same))
        .withColumn("first", F.row_number().over(same.orderBy("source")) == 1)
        .where(F.col("term").isNull() | (F.col("in_docs") >= min_docs))
        .select("lang", "source", "term", "n", "total", "first")
    )


def group_totals(kept: DataFrame) -> DataFrame:
    """``lang, source, n_group, n_lang, v``: sums over kept terms, and how many the language has."""
    named = F.col("term").isNotNull()
    groups = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("n_group"), F.count_if(named & F.col("first")).alias("firsts")
    )
    langs = groups.groupBy("lang").agg(F.sum("n_group").alias("n_lang"), F.sum("firsts").alias("v"))
    return groups.drop("firsts").join(small(langs), "lang")


def share(count: Column, total: Column, v: Column) -> Column:
    """``1 + floor(SCALE * (count + 2) / (total + 2 * v))``, exact at any size."""
    parts_ = (count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", parts_, (total + 2 * v).cast("decimal(20,0)")) + 1


def divergence(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))``; both are at most ``SCALE + 1``, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _cells_of_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many terms have the counts ``n`` in one source and ``m`` in another, both above 0.

    A row holds the sources of a term, in order. Entries that lie one, two, three ...
    places apart in a row are compared at once.
    """
    columns = ["lang", "source", "other", "n", "m"]
    for batch in batches:
        groups = batch.column("groups")
        flat = groups.flatten()
        lengths = np.diff(groups.offsets.to_numpy())
        row = np.repeat(np.arange(len(lengths)), lengths)
        langs = batch.column("lang").dictionary_encode()
        sources = flat.field("source").dictionary_encode()
        lang = langs.indices.to_numpy()[row]
        source, n = sources.indices.to_numpy(), flat.field("n").to_numpy()
        held, size = [], 0
        for step in range(1, int(lengths.max(initial=0)) + 1):
            a = np.flatnonzero(row[:-step] == row[step:])
            b = a + step
            held.append(pd.DataFrame({"lang": lang[a], "source": source[a], "other": source[b], "n": n[a], "m": n[b]}))
            size += len(a)
            if held and (size > PAIRS or not len(a)):
                cells = pd.concat(held).groupby(columns, sort=False).size().reset_index(name="terms")
                held, size = [], 0
                yield pa.RecordBatch.from_arrays(
                    [
                        langs.dictionary.take(pa.array(cells["lang"])),
                        sources.dictionary.take(pa.array(cells["source"])),
                        sources.dictionary.take(pa.array(cells["other"])),
                        *[pa.array(cells[c], pa.int64()) for c in ("n", "m", "terms")],
                    ],
                    [*columns, "terms"],
                )


def pair_ranks(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, source, item, value, rank``: every other source of the language.

    A sum over all kept terms is taken apart by what a pair has in common. Terms
    that neither has are worth the same each. Those of one source are cells of its
    own counts, whatever the other holds; those of both are cells of two counts, and
    replace what was added for each alone.
    """
    named = kept.where("term is not null")
    own = named.groupBy("lang", "source", "n").agg(F.count("*").alias("terms"))
    own = stored(own, "own-cells")
    rows = named.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("groups"))
    both = rows.where(F.size("groups") > 1).select("lang", "groups").mapInArrow(_cells_of_pairs, CELLS)
    both = both.groupBy("lang", "source", "other", "n", "m").agg(F.sum("terms").alias("terms"))

    one = totals.select("lang", "source", "v", F.col("n_group").alias("total"))
    two = totals.select("lang", F.col("source").alias("other"), F.col("n_group").alias("total_other"))
    v, zero = F.col("v"), F.lit(0).cast("long")
    none = share(zero, F.col("total"), v), share(zero, F.col("total_other"), v)
    p, q = share(F.col("n"), F.col("total"), v), share(F.col("m"), F.col("total_other"), v)
    neither = divergence(*none)

    pairs = one.join(small(two), "lang").where("source <> other")
    base = pairs.select("lang", "source", "other", F.when(v > 0, v * neither).otherwise(zero).alias("value"))
    alone = own.join(small(one), ["lang", "source"]).join(small(two), "lang").where("source <> other")
    alone = alone.select(
        "lang", "source", "other", (F.col("terms") * (divergence(p, none[1]) - neither)).alias("value")
    )
    shared = both.join(small(one), ["lang", "source"]).join(small(two), ["lang", "other"])
    shared = shared.select(
        "lang", "source", "other",
        (F.col("terms") * (divergence(p, q) - divergence(p, none[1]) - divergence(none[0], q) + neither)).alias("value"),
    )
    # Sums for one order of a pair hold for the other too.
    once = alone.union(shared).groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    turned = once.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value")
    sums = base.union(once).union(turned).groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other")
    return sums.select("lang", "source", F.col("other").alias("item"), "value", F.row_number().over(order).alias("rank"))


def term_ranks(kept: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, source, item, value, rank``: terms of a group with a larger share than in the language.

    Cells of equal value are merged; the values that the first ``top`` terms can have
    follow from the number of terms above them, and only cells of these values are
    expanded. Both cuts to ``top`` are taken in each task before rows are shuffled.
    """
    named = kept.where("term is not null")
    cells = named.groupBy("lang", "source", "n", "total").agg(F.count("*").alias("terms"))
    p = share(F.col("n"), F.col("n_group"), F.col("v"))
    q = share(F.col("total"), F.col("n_lang"), F.col("v"))
    cells = cells.join(small(totals), ["lang", "source"]).withColumns({"p": p, "q": q}).where("p > q")
    cells = stored(
        cells.select("lang", "source", "n", "total", "terms", divergence(F.col("p"), F.col("q")).alias("value")),
        "cells",
    )
    group = Window.partitionBy("lang", "source")
    values = cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
    values = values.withColumn("place", F.row_number().over(group.orderBy(F.desc("value")))).where(F.col("place") <= top)
    above = F.sum("terms").over(group.orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1))
    values = values.withColumn("above", F.coalesce(above, F.lit(0))).where(F.col("above") < top)
    wanted = cells.join(values.select("lang", "source", "value"), ["lang", "source", "value"])
    wanted = stored(wanted.select("lang", "source", "n", "total", "value"), "wanted-cells")
    found = named.join(small(wanted), ["lang", "source", "n", "total"])
    order = group.orderBy(F.desc("value"), "term")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", "source", F.col("term").alias("item"), "value", "rank")


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: sources and terms by divergence.

    ``docs`` has ``text, lang, source``; other columns are not read, and null is an
    empty string. Every row is a document, repeated rows too. Terms are runs of
    letters with A-Z lower-cased, kept when at least ``min_docs`` documents of the
    language have them. Part ``pair`` compares each source with every other source
    of its language over all kept terms (0 without any); part ``term`` gives the
    ``top`` kept terms that a group uses more than its language. Ranks count from 1,
    highest value first, equal values in UTF-8 order of the item. Very long texts
    are read in parts. An empty table gives an empty result.

    The number of rows follows from the sources: a pair of them is a row.
    """
    return stored_alone(docs.sparkSession, "divergence", lambda: _source_divergence(docs, min_docs, top))


def _source_divergence(docs: DataFrame, min_docs: int, top: int) -> DataFrame:
    kept = stored(term_counts(docs, min_docs), "kept-terms")
    totals = stored(group_totals(kept), "group-totals")
    pairs = pair_ranks(kept, totals).withColumn("part", F.lit("pair"))
    ranks = term_ranks(kept, totals, top).withColumn("part", F.lit("term"))
    return pairs.unionByName(ranks).select("lang", "source", "part", "item", "value", "rank")


def op11_source_divergence(spark, sf_dir):
    """Sources and terms of all documents by divergence."""
    return source_divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH texts AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(words)) AS term FROM texts)
  GROUP BY lang, term HAVING count(*) >= 10
), occurring AS (
  SELECT DISTINCT lang, source FROM texts
), counted AS (
  SELECT lang, source, term, count(*) AS n
  FROM (SELECT lang, source, unnest(words) AS term FROM texts) JOIN kept USING (lang, term)
  GROUP BY lang, source, term
), filled AS (
  SELECT o.lang, o.source, k.term, coalesce(c.n, 0)::HUGEINT AS n
  FROM occurring o JOIN kept k ON k.lang = o.lang
  LEFT JOIN counted c ON c.lang = o.lang AND c.source = o.source AND c.term = k.term
), sizes AS (
  SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang
), groups AS (
  SELECT f.lang, f.source, f.term, f.n,
    1 + (1000000000 * (f.n + 2)) // (sum(f.n) OVER (PARTITION BY f.lang, f.source) + 2 * s.v) AS p
  FROM filled f JOIN sizes s ON s.lang = f.lang
), langs AS (
  SELECT t.lang, t.term,
    1 + (1000000000 * (t.n + 2)) // (sum(t.n) OVER (PARTITION BY t.lang) + 2 * s.v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM filled GROUP BY lang, term) t JOIN sizes s ON s.lang = t.lang
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
  FROM occurring a JOIN occurring b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT g.lang, g.source, h.source AS item, sum(((g.p - h.p) * (g.p - h.p)) // (g.p + h.p)) AS value
    FROM groups g JOIN groups h ON g.lang = h.lang AND g.term = h.term AND g.source <> h.source
    GROUP BY g.lang, g.source, h.source
  ) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), found AS (
  SELECT g.lang, g.source, g.term AS item, ((g.p - l.q) * (g.p - l.q)) // (g.p + l.q) AS value
  FROM groups g JOIN langs l ON g.lang = l.lang AND g.term = l.term
  WHERE g.n > 0 AND g.p > l.q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT * FROM (
    SELECT lang, source, 'term' AS part, item, value,
      row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM found
  ) WHERE rank <= 10
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
"""
