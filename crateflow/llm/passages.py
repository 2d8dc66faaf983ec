"""Substring dedup: recurring passages found by sharded Aho-Corasick automata.

A window is a run of 20 words. Every window has an anchor, the leftmost of its
six-word runs with the smallest hash, so equal windows have equal anchors.
Windows around anchors that occur once in the corpus cannot recur and are left
alone. The others are cut out as pieces and dealt to shards by anchor. A shard
confirms recurring windows on their words, compiles them into an automaton and
streams its pieces through it, earliest first: every hit but the first of a
window is a repetition.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.llm.rows import BROADCAST_BYTES, row_key, small
from crateflow.llm.words import encoded, hashed, mixed, slices, split_words, window_starts, windows
from crateflow.plans.sizing import fits_broadcast
from crateflow.session import stored, stored_alone

WINDOW, GRAM = 20, 6
GRAMS = WINDOW - GRAM + 1
# Pieces of one anchor that one task takes; of more, each task takes a part.
ANCHOR_PIECES = 20_000
# Pieces in one automaton: bounds its nodes and the words that need a letter.
CHUNK_PIECES = 12_000

ANCHORS = (
    "doc_id long, row_key long, n_words long, words_key binary,"
    " anchors array<long>, starts array<int>, counts array<int>"
)
PIECES = "anchor long, salt int, salts int, doc_id long, row_key long, start int, words binary"
HITS = "doc_id long, row_key long, start int, count int, window binary"


def least_before(values: np.ndarray, length: int) -> np.ndarray:
    """Position of the leftmost smallest value in each run of ``length``."""
    best, at, size = values, np.arange(len(values)), 1

    def joined(best: np.ndarray, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        right = best[step:] < best[:-step]
        return np.where(right, best[step:], best[:-step]), np.where(right, at[step:], at[:-step])

    while size * 2 <= length:
        best, at = joined(best, at, size)
        size *= 2
    if size < length:
        best, at = joined(best, at, length - size)
    return at


def _anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        texts = encoded(batch.column("text"))
        words, ends = split_words(texts)
        keys = [
            hashlib.blake2b(b" ".join(words[a:b]), digest_size=16).digest()
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
        ]
        grams = mixed(windows(hashed(words), GRAM))
        inside = np.flatnonzero(window_starts(ends, WINDOW))
        if len(inside):
            anchor = least_before(grams, GRAMS)[inside]
            doc = np.searchsorted(ends, inside, side="right") - 1
            # Windows of one anchor follow each other.
            new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]))
            values = grams[anchor[new]].view(np.int64)
            starts = (inside[new] - ends[doc[new]]).astype(np.int32)
            counts = np.diff(np.append(new, len(inside))).astype(np.int32)
            cuts = np.searchsorted(doc[new], np.arange(len(texts) + 1)).astype(np.int32)
        else:
            values, starts, counts = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
            cuts = np.zeros(len(texts) + 1, np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x)) for x in (values, starts, counts)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("row_key"), pa.array(np.diff(ends)),
                pa.array(keys, pa.binary()), *lists,
            ],
            ["doc_id", "row_key", "n_words", "words_key", "anchors", "starts", "counts"],
        )


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows = batch.column("cuts").to_pylist()
        texts = [text.split() for text in encoded(batch.column("text"))]
        doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        cuts = [c for r in rows for c in r]
        out = [
            b" ".join(texts[d][c["start"] : c["start"] + c["count"] + WINDOW - 1])
            for d, c in zip(doc.tolist(), cuts, strict=True)
        ]
        take = pa.array(doc)
        column = lambda name, kind: pa.array([c[name] for c in cuts], kind)  # noqa: E731,B023
        yield pa.RecordBatch.from_arrays(
            [
                column("anchor", pa.int64()), column("salt", pa.int32()), column("salts", pa.int32()),
                batch.column("doc_id").take(take), batch.column("row_key").take(take),
                column("start", pa.int32()), pa.array(out, pa.binary()),
            ],
            ["anchor", "salt", "salts", "doc_id", "row_key", "start", "words"],
        )


def lettered(pieces: list[bytes]) -> list[str]:
    """Each piece with one letter per word; equal words have equal letters."""
    known: dict[bytes, int] = {}
    words, ends = split_words(pieces)
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.uint32)
    ids += 1
    ids[ids >= 0xD800] += 0x800  # the gap of the surrogates
    text = ids.astype("<u4").tobytes().decode("utf-32-le")
    return [text[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def located(texts: list[str]) -> Iterator[tuple[int, int, bool]]:
    """(piece, place, seen before) of every occurrence of a recurring window, in order."""
    counts = Counter(t[i : i + WINDOW] for t in texts for i in range(len(t) - WINDOW + 1))
    automaton = ahocorasick.Automaton()
    for window, n in counts.items():
        if n > 1:
            automaton.add_word(window, len(automaton))
    if not len(automaton):
        return
    automaton.make_automaton()
    seen = bytearray(len(automaton))
    for piece, text in enumerate(texts):
        for end, window in automaton.iter(text):
            yield piece, end - WINDOW + 1, bool(seen[window])
            seen[window] = 1


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by anchor and salt, in parts that keep each such group together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        rows = pa.Table.from_batches(held)
        while len(rows) >= CHUNK_PIECES:
            group = np.stack([rows["anchor"].to_numpy(), rows["salt"].to_numpy()])
            edges = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
            edges = edges[edges >= min(CHUNK_PIECES, edges[-1])] if len(edges) else edges
            if not len(edges):
                break
            yield rows.slice(0, int(edges[0]))
            rows = rows.slice(int(edges[0]))
        held = rows.combine_chunks().to_batches() if len(rows) else []
    if held:
        yield pa.Table.from_batches(held)


def _shard(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _chunks(batches):
        # Earliest first; a missing id comes last.
        rows = rows.sort_by([(name, "ascending") for name in ("doc_id", "row_key", "start")])
        pieces = rows["words"].to_pylist()
        texts = lettered(pieces)
        salted = rows["salts"].to_numpy() > 1
        covered = [bytearray(len(t)) for t in texts]
        for piece, place, seen in located(texts):
            covered[piece][place] = seen
        out: list[tuple[int, int, int, bytes | None]] = []
        for piece, flags in enumerate(covered):
            place = flags.find(1)
            while place >= 0:
                end = flags.find(0, place)
                end = len(flags) if end < 0 else end
                out.append((piece, place, end - place, None))
                place = flags.find(1, end)
            if salted[piece]:
                # First here, but another task may hold an earlier one.
                words = pieces[piece].split()
                for place in range(len(words) - WINDOW + 1):
                    if not flags[place]:
                        window = b" ".join(words[place : place + WINDOW])
                        out.append((piece, place, 1, hashlib.blake2b(window, digest_size=16).digest()))
        at = pa.array([o[0] for o in out], pa.int64())
        start = rows["start"].to_numpy()[[o[0] for o in out]] + np.array([o[1] for o in out], np.int32)
        table = pa.table(
            [
                rows["doc_id"].take(at), rows["row_key"].take(at), pa.array(start.astype(np.int32)),
                pa.array([o[2] for o in out], pa.int32()), pa.array([o[3] for o in out], pa.binary()),
            ],
            ["doc_id", "row_key", "start", "count", "window"],
        )
        yield from table.combine_chunks().to_batches() or [
            pa.RecordBatch.from_arrays([c.combine_chunks() for c in table.columns], schema=table.schema)
        ]


def _remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sizes, removed, kept = [], [], []
        for text, cuts in zip(encoded(batch.column("text")), batch.column("cuts").to_pylist(), strict=True):
            words = text.split()
            sizes.append(len(words))
            if cuts:
                flags = np.zeros(len(words) + 1, np.int64)
                for c in cuts:
                    flags[c["start"]] += 1
                    flags[min(c["start"] + c["count"] + WINDOW - 1, len(words))] -= 1
                stay = np.flatnonzero(np.cumsum(flags[:-1]) == 0)
                words = [words[i] for i in stay.tolist()]
            removed.append(sizes[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept"],
        )


def _with_cuts(docs: DataFrame, cuts: DataFrame, how: str) -> DataFrame:
    """``doc_id, row_key, text`` with the ``cuts`` of the document (a stored table).

    The cuts are broadcast when their checked size allows, so texts stay in
    place. Beyond that only documents with cuts are shuffled, as far as the list
    of those can be broadcast.
    """
    cuts = cuts.withColumnsRenamed({"doc_id": "_id", "row_key": "_key"})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(), "text")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row_key") == F.col("_key"))
    if fits_broadcast(cuts, max_bytes=BROADCAST_BYTES):
        return rows.join(F.broadcast(cuts), same, how).drop("_id", "_key")
    listed = cuts.select("_id", "_key")
    if not fits_broadcast(listed, max_bytes=BROADCAST_BYTES):
        return rows.join(cuts, same, how).drop("_id", "_key")
    cut = rows.join(F.broadcast(listed), same, "left_semi").join(cuts, same).drop("_id", "_key")
    if how == "inner":
        return cut
    rest = rows.join(F.broadcast(listed), same, "left_anti")
    return cut.unionByName(rest, allowMissingColumns=True)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row of ``docs``.

    ``docs`` has ``doc_id, text``; other columns are not read. A word goes when a
    window of 20 words that covers it starts earlier elsewhere: in a document
    with a smaller id, or earlier in the same one. ``kept`` is what is left,
    joined by single spaces. Windows are judged on the input. A null text has no
    words; texts under 20 words lose nothing. A null id counts as larger than
    all others, and documents of one id come in the order of a text hash; rows
    repeated with id and text count as one document and have one result.

    A document whose words are all those of an earlier one is a copy: it loses
    everything without being searched. Anchors with more than ``ANCHOR_PIECES``
    pieces are split over several tasks; what is first in each of them is then
    compared by window among the tasks.
    """
    cuts = stored_alone(docs.sparkSession, "cuts", lambda: _repeats(docs))
    return _with_cuts(docs, cuts, "left").mapInArrow(
        _remove, "doc_id long, n_words long, n_removed long, kept string"
    )


def _repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, row_key, cuts``: runs of windows that start earlier elsewhere."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(), "text").mapInArrow(_anchors, ANCHORS)
    rows = stored(rows.withColumn("r", F.monotonically_increasing_id()), "anchors")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key", "r")
    first = rows.groupBy("words_key").agg(F.min(place).alias("first"))
    first = stored(first.select("words_key", "first.doc_id", "first.row_key", "first.r"), "first-texts")
    copies = (
        rows.where(F.col("n_words") >= WINDOW).select("doc_id", "row_key", "words_key", "n_words")
        .join(first.select("words_key", F.col("doc_id").alias("f_id"), F.col("row_key").alias("f_key")), "words_key")
        .where(~(F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("row_key") == F.col("f_key"))))
        .select(
            "doc_id", "row_key", F.lit(0).alias("start"),
            (F.col("n_words") - (WINDOW - 1)).cast("int").alias("count"),
        ).distinct()
    )

    others = stored(rows.select("r").join(first.select("r"), "r", "left_anti"), "other-texts")
    # One number for start and count keeps the rows of this widest shuffle short.
    packed = F.transform("starts", lambda s, i: F.shiftleft(s.cast("long"), 32) + F.get("counts", i))
    spots = rows.join(small(others), "r", "left_anti").select(
        "r", F.explode(F.arrays_zip("anchors", packed.alias("spot"))).alias("s")
    ).select("r", F.col("s.anchors").alias("anchor"), "s.spot")
    # Written down, so that the join shuffles both sides for itself and hot anchors are split.
    again = spots.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select(
        "anchor", F.ceil(F.col("n") / ANCHOR_PIECES).cast("int").alias("salts")
    )
    spots = spots.join(stored(again, "anchors-again"), "anchor")
    cut = F.struct(
        "anchor",
        F.pmod(F.xxhash64("r", "spot"), F.col("salts")).cast("int").alias("salt"), "salts",
        F.shiftright("spot", 32).cast("int").alias("start"),
        F.col("spot").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("count"),
    )
    wanted = spots.groupBy("r").agg(F.collect_list(cut).alias("cuts"))
    wanted = stored(rows.select("r", "doc_id", "row_key").join(wanted, "r").drop("r"), "spots")

    pieces = _with_cuts(docs, wanted, "inner").dropDuplicates(["doc_id", "row_key"]) if (
        rows.count() > rows.select("doc_id", "row_key").distinct().count()
    ) else _with_cuts(docs, wanted, "inner")
    pieces = pieces.mapInArrow(_pieces, PIECES)
    pieces = pieces.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt")
    hits = stored(pieces.mapInArrow(_shard, HITS), "hits")

    later = hits.where("window is null").select("doc_id", "row_key", "start", "count")
    local = hits.where("window is not null")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key", "start")
    lowest = local.groupBy("window").agg(F.min(place).alias("first"))
    beaten = local.join(lowest, "window").where(~place.eqNullSafe(F.col("first"))).select("doc_id", "row_key", "start", "count")
    cuts = later.unionByName(beaten).unionByName(copies)
    return cuts.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("start", "count")).alias("cuts"))


def op9_substring_dedup(spark, sf_dir):
    """Every document with what is left of it, as a digest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = remove_repeats(docs)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH texts AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS start FROM texts WHERE len(words) >= 20
), placed AS (
  SELECT doc_id, start, row_number() OVER (
    PARTITION BY array_to_string(words[start:start + 19], ' ') ORDER BY doc_id, start) AS place
  FROM starts
), covered AS (
  SELECT doc_id, list_distinct(flatten(list(range(start, start + 20)))) AS gone
  FROM placed WHERE place > 1 GROUP BY doc_id
), words AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts
), gone AS (
  SELECT doc_id, unnest(gone) AS place FROM covered
), kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.place) AS kept, count(*) AS n
  FROM words w ANTI JOIN gone g ON g.doc_id = w.doc_id AND g.place = w.place GROUP BY w.doc_id
)
SELECT t.doc_id, len(t.words) AS n_words, len(t.words) - coalesce(k.n, 0) AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON k.doc_id = t.doc_id
"""
