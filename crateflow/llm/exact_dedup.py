"""Exact dedup by content-defined chunk recipes.

A normalised text is cut where a rolling hash of its last 16 bytes says so, so
equal passages are cut alike. Chunks become verified identifiers; a document
is then its ordered list of identifiers, and equal lists are equal texts. A text
moves once, as chunks; all comparing is done on the short lists.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.llm.rows import row_key
from crateflow.llm.words import encoded, slices
from crateflow.plans.spread import spread_join
from crateflow.session import stored, stored_alone

MIN_CHUNK, MEAN_BITS, MAX_CHUNK = 512, 11, 1 << 16
WHITE = re.compile(rb"[\x20\x09-\x0D]+")
# One pseudo-random value per byte, from a rule.
GEAR = np.array(
    [int.from_bytes(hashlib.sha256(bytes([i])).digest()[:4], "little") for i in range(256)],
    np.uint32,
)
KEY_BYTES = 16
RECIPES = "doc_id long, row_key long, n_bytes long, text_sha256 string, recipe binary"
CHUNKS = "key binary, bytes binary"


def normalised(text: bytes) -> bytes:
    return WHITE.sub(b" ", text)


def cuts(text: bytes) -> list[int]:
    """Ends of the chunks of a text; the empty text has one empty chunk."""
    if len(text) <= MIN_CHUNK:
        return [len(text)]
    rolling = GEAR[np.frombuffer(text, np.uint8)]
    for step in (1, 2, 4, 8):
        joined = rolling.copy()
        joined[step:] += rolling[:-step] << np.uint32(step)
        rolling = joined
    marks = np.flatnonzero((rolling >> np.uint32(32 - MEAN_BITS)) == 0) + 1
    out, start = [], 0
    while len(text) - start > MIN_CHUNK:
        i = int(np.searchsorted(marks, start + MIN_CHUNK))
        end = int(marks[i]) if i < len(marks) else len(text)
        start = min(end, start + MAX_CHUNK, len(text))
        out.append(start)
    if start < len(text):
        out.append(len(text))
    return out


def _parts(text: bytes) -> Iterator[tuple[bytes, bytes]]:
    start = 0
    for end in cuts(text):
        part = text[start:end]
        yield hashlib.blake2b(part, digest_size=KEY_BYTES).digest(), part
        start = end


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        # Copies in one slice leave as one chunk.
        parts = {part: key for text in encoded(batch.column("text")) for key, part in _parts(normalised(text))}
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts.values(), pa.binary()), pa.array(parts.keys(), pa.binary())], ["key", "bytes"]
        )


def _recipes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sizes, digests, recipes = [], [], []
        for text in map(normalised, encoded(batch.column("text"))):
            sizes.append(len(text))
            digests.append(hashlib.sha256(text).hexdigest())
            recipes.append(b"".join(key for key, _ in _parts(text)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("row_key"), pa.array(sizes, pa.int64()),
                pa.array(digests, pa.string()), pa.array(recipes, pa.binary()),
            ],
            ["doc_id", "row_key", "n_bytes", "text_sha256", "recipe"],
        )


def chunk_recipes(docs: DataFrame) -> DataFrame:
    """``doc_id, row_key, n_bytes, text_sha256, recipe``; a recipe is the chunk keys in order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(), "text")
    return rows.mapInArrow(_recipes, RECIPES)


def distinct_chunks(docs: DataFrame) -> DataFrame:
    """``key, low, high``: the smallest and the largest chunk found under a key."""
    chunks = docs.select("text").mapInArrow(_chunks, CHUNKS)
    return chunks.groupBy("key").agg(F.min("bytes").alias("low"), F.max("bytes").alias("high"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, row_key, recipe, text_sha256, keep_id, group_size, kept`` for every row.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A null text
    is empty, and empty texts are equal. Of equal texts the smallest ``doc_id``
    stays; a null id stays only where no row of the group has one. A repeated
    row counts in ``group_size`` and has the ``kept`` of its id. An empty table
    gives an empty result.

    Chunks that share a 128-bit key are compared byte by byte, on both sides of
    the shuffle. A document with a key under which different chunks were found
    is identified by the digest of its whole text instead.
    """
    return stored_alone(docs.sparkSession, "exact-groups", lambda: _exact_groups(docs))


def _exact_groups(docs: DataFrame) -> DataFrame:
    clashes = stored(distinct_chunks(docs).where("low <> high").select("key"), "clashes")
    rows = stored(chunk_recipes(docs), "recipes")
    if not clashes.isEmpty():
        keys = F.expr(
            f"transform(sequence(0, octet_length(recipe) div {KEY_BYTES} - 1),"
            f" i -> substring(recipe, i * {KEY_BYTES} + 1, {KEY_BYTES}))"
        )
        unsure = rows.select("recipe", F.explode(keys).alias("key")).join(clashes, "key").select("recipe").distinct()
        unsure = unsure.withColumn("unsure", F.lit(True))
        rows = rows.join(unsure, "recipe", "left").withColumn(
            "recipe", F.when(F.col("unsure"), F.unhex("text_sha256")).otherwise(F.col("recipe"))
        ).drop("unsure")
    groups = rows.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    joined = spread_join(rows, groups, ["recipe"], "inner")
    return joined.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def op10_exact_dedup(spark, sf_dir):
    """Every document with the copy that stays for it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS plain FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, sha256(plain) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY plain)
"""
