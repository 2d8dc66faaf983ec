"""Token counts: pieces counted once per distinct pre-token, then summed per document."""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.llm.words import slices
from crateflow.session import stored, stored_alone

# The most frequent pre-tokens travel to every task: at most so many, at most so
# many bytes each. All others are joined.
FREQUENT = 150_000
FREQUENT_BYTES = 64
# Distinct pre-tokens that a task counts before it hands them on.
FLUSH = 200_000
# The split of byte-level tokenizers: fixed value.
BYTE_LEVEL = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Outside these blocks the tables of letters of two libraries may be of
# different age; texts with such characters are split by the tokenizer itself.
SETTLED = (
    r"[\x00-\u0557\u0590-\u07ff\u0900-\u0bff\u0e00-\u1fff\u2000-\u206f"
    r"\u20a0-\u2bff\u3000-\ua48f\uac00-\ud7a3\uf900-\ufaff\ufe30-\uffef]*"
)


class Pretokens:
    """Cuts a text as the tokenizer file says, and counts the pieces of a cut."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        added = said["added_tokens"]
        kind = said["pre_tokenizer"] or {}
        if (
            said["normalizer"]
            or kind.get("type") != "ByteLevel"
            or not kind.get("use_regex")
            or kind.get("add_prefix_space")
            or any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added)
        ):
            raise ValueError(f"{path}: only byte-level tokenizers without normalizer or stripping added tokens")
        names = sorted((a["content"] for a in added), key=len, reverse=True)
        self._added = regex.compile("|".join(map(regex.escape, names))) if names else None
        self._split = regex.compile(BYTE_LEVEL).findall
        self._settled = regex.compile(SETTLED).fullmatch

    def of(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how many added tokens stand between them."""
        parts = self._added.split(text) if self._added else [text]
        pieces: list[str] = []
        for part in parts:
            if self._settled(part):
                pieces += self._split(part)
            else:
                cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(part)
                pieces += [part[a:b] for _, (a, b) in cut]
        return pieces, len(parts) - 1

    def sizes(self, pieces: list[str]) -> list[int]:
        return [len(x) for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]


@lru_cache(maxsize=2)
def pretokens(path: str) -> Pretokens:
    """Read once per Python worker."""
    return Pretokens(path)


def _totals(path: str) -> Callable:
    def batch_of(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["piece", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, counts = pretokens(path).of, Counter()
        for batch in slices(batches, "text"):
            for text in batch.column("text").to_pylist():
                counts.update(cut(text or "")[0])
            if len(counts) > FLUSH:
                yield batch_of(counts)
                counts = Counter()
        yield batch_of(counts)

    return run


def _sizes(path: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "piece"):
            sizes = pretokens(path).sizes(batch.column("piece").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("piece"), batch.column("n"), pa.array(sizes, pa.int64())],
                ["piece", "n", "n_tokens"],
            )

    return run


def _frequencies(path: str, frequent) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, known = pretokens(path).of, frequent.value
        for batch in slices(batches, "text"):
            done, rare, times = [], [], []
            for text in batch.column("text").to_pylist():
                pieces, total = cut(text or "")
                others, counts = [], []
                for piece, n in Counter(pieces).items():
                    size = known.get(piece)
                    if size is None:
                        others.append(piece)
                        counts.append(n)
                    else:
                        total += n * size
                done.append(total)
                rare.append(others)
                times.append(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("doc_id"), batch.column("n_bytes"),
                    pa.array(done, pa.int64()), pa.array(rare, pa.list_(pa.string())),
                    pa.array(times, pa.list_(pa.int64())),
                ],
                ["row", "doc_id", "n_bytes", "done", "rare", "times"],
            )

    return run


def piece_sizes(docs: DataFrame, path: str) -> DataFrame:
    """``piece, n, n_tokens``: every distinct pre-token of all texts, counted once."""
    totals = docs.select("text").mapInArrow(_totals(path), "piece string, n long")
    totals = totals.groupBy("piece").agg(F.sum("n").alias("n"))
    return totals.mapInArrow(_sizes(path), "piece string, n long, n_tokens long")


def count_tokens(docs: DataFrame, path: str, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for every row of ``docs``.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A null or
    empty text has no bytes and no tokens. Repeated rows and null ids give a row
    each. ``path`` is a tokenizers file that every executor reads; the strings
    of its added tokens count as one token inside texts, as by default.

    Per-document frequencies meet the sizes in two ways with one result: the
    ``frequent`` most frequent pre-tokens (a few megabytes) are looked up inside
    the task, the rest are joined by an equal pre-token. Each of the rest holds
    at most one part in ``frequent`` of all rows, so the join has no hot key.
    """
    return stored_alone(docs.sparkSession, "token-counts", lambda: _count_tokens(docs, path, frequent))


def _count_tokens(docs: DataFrame, path: str, frequent: int) -> DataFrame:
    spark = docs.sparkSession
    sizes = stored(piece_sizes(docs, path), "piece-sizes")
    top = (
        sizes.where(F.octet_length("piece") <= FREQUENT_BYTES)
        .orderBy(F.desc("n"), "piece").limit(frequent).select("piece", "n_tokens")
    )
    # A bounded number of short rows.
    table = top.toArrow()
    known = spark.sparkContext.broadcast(
        dict(zip(table["piece"].to_pylist(), table["n_tokens"].to_pylist(), strict=True))
    )
    # The row number is written down once, so later passes see the same.
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "text",
    ).mapInArrow(
        _frequencies(path, known),
        "row long, doc_id long, n_bytes long, done long, rare array<string>, times array<long>",
    )
    rows = stored(rows, "frequencies")
    rest = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("f"))
    rest = rest.select("row", F.col("f.rare").alias("piece"), F.col("f.times").alias("times"))
    rest = (
        rest.join(sizes.select("piece", "n_tokens"), "piece")
        .groupBy("row").agg(F.sum(F.col("times") * F.col("n_tokens")).alias("more"))
    )
    return rows.select("row", "doc_id", "n_bytes", "done").join(rest, "row", "left").select(
        "doc_id", "n_bytes", (F.col("done") + F.coalesce("more", F.lit(0))).alias("n_tokens")
    )


def op5_token_counts(spark, sf_dir):
    """Token counts of every document."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counted = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)
