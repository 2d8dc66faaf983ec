"""Benchmark decontamination: SimHash of item-sized windows, then exact similarity.

A document leaks an item when one of its windows, as many words long as the
item, has a weighted shingle similarity of 0.8 or more with it. A document
shorter than the item is one window as a whole. Windows and
items get 256-bit SimHash fingerprints, cut into 128 blocks of two bits. Two
fingerprints that differ in at most r bits differ in at most r blocks, so all
items that near agree with the window in 128 - r blocks or more, and few others
do. The agreeing blocks of a window and all items of its length are counted at
once, 32 blocks to a machine word.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.llm.rows import row_key
from crateflow.llm.words import STEP, encoded, hashed, mixed, slices, shingle_lists, split_words, windows
from crateflow.session import stored

WORDS, SIMILARITY = 5, 0.8
# Of item-sized windows of distinct shingles and similarity 0.8 a bit differs with
# 0.15 at most, of a shorter text with 0.19: by the binomial five in 10**12 and one
# in four million lie beyond the radius. Of unlike windows 0.2 percent agree in the
# 47 blocks that the radius asks for.
BITS, BLOCK, RADIUS = 256, 2, 81
# Odd multipliers that make four words of bits from one shingle, and the lower bit
# of each block of a word.
_WORDS = np.array([pow(STEP, 2 * k + 1, 1 << 64) for k in range(BITS // 64)], np.uint64)
_LOWER = np.uint64(0x5555555555555555)
# Items of one pass over the documents travel to every task: so much text, some
# 80 MB with its index.
BLOCK_BYTES = 4 << 20
FOUND = "doc_id long, row_key long, item_id long, start long, n_words long, similarity double"


def fingerprints(shingles: np.ndarray) -> np.ndarray:
    """SimHash of each row of shingles, as words; a repeated shingle weighs as often as it stands there."""
    words = mixed(shingles)[..., None] * _WORDS
    words ^= words >> np.uint64(29)
    bits = np.unpackbits(words.view(np.uint8), axis=-1)
    total = bits.sum(axis=1, dtype=np.int32) * 2 > shingles.shape[1]
    return np.packbits(total, axis=-1).view(np.uint64)


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of shingle counts."""
    common = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return common / (a.total() + b.total() - common)


def agreeing_blocks(prints: np.ndarray, window: np.ndarray) -> np.ndarray:
    """How many blocks each fingerprint has in common with that of a window."""
    other = prints ^ window
    differ = (other | (other >> np.uint64(1))) & _LOWER
    return BITS // BLOCK - np.bitwise_count(differ).sum(axis=-1, dtype=np.int32)


@dataclass
class Items:
    """Benchmark items of one block, with the index of their fingerprints."""

    radius: int
    similarity: float
    ids: list[int] = field(default_factory=list)
    counts: list[Counter] = field(default_factory=list)
    #: by number of words: items and their fingerprints, a row each
    index: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    #: sorted shingles of items by shingle size (five, or fewer for short items)
    known: dict[int, np.ndarray] = field(default_factory=dict)

    @classmethod
    def of(cls, rows: list[tuple[int, str]], radius: int, similarity: float) -> Items:
        out, known, prints = cls(radius, similarity), defaultdict(list), defaultdict(list)
        rows = [(i, (text or "").encode().lower()) for i, text in rows]
        words, ends = split_words([text for _, text in rows])
        lists = shingle_lists(hashed(words), ends, WORDS)
        for (item, _), shingles, n in zip(rows, lists, np.diff(ends).tolist(), strict=True):
            if not n:
                continue
            place = len(out.ids)
            out.ids.append(item)
            out.counts.append(Counter(shingles.tolist()))
            prints[n].append((place, fingerprints(shingles[None])[0]))
            known[min(n, WORDS)].append(shingles)
        out.index = {
            n: (np.array([place for place, _ in some]), np.stack([words for _, words in some]))
            for n, some in prints.items()
        }
        out.known = {size: np.unique(np.concatenate(parts)) for size, parts in known.items()}
        return out

    def near(self, length: int, window: np.ndarray) -> list[int]:
        """Items of that length within the radius of a fingerprint."""
        places, prints = self.index[length]
        some = np.flatnonzero(agreeing_blocks(prints, window) >= BITS // BLOCK - self.radius)
        distance = np.bitwise_count(prints[some] ^ window).sum(axis=-1, dtype=np.int32)
        return places[some[distance <= self.radius]].tolist()


def member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(of, values), len(of) - 1)
    return of[at] == values


def leaks(shingles: np.ndarray, hits: np.ndarray, size: int, items: Items) -> dict[int, tuple[float, int, int]]:
    """Item -> (similarity, -start, words) of its best window in one document.

    ``hits`` marks shingles that some item has. A window can only be similar
    enough when it has at least that part of the item's number of shingles as
    such, so others are not fingerprinted: the bound drops nothing. It holds for a
    document shorter than the item too, whose one window is all of it.
    """
    best: dict[int, tuple[float, int, int]] = {}
    before = np.concatenate([[0], np.cumsum(hits)])
    for length in items.index:
        n = max(length - WORDS + 1, 1)
        if min(length, WORDS) != size or not len(shingles):
            continue
        width = min(n, len(shingles))
        enough = before[width:] - before[:-width] >= np.ceil(items.similarity * n - 1e-9)
        starts = np.flatnonzero(enough)
        for part in np.array_split(starts, -(-len(starts) // 64)) if len(starts) else ():
            rows = shingles[part[:, None] + np.arange(width)]
            for start, row, window in zip(part.tolist(), rows, fingerprints(rows), strict=True):
                near = items.near(length, window)
                if near:
                    counts = Counter(row.tolist())
                    for i in near:
                        found = weighted_similarity(counts, items.counts[i])
                        if found >= items.similarity - 1e-12:
                            best[i] = max(best.get(i, (0.0, 0, 0)), (found, -start, width + size - 1))
    return best


def _search(shared) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        for batch in slices(batches, "text"):
            words, ends = split_words([text.lower() for text in encoded(batch.column("text"))])
            hashes = hashed(words)
            found: list[tuple[int, int, float, int, int]] = []
            for size, known in items.known.items():
                every = windows(hashes, size)
                if size < WORDS:
                    every = every + np.uint64(size)
                hits = member(every, known)
                before = np.concatenate([[0], np.cumsum(hits)])
                last = np.maximum(np.minimum(ends[1:] - size + 1, len(every)), ends[:-1])
                first = np.minimum(ends[:-1], len(every))
                for doc in np.flatnonzero(before[np.minimum(last, len(every))] > before[first]).tolist():
                    span = slice(int(first[doc]), int(last[doc]))
                    for i, (value, start, length) in leaks(every[span], hits[span], size, items).items():
                        found.append((doc, items.ids[i], value, -start, length))
            docs = [f[0] for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(docs, pa.int64())),
                    batch.column("row_key").take(pa.array(docs, pa.int64())),
                    pa.array([f[1] for f in found], pa.int64()), pa.array([f[3] for f in found], pa.int64()),
                    pa.array([f[4] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.float64()),
                ],
                ["doc_id", "row_key", "item_id", "start", "n_words", "similarity"],
            )

    return run


def find_leaks(
    docs: DataFrame, items: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY
) -> DataFrame:
    """A row for every document and item it leaks: ``doc_id, row_key, item_id,
    start, n_words, similarity`` of the most similar window (of equal ones the
    first; ``start`` counts words).

    ``docs`` has ``doc_id, text`` and ``items`` has ``item_id, text``; other
    columns are not read. Words are runs of other than ASCII white space with
    A-Z lower-cased, shingles five words, weighted by how often they stand in the
    window; an item of fewer words is one shingle. A text of fewer words than the
    item is one window, and ``n_words`` its length. Null and empty texts, and
    items without words, leak nothing. Repeated documents and null ids give rows
    of their own, an item that is there twice counts twice under its ids.

    The items are a query set: they are taken in blocks of ``BLOCK_BYTES`` of
    text, one pass over the documents each, and only a block is copied to tasks.
    What a block finds is stored, and its index dropped, before the next is built.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    n_blocks = max(1, -(-size // BLOCK_BYTES))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(), "text")
    out = None
    for block in range(n_blocks):
        chosen = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        shared = spark.sparkContext.broadcast(
            Items.of([(r.item_id, r.text) for r in chosen.toLocalIterator()], radius, similarity)
        )
        found = stored(rows.mapInArrow(_search(shared), FOUND), "block-leaks")
        shared.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def leaking_rows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, row_key`` of the documents with a leak, as a stored table."""
    return stored(find_leaks(docs, items).select("doc_id", "row_key").distinct(), "leaks")


def op1_decontamination(spark, sf_dir):
    """Every document that leaks a benchmark item, with the item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_leaks(docs, items).drop("row_key")
