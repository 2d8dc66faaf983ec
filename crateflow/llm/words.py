"""Words and shingles of texts as 64-bit hashes, in numpy, inside Arrow batches.

A word is a run of bytes other than ASCII white space: ``bytes.split`` cuts at
exactly ``\\x20`` and ``\\x09-\\x0D``. A null text has no words. Hashes are equal
in every process.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

# Texts handled at a time; a longer text comes alone.
SLICE_BYTES = 1 << 20
# An odd multiplier (2**64 divided by the golden ratio): fixed value.
STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
# Of the C library, where it has it.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def slices(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each part holds about ``limit`` bytes of ``column``."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, before + limit, side="right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop
        give_back()  # what the batch before took, as this one is still held


def give_back() -> None:
    """Return memory that is free again to the system: workers outlive tasks and stages."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def encoded(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def parts(text: bytes, limit: int = SLICE_BYTES) -> Iterator[bytes]:
    """A text cut at white space, so that only about ``limit`` bytes are split into words at a time."""
    start = 0
    while len(text) - start > limit:
        space = _SPACE.search(text, start + limit)
        if space is None:
            break
        yield text[start : space.start()]
        start = space.end()
    yield text[start:]


def hashed(words: list[bytes]) -> np.ndarray:
    values = np.empty(len(words), dtype=object)
    values[:] = words
    if not len(words):
        return np.empty(0, np.uint64)
    return pd.util.hash_array(values, categorize=False)


def split_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All words in a row, and where each text begins and the last one ends."""
    words: list[bytes] = []
    ends = [0]
    for text in texts:
        words.extend(text.split())
        ends.append(len(words))
    return words, np.array(ends, dtype=np.int64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    out = values ^ (values >> np.uint64(31))
    out = out * np.uint64(STEP)
    return out ^ (out >> np.uint64(29))


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash for each run of ``length`` values, by doubling: runs of 1, 2, 4 ... are joined."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done = np.zeros(n, np.uint64), 0
    part, size = hashes, 1
    while True:
        if length & size:
            factor = np.uint64(pow(STEP, size, 1 << 64))
            out = out * factor + part[done : done + n]
            done += size
        if size * 2 > length:
            return mixed(out)
        factor = np.uint64(pow(STEP, size, 1 << 64))
        part = part[:-size] * factor + part[size:]
        size *= 2


def window_starts(ends: np.ndarray, length: int) -> np.ndarray:
    """Whether a window that starts at each word stays within its text."""
    total = int(ends[-1])
    inside = np.zeros(total + 1, np.int64)
    np.add.at(inside, ends[:-1], 1)
    np.add.at(inside, np.maximum(ends[1:] - length + 1, ends[:-1]), -1)
    return np.cumsum(inside)[: max(total - length + 1, 0)] > 0


def shingle_lists(hashes: np.ndarray, ends: np.ndarray, size: int) -> list[np.ndarray]:
    """Shingles of each text in order, with repeats; a shorter text is one shingle."""
    every = windows(hashes, size)
    out = []
    for start, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if end - start >= size:
            out.append(every[start : end - size + 1])
        elif end > start:
            # The length takes part, so a short text never equals a full shingle.
            out.append(windows(hashes[start:end], end - start) + np.uint64(end - start))
        else:
            out.append(np.empty(0, np.uint64))
    return out
