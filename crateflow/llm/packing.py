"""Documents as token ids, packed into sequences of equal length and similar attention cost.

A piece of ``n`` tokens costs ``n + n * n / (6 * width)``: the layers of a model of
that width work in proportion to the tokens, attention within a document to their
square. Pieces are dealt in descending length, each to the sequence of the lowest
cost so far that still has room for it. Only what fits nowhere is cut.
"""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.llm.words import encoded, parts, slices

LENGTH = 2048
# Width of the model whose attention cost is estimated.
WIDTH = 2048
# Sequences that are filled together: 512 of 2,048 ids are 4 MB.
TOGETHER = 512
# Words whose ids a task remembers, and the longest of them in bytes.
REMEMBERED, REMEMBERED_BYTES = 700_000, 64
# Marks that end a word behind a letter. Characters that may stand between words; the first that is one id is taken. No
# other character is normalised to any of them.
CLOSING = re.compile(rb"[.,;:!?](?<=[A-Za-z].)[.,;:!?]*(?![^\x20\x09-\x0D])")
MARKS = "\u2122\U0001f602\u25cf\u00a7"
# A sequence number is that of the task, then that within the task.
TASK_BITS = 33

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class Piece(NamedTuple):
    """Consecutive ids of one document."""

    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[:at]), self._replace(start=self.start + at, ids=self.ids[at:])


class Words:
    """Ids of texts, by way of their words.

    The tokenizer must drop ASCII white space, never look across it, and cut between
    a letter and a mark like a full stop; then the ids of a text are those of its
    words in a row. The marks that end a word are words of their own, and if the
    tokenizer ignores case, so do words: each is then encoded once. Only words
    up to ``REMEMBERED_BYTES`` are remembered, and all are forgotten once there are
    more than ``REMEMBERED``.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        for text in ("a b", " \t\n\x0b\x0c\r", "don 't \u0301x", "Ab\r\n\u00c9t\u00c9", "ab .,; \u00e9t\u00e9 !? s ."):
            apart = [i for word in text.split() for i in self._encode([word])[0].tolist()]
            joined = self._encode([text.replace(" .", ".").replace(" !", "!")])[0].tolist()
            if joined != apart:
                raise ValueError(f"{path}: only tokenizers that drop ASCII white space and cut before marks")
        self._any_case = all(
            x.tolist() == y.tolist()
            for x, y in (self._encode([text, text.lower()]) for text in ("Ab'S", "ABC\u00c9", "XyZ"))
        )
        single = ((mark, self._encode([mark])[0]) for mark in MARKS)
        self._mark, self._mark_id = next(((m, x[0]) for m, x in single if len(x) == 1), (None, None))
        self._known: dict[bytes, bytes] = {}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _each(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word, out of one text in which a mark stands between them."""
        if self._mark is None or any(self._mark in word for word in words):
            return self._encode(words)
        ids = self._encode([f" {self._mark} ".join(words)])[0]
        at = np.flatnonzero(ids == self._mark_id)
        starts, ends = [0, *(at + 1).tolist()], [*at.tolist(), len(ids)]
        return [ids[a:b] for a, b in zip(starts, ends, strict=True)]

    def ids(self, text: bytes) -> np.ndarray:
        # the string of an added token counts as it is written
        if self._any_case and b"<" not in text:
            text = text.lower()
        out, known = [], self._known
        for part in parts(text):
            if len(known) > REMEMBERED:
                known.clear()
            words = CLOSING.sub(rb" \g<0>", part).split()
            ids = list(map(known.get, words))
            if None in ids:
                new = list({word for word, x in zip(words, ids, strict=True) if x is None})
                each = self._each([word.decode() for word in new])
                known.update(zip(new, (x.tobytes() for x in each), strict=True))
                ids = list(map(known.__getitem__, words))
                for word in new:
                    if len(word) > REMEMBERED_BYTES:
                        del known[word]
            out.append(b"".join(ids))
        return np.frombuffer(b"".join(out), "<u4")


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    """Read once per Python worker."""
    return Words(path)


def cost(n: int, width: int = WIDTH) -> float:
    """Estimated work of a piece of ``n`` tokens."""
    return n + n * n / (6 * width)


def assign(
    pieces: list[Piece], sizes: list[int], width: int = WIDTH
) -> tuple[list[list[Piece]], list[Piece]]:
    """Fill sequences of the given ``sizes``; returns their pieces and what is left over.

    The longest piece comes first, and of equal ones the earlier. It goes to the
    sequence of the lowest cost that has room for all of it. If there is none, the
    cheapest with any room is filled and the rest of the piece waits its turn
    again. With as many tokens as room every sequence ends full.
    """
    queue = [(-len(p.ids), k, p) for k, p in enumerate(pieces)]
    heapq.heapify(queue)
    number = len(queue)
    room, costs = np.array(sizes, np.int64), np.zeros(len(sizes))
    filled: list[list[Piece]] = [[] for _ in sizes]
    free = int(room.sum())
    while queue and free:
        _, _, piece = heapq.heappop(queue)
        n = len(piece.ids)
        fits = room >= n
        if not fits.any():
            fits = room > 0
        k = int(np.argmin(np.where(fits, costs, np.inf)))
        if room[k] < n:
            piece, rest = piece.cut(int(room[k]))
            heapq.heappush(queue, (-len(rest.ids), number, rest))
            number += 1
            n = len(piece.ids)
        filled[k].append(piece)
        room[k] -= n
        costs[k] += cost(n, width)
        free -= n
    return filled, [piece for _, _, piece in sorted(queue, key=lambda entry: entry[:2])]


def powers(n: int) -> list[int]:
    """The powers of two that sum to ``n``, largest first."""
    return [1 << k for k in reversed(range(n.bit_length())) if n >> k & 1]


def _packer(path: str, end_id: int, length: int, width: int, together: int) -> Callable:
    def batch_of(filled: list[list[Piece]], first: int) -> pa.RecordBatch:
        rows = []
        for k, pieces in enumerate(filled):
            offset = 0
            for p in pieces:
                rows.append((p.doc_id, p.start, len(p.ids), p.doc_tokens, first + k, offset, p.ids.tobytes()))
                offset += len(p.ids)
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        kinds = [pa.int64()] * 6 + [pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
            ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << TASK_BITS
        end = np.array([end_id], "<u4")
        waiting: list[Piece] = []
        ready: list[list[Piece]] = []
        held = 0
        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), encoded(batch.column("text")), strict=True):
                ids = np.concatenate([words.ids(text), end])
                rest = Piece(doc_id, 0, ids, len(ids))
                while len(rest.ids) >= length:
                    full, rest = rest.cut(length)
                    ready.append([full])
                if len(rest.ids):
                    waiting.append(rest)
                    held += len(rest.ids)
                if held >= together * length:
                    filled, waiting = assign(waiting, [length] * together, width)
                    ready += filled
                    held -= together * length
                if len(ready) >= together:
                    yield batch_of(ready, number)
                    number += len(ready)
                    ready = []
        filled, _ = assign(waiting, [length] * (held // length) + powers(held % length), width)
        yield batch_of(ready + filled, number)

    return run


def packed(
    docs: DataFrame,
    path: str,
    end_id: int,
    length: int = LENGTH,
    width: int = WIDTH,
    together: int = TOGETHER,
) -> DataFrame:
    """``doc_id, start, length, doc_tokens, sequence_id, offset, ids``: a row for each piece.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A document is
    the ids of its text by the tokenizers file ``path`` and then ``end_id``; null and
    empty texts are that id alone. ``start`` counts the ids of the document before
    the piece, ``offset`` those of the sequence, ``ids`` are little-endian unsigned 32-bit
    numbers. Every row of ``docs`` is a document of its own, also when ids or texts
    repeat or the id is null. An empty table gives an empty result.

    A task packs what it reads, ``together`` sequences at a time, so nothing is
    shuffled and a task that is run again gives the same pieces. Stretches of
    ``length`` tokens of a long document are sequences by themselves. The rest of a
    task that fills no sequence becomes sequences of a power of two, at most one of
    each: as those need no padding, none is padded.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_packer(path, end_id, length, width, together), PIECES)


def op13_packing(spark, sf_dir):
    """Every document in sequences of 2,048 tokens."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = packed(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
