"""Byte-level BPE: merge order from a segment tree over byte positions.

The leaf of a position holds the rank of the pair that starts there, next to
the position, as one number, so the root of a minimum tree is the leftmost pair
of lowest rank. A merge changes the pair of the merged position, of its left
neighbour and of the swallowed position: three leaves, a logarithmic number of
nodes each. Short pieces are merged side by side, one tree per row of a matrix;
long ones one at a time in the same way.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crateflow.llm.words import slices

# Pieces of at most this many bytes are merged side by side.
SIDE_BY_SIDE = 64
# Encoded pieces remembered by a task, by number and by total bytes.
MEMO_PIECES = 400_000
MEMO_BYTES = 24 << 20
ROWS = 4096
_NONE = np.int64(1 << 62)
ENCODED = T.StructType().add("n_tokens", "long").add("ids", "binary")


class Ranks:
    """Tokens by rank, and the rank of each pair of tokens that can merge."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.tokens: dict[int, bytes] = {rank: token for token, rank in ranks.items()}
        self.byte_rank = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[(left << 32) | right] = rank
        self.pairs = pairs
        order = np.array(sorted(pairs), np.int64)
        self._keys = order
        self._values = np.array([pairs[k] for k in order.tolist()], np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` where it does not merge; a negative token is none."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        fits = (self._keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(fits, self._values[at], _NONE)


@lru_cache(maxsize=4)
def load_ranks(path: str) -> Ranks:
    """Read once per Python worker."""
    return Ranks(path)


def merge_rows(pieces: list[bytes], ranks: Ranks) -> list[np.ndarray]:
    """Ids of pieces of up to ``SIDE_BY_SIDE`` bytes, a tree per row."""
    n = len(pieces)
    lengths = np.array([len(p) for p in pieces], np.int64)
    width = max(2, 1 << int(lengths.max() - 1).bit_length())
    places = np.arange(width)
    inside = places < lengths[:, None]
    raw = np.zeros((n, width), np.uint8)
    raw[inside] = np.frombuffer(b"".join(pieces), np.uint8)
    token = np.full((n, width + 1), -1, np.int64)
    token[:, :width] = np.where(inside, ranks.byte_rank[raw], -1)
    after = np.minimum(places + 1, width) + np.zeros((n, 1), np.int64)
    before = places - 1 + np.zeros((n, 1), np.int64)
    # Nodes 1 .. 2 * width - 1; leaves from width on hold rank and position.
    tree = np.full((n, 2 * width), _NONE, np.int64)
    pair = ranks.merged(token[:, :width].ravel(), token[:, 1:].ravel()).reshape(n, width)
    tree[:, width:] = np.where(pair < _NONE, pair * width + places, _NONE)
    node = width
    while node > 1:
        half = node // 2
        tree[:, half:node] = np.minimum(tree[:, node : 2 * node : 2], tree[:, node + 1 : 2 * node : 2])
        node = half
    live = np.flatnonzero(tree[:, 1] < _NONE)

    def put(row: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        spot = at + width
        tree[row, spot] = value
        while spot[0] > 1:
            tree[row, spot >> 1] = np.minimum(tree[row, spot], tree[row, spot ^ 1])
            spot = spot >> 1

    def pair_at(row: np.ndarray, at: np.ndarray) -> np.ndarray:
        rank = ranks.merged(token[row, at], token[row, after[row, at]])
        return np.where(rank < _NONE, rank * width + at, _NONE)

    while len(live):
        root = tree[live, 1]
        at, rank = root % width, root // width
        gone = after[live, at]
        token[live, at] = rank
        token[live, gone] = -1
        following = after[live, gone]
        after[live, at] = following
        has = following < width
        before[live[has], following[has]] = at[has]
        put(live, gone, np.full(len(live), _NONE))
        put(live, at, pair_at(live, at))
        left = before[live, at]
        has = left >= 0
        if has.any():
            put(live[has], left[has], pair_at(live[has], left[has]))
        live = live[tree[live, 1] < _NONE]
    kept = token[:, :width] >= 0
    ids = token[:, :width][kept].astype("<u4")
    return np.split(ids, np.cumsum(kept.sum(axis=1))[:-1])


def merge_long(piece: bytes, ranks: Ranks) -> np.ndarray:
    """Ids of one piece of any length, with one tree."""
    n = len(piece)
    token = ranks.byte_rank[np.frombuffer(piece, np.uint8)].tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pairs, none = ranks.pairs, int(_NONE)
    width = max(2, 1 << (n - 1).bit_length())
    tree = [none] * (2 * width)

    def pair_at(at: int) -> int:
        following = after[at]
        if following >= n:
            return none
        rank = pairs.get((token[at] << 32) | token[following])
        return none if rank is None else rank * width + at

    def put(at: int, value: int) -> None:
        spot = at + width
        tree[spot] = value
        while spot > 1:
            other = tree[spot ^ 1]
            least = tree[spot] if tree[spot] < other else other
            spot >>= 1
            if tree[spot] == least:
                break
            tree[spot] = least

    for at in range(n):
        tree[width + at] = pair_at(at)
    for spot in range(width - 1, 0, -1):
        tree[spot] = min(tree[2 * spot], tree[2 * spot + 1])
    while tree[1] < none:
        rank, at = divmod(tree[1], width)
        gone = after[at]
        token[at] = rank
        after[at] = after[gone]
        if after[at] < n:
            before[after[at]] = at
        put(gone, none)
        put(at, pair_at(at))
        if before[at] >= 0:
            put(before[at], pair_at(before[at]))
    out, at = [], 0
    while at < n:
        out.append(token[at])
        at = after[at]
    return np.array(out, "<u4")


def encode_pieces(pieces: list[bytes], ranks: Ranks) -> list[np.ndarray]:
    """Ids of each non-empty piece, as little-endian unsigned 32-bit integers."""
    out: list[np.ndarray] = [None] * len(pieces)
    order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
    while order and len(pieces[order[-1]]) > SIDE_BY_SIDE:
        i = order.pop()
        out[i] = merge_long(pieces[i], ranks)
    for start in range(0, len(order), ROWS):
        part = order[start : start + ROWS]
        for i, ids in zip(part, merge_rows([pieces[i] for i in part], ranks), strict=True):
            out[i] = ids
    return out


class Memo:
    """Encoded pieces of a task; emptied when it is full, so memory stays bounded."""

    def __init__(self, encode: Callable[[list[str]], list[object]]):
        self._encode, self._known, self._bytes = encode, {}, 0

    def of(self, pieces: set[str]) -> dict[str, object]:
        fresh = [p for p in pieces if p not in self._known]
        if len(self._known) + len(fresh) > MEMO_PIECES or self._bytes > MEMO_BYTES:
            self._known, self._bytes, fresh = {}, 0, list(pieces)
        self._known.update(zip(fresh, self._encode(fresh), strict=True))
        self._bytes += sum(map(len, fresh))
        return self._known


def _encoder(path: str, pattern: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, split = load_ranks(path), regex.compile(pattern).findall

        def encode(pieces: list[str]) -> list[bytes]:
            return [ids.tobytes() for ids in encode_pieces([p.encode() for p in pieces], ranks)]

        memo = Memo(encode)
        for batch in slices(batches, "text"):
            pieces = [split(text or "") for text in batch.column("text").to_pylist()]
            known = memo.of(set().union(*pieces))
            ids = [b"".join(map(known.__getitem__, p)) for p in pieces]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            rest = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"]
            names = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*rest, counts, pa.array(ids, pa.binary())], [*names, "n_tokens", "ids"]
            )

    return run


def _decoder(path: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load_ranks(path).tokens
        for batch in slices(batches, "ids"):
            out = [
                b"".join(map(tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"]
            )

    return run


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The columns of ``docs`` without ``text``, then ``n_tokens`` and ``ids``.

    ``ids`` holds little-endian unsigned 32-bit integers, packed. Each match of
    ``pattern`` is encoded separately by the ranks file at ``path`` (which every
    executor reads); there are no special tokens. A null or empty text has no
    ids. Rows stay where they are: nothing is shuffled, repeated rows and null
    ids are rows like others. Columns called ``n_tokens`` or ``ids`` are replaced.
    """
    rest = docs.drop("n_tokens", "ids")
    columns = [F.col(f"`{c}`") for c in rest.columns if c.lower() != "text"]
    rows = rest.select(*columns, "text")
    return rows.mapInArrow(_encoder(path, pattern), T.StructType([*rows.schema[:-1], *ENCODED]))


def decode(rows: DataFrame, path: str) -> DataFrame:
    """The columns of ``rows`` and ``decoded``: the bytes that packed ``ids`` stand for.

    Null ids are no ids. An id outside the ranks file fails the task.
    """
    rows = rows.drop("decoded")
    return rows.mapInArrow(_decoder(path), T.StructType([*rows.schema, T.StructField("decoded", T.BinaryType())]))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encode`` and then ``decode``, one after the other in one Python worker for each task."""
    encoded, encoder, decoder = encode(docs, path, pattern), _encoder(path, pattern), _decoder(path)
    rest = docs.drop("n_tokens", "ids", "decoded")
    columns = [F.col(f"`{c}`") for c in rest.columns if c.lower() != "text"]
    fields = [f for f in encoded.schema if f.name.lower() != "decoded"]
    schema = T.StructType([*fields, T.StructField("decoded", T.BinaryType())])
    return rest.select(*columns, "text").mapInArrow(lambda batches: decoder(encoder(batches)), schema)


def op6_byte_bpe(spark, sf_dir):
    """Every document encoded and decoded again, as digests."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = decode(encode(docs, path, pattern), path)
    return rows.select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
