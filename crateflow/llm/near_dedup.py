"""Near-duplicates by SetSketch registers, bands, joint likelihood and exact sets.

A register is the minimum of exponential values over all shingles, on a
logarithmic scale cut to 16 bits: ``floor(1 - log_b(min))``. Registers of two sets
merge by maximum and agree the more often the more the sets overlap. Sets that
agree in a band of registers meet in a bucket; the registers of such a pair are
judged together by likelihood, and what may be similar enough is confirmed on
the full sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateflow.llm.components import connected_components
from crateflow.llm.rows import row_key, small
from crateflow.llm.words import encoded, give_back, hashed, shingle_lists, slices, split_words
from crateflow.plans.spread import spread_join
from crateflow.session import stored, stored_alone

# A link of exactly the threshold meets in no band so often at most.
MISS = 1e-7
# More registers than the bands take only sharpen the estimate of a pair.
REGISTERS, BAND = 280, 5
BASE, RATE, TOP = 1.001, 20.0, 0xFFFF
# A pair is not confirmed on full sets when the registers are this many times
# (as a logarithm) likelier under their best similarity than under any allowed:
# 5.7 deviations, rarer for a link of exactly the threshold than ``MISS``.
DOUBT = 16.0
SHINGLES_AT_ONCE = 512
# Bytes of sketches and sets of a bucket that one row holds, and such rows that one
# key of a join holds.
BLOCK_BYTES, BLOCKS_TOGETHER = 1 << 20, 64
ROUNDS = ("leader", "stray leader", "all")


def _family(name: str) -> np.ndarray:
    """One pseudo-random 32-bit number per register, from a rule."""
    digest = (hashlib.sha256(f"{name}{i}".encode()).digest() for i in range(REGISTERS))
    return np.array([int.from_bytes(d[:4], "little") for d in digest], np.uint32)


FLIP, FACTOR = _family("flip")[:, None], _family("factor")[:, None] | np.uint32(1)
SKETCHES = "doc_id long, row_key long, n_shingles long, set_key binary, registers binary"


def bands_for(percent: int) -> tuple[int, int]:
    """Number of bands and registers in each: the widest, up to ``BAND``, that keep to ``MISS``.

    At similarity 0.85 these are 28 x 5, at 0.8 41 x 5, at 0.5 57 x 2.
    """
    for width in range(BAND, 0, -1):
        agree = (percent / 100) ** width
        if agree >= 1:
            return 1, width
        bands = math.ceil(math.log(MISS) / math.log1p(-agree)) if agree > 0 else REGISTERS + 1
        if bands * width <= REGISTERS:
            return bands, width
    raise ValueError(f"{REGISTERS} registers are too few for a similarity of {percent} percent")


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch of a non-empty set of 64-bit hashes."""
    low = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), SHINGLES_AT_ONCE):
        values = (short[start : start + SHINGLES_AT_ONCE] ^ FLIP) * FACTOR
        np.minimum(low, values.min(axis=1), out=low)
    exponential = -np.log1p(-(low + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype("<u2")


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text, A-Z lower-cased."""
    words, ends = split_words([text.lower() for text in texts])
    return [np.unique(s) for s in shingle_lists(hashed(words), ends, size)]


def _sketcher(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(encoded(batch.column("text")), size)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            # Copies in one slice are sketched once.
            sketch = {k: registers(s).tobytes() for k, s in dict(zip(keys, sets, strict=True)).items() if k}
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row_key"),
                    pa.array(map(len, sets), pa.int64()), pa.array(keys, pa.binary()),
                    pa.array([sketch.get(k) for k in keys], pa.binary()),
                ],
                ["doc_id", "row_key", "n_shingles", "set_key", "registers"],
            )

    return run


def _set_reader(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [s.tobytes() for s in shingle_sets(encoded(batch.column("text")), size)]
            yield pa.RecordBatch.from_arrays([batch.column("v"), pa.array(sets, pa.binary())], ["v", "members"])

    return run


def log_likelihood(jaccard: np.ndarray, share: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of the similarity, given how many registers of the first set are larger,
    smaller and equal; ``share`` is its part of the two sizes together."""
    def passes(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    u, v = share, 1 - share
    more = passes(np.maximum(u - v * jaccard, 0))
    less = passes(np.maximum(v - u * jaccard, 0))
    tiny = 1e-12
    return (
        counts[0] * np.log(np.maximum(more, tiny)) + counts[1] * np.log(np.maximum(less, tiny))
        + counts[2] * np.log(np.maximum(1 - more - less, tiny))
    )


def in_doubt(counts: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs may have ``percent`` similarity, by the joint likelihood of their registers."""
    share, most = n_a / (n_a + n_b), np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    free = np.max([log_likelihood(most * g, share, counts) for g in np.linspace(0, 1, 41)], axis=0)
    least = percent / 100
    allowed = np.max(
        [log_likelihood(least + (most - least) * g, share, counts) for g in np.linspace(0, 1, 11)], axis=0
    )
    return (most >= least - 1e-12) & (free - allowed <= DOUBT)


def order_counts(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """How many registers are larger, smaller and equal."""
    return np.stack([(first > second).sum(-1), (first < second).sum(-1), (first == second).sum(-1)])


def _judge(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS)
                for c in ("registers_a", "registers_b")
            )
            n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            possible = in_doubt(order_counts(first, second), n_a, n_b, percent)
            yield batch.select(["a", "b"]).filter(pa.array(possible))

    return run


def _packed(values: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of binaries in a row, uncopied, and where each ends, after a 0."""
    _, ends, data = values.buffers()
    ends = np.frombuffer(ends, np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


class _Blocks:
    """A column of lists of vertices: component, size, registers, and the full set where it is there."""

    def __init__(self, column: pa.ListArray):
        offsets = column.offsets.to_numpy().astype(np.int64)
        self._ends = offsets - offsets[0]
        v, c, n, sketches, *sets = column.flatten().flatten()
        self.v, self.c, self.n = v.to_numpy(), c.to_numpy(), n.to_numpy().astype(float)
        self.registers = _packed(sketches)[0].view("<u2").reshape(-1, REGISTERS)
        if sets:
            raw, ends = _packed(sets[0])
            self.sets, self.ends = raw.view("<u8"), ends // 8

    def row(self, r: int) -> slice:
        return slice(int(self._ends[r]), int(self._ends[r + 1]))

    def set_of(self, i: int) -> np.ndarray:
        return self.sets[self.ends[i] : self.ends[i + 1]]


def common_with(own: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each of the sorted ``sets`` shares with the sorted ``own``."""
    flat = np.concatenate(sets)
    found = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
    starts = np.cumsum([0, *map(len, sets[:-1])])
    return np.add.reduceat(found.astype(np.int64), starts)


class Union:
    """Which components have been joined."""

    def __init__(self):
        self._above: dict[int, int] = {}

    def root(self, c: int) -> int:
        top = c
        while (up := self._above.get(top, top)) != top:
            top = up
        while c != top:
            self._above[c], c = top, self._above.get(c, c)
        return top

    def join(self, a: int, b: int) -> bool:
        """Whether they were apart."""
        a, b = self.root(a), self.root(b)
        self._above[max(a, b)] = min(a, b)
        return a != b


def least_equal(percent: int) -> int:
    """The most equal registers of which a link of just the threshold has fewer with ``MISS`` at most."""
    p, below = percent / 100, 0.0
    for k in range(REGISTERS + 1):
        below += math.comb(REGISTERS, k) * p**k * (1 - p) ** (REGISTERS - k)
        if below > MISS:
            return k
    return REGISTERS


def _compared(batch: pa.RecordBatch, strays: _Blocks, members: _Blocks, joined: Union, percent: int, bands: int, wide: int):
    """Row, stray, and the members of its bucket that its registers leave in doubt.

    Registers are equal with the probability of the similarity. A pair with fewer
    equal ones than ``least_equal`` is not worth the joint estimate. A pair is tried
    in the first of its common bands only, and not when its components are joined.
    """
    floor = least_equal(percent)
    for r, (band, main) in enumerate(zip(*(batch.column(x).to_pylist() for x in ("band", "main")), strict=True)):
        at = members.row(r)
        other, v, c, n = members.registers[at], members.v[at], members.c[at], members.n[at]
        for i in range(*strays.row(r).indices(len(strays.v))):
            equal = other == strays.registers[i]
            # Of two strays the one with the smaller number has the pair.
            near = (c != strays.c[i]) & (equal.sum(axis=1) >= floor) & ((c == main) | (v > strays.v[i]))
            near = np.flatnonzero(near)
            agree = equal[near, : bands * wide].reshape(len(near), bands, wide).all(axis=2)
            near = near[agree.argmax(axis=1) == band]
            mine = joined.root(int(strays.c[i]))
            near = near[np.array([joined.root(x) != mine for x in c[near].tolist()], bool)]
            if len(near):
                counts = order_counts(strays.registers[i], other[near])
                near = near[in_doubt(counts, np.full(len(near), strays.n[i]), n[near], percent)]
            if len(near):
                yield r, i, near + at.start


def _doubtful(percent: int, bands: int, wide: int):
    """Buckets and those of their vertices that are in some pair in doubt, once for each row of blocks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strays, members = _Blocks(batch.column("strays")), _Blocks(batch.column("members"))
            buckets = batch.column("bucket").to_pylist()
            found: set[tuple[int, int]] = set()
            for r, i, near in _compared(batch, strays, members, Union(), percent, bands, wide):
                found.add((buckets[r], int(strays.v[i])))
                found.update((buckets[r], v) for v in members.v[near].tolist())
            ends = np.array(sorted(found), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["bucket", "v"])
        give_back()

    return run


def _links(percent: int, bands: int, wide: int):
    """Links between strays and members, confirmed on full sets, as far as they join components."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined = Union()
        for batch in batches:
            links: list[tuple[int, int]] = []
            strays, members = _Blocks(batch.column("strays")), _Blocks(batch.column("members"))
            for _, i, near in _compared(batch, strays, members, joined, percent, bands, wide):
                own = strays.set_of(i)
                common = common_with(own, [members.set_of(j) for j in near.tolist()])
                close = near[100 * common >= percent * (len(own) + members.n[near].astype(np.int64) - common)]
                for j in close.tolist():
                    if joined.join(int(strays.c[i]), int(members.c[j])):
                        links.append((int(strays.v[i]), int(members.v[j])))
            ends = np.array(links, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])
        give_back()

    return run


def _confirm(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for first, second in zip(batch.column("members_a"), batch.column("members_b"), strict=True):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (first, second))
                common = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, row_key, n_shingles, set_key, registers`` for every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(), "text")
    return rows.mapInArrow(_sketcher(size), SKETCHES)


def near_groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, row_key, n_shingles, component, component_id, kept`` for every row.

    ``docs`` has ``doc_id, text``; other columns are not read. Documents are
    linked when ``100 * intersection >= percent * union`` of their sets of
    ``size``-word shingles; a shorter text is one shingle. Components are what
    links connect, ``component_id`` is the smallest ``doc_id`` of one, and that
    document is kept. Null, empty and wordless texts have an empty set, are linked
    with nothing (``component`` null) and kept. Repeated rows and null ids belong
    to the component of their text; a null id is kept only where a component has
    no other. An empty table gives an empty result. Bands follow from ``percent``;
    one too low for the registers (5 or less) is refused.

    Equal sets are one vertex from the start, so copies cost one row each and
    are never paired. Buckets are worked off in three rounds, after each of which
    links merge components. First the vertex of a bucket that shares most buckets
    is compared with the others, then the one that does so among the strays,
    those outside the largest component. At last every stray meets blocks of its
    bucket, first sketches and then the full sets of what these leave in doubt, and
    is compared inside the task; of the links those come out that join components. Vertices of one component are not compared,
    so every pair that meets in a bucket is judged or already connected: nothing is
    capped, and no more rows come out than there are components.
    """
    return stored_alone(docs.sparkSession, "near-groups", lambda: _near_groups(docs, size, percent))


def _near_groups(docs: DataFrame, size: int, percent: int) -> DataFrame:
    sketches = stored(sketched(docs, size), "sketches")
    vertices = sketches.where("set_key is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("label"),
        F.min(F.struct("doc_id", "row_key")).alias("rep"),
        F.first("n_shingles").alias("n"),
        F.first("registers").alias("registers"),
    )
    # Numbered once and written down.
    vertices = stored(vertices.withColumn("v", F.monotonically_increasing_id()), "vertices")

    bands, wide = bands_for(percent)
    band = F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band")
    width = 2 * wide
    entries = vertices.select("v", "registers", band).select(
        "v", "band", F.xxhash64("band", F.substring("registers", F.col("band") * width + 1, F.lit(width))).alias("bucket")
    )
    # Written down, so that the join shuffles both sides for itself and hot buckets are split.
    full = stored(entries.groupBy("bucket").count().where("count > 1"), "full-buckets")
    members = stored(entries.join(full, "bucket").select("bucket", "band", "v", "count"), "buckets")
    degree = members.groupBy("v").agg(F.sum("count").alias("degree"))
    component = stored(degree.select("v", "degree", F.col("v").alias("c")), "components")
    sets = _sets_of(docs, vertices, component, size)

    members, tested = members.select("bucket", "band", "v"), None
    for round_ in ROUNDS:
        at = members.join(small(component), "v")
        kinds = at.groupBy("bucket", "c").count()
        shape = kinds.groupBy("bucket").agg(
            F.max_by("c", F.struct("count", "c")).alias("main"),
            F.sum("count").alias("size"), F.count("*").alias("kinds"),
        )
        shape = stored(shape.where("kinds > 1").drop("kinds"), "active-buckets")
        at = stored(at.join(small(shape), "bucket"), "active")
        if at.isEmpty():
            break
        if round_.endswith("leader"):
            pairs = _led(at if round_ == "leader" else at.where("c <> main"), at).distinct()
            pairs = stored(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
            tested = pairs if tested is None else tested.unionByName(pairs)
            edges = stored(_confirmed(_judged(pairs, vertices, percent), sets, percent), "links")
        else:
            edges = stored(_block_links(at, vertices, sets, percent, bands, wide), "links")
        label = component.select("v", "c")
        ends = edges.join(small(label.toDF("a", "ca")), "a").join(small(label.toDF("b", "cb")), "b")
        roots = connected_components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        component = stored(
            component.join(small(roots.toDF("c", "root")), "c", "left")
            .select("v", "degree", F.coalesce("root", "c").alias("c")),
            "components",
        )

    named = vertices.select("set_key", "v", "label").join(small(component.select("v", "c")), "v", "left")
    named = named.withColumn("component", F.coalesce("c", "v"))
    lowest = named.groupBy("component").agg(F.min("label").alias("component_id"))
    named = stored(named.join(lowest, "component").select("set_key", "component", "component_id"), "named")
    rows = spread_join(sketches.drop("registers"), named, ["set_key"], "left")
    rows = rows.withColumn(
        "component_id", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    )
    return rows.select(
        "doc_id", "row_key", "n_shingles", "component", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _sets_of(docs: DataFrame, vertices: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``v, members``: the full sets of vertices that share a bucket, read once more from the texts."""
    reps = stored(
        vertices.join(wanted.select("v"), "v").select("v", F.col("rep.doc_id").alias("_id"), F.col("rep.row_key").alias("_key")),
        "representatives",
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(), "text")
    rows = rows.join(small(reps), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row_key") == F.col("_key")))
    read = stored(rows.select("v", "text").mapInArrow(_set_reader(size), "v long, members binary"), "sets")
    # A repeated row would give its set twice.
    return read.dropDuplicates(["v"]) if read.count() > reps.count() else read


def _led(candidates: DataFrame, at: DataFrame) -> DataFrame:
    """One leader per bucket, the candidate that shares most buckets, with all of other components."""
    leaders = candidates.groupBy("bucket").agg(F.max(F.struct("degree", "v", "c")).alias("l"))
    leaders = stored(leaders.select("bucket", F.col("l.v").alias("leader"), F.col("l.c").alias("lc")), "leaders")
    return at.join(small(leaders), "bucket").where("c <> lc").select(
        F.least("v", "leader").alias("a"), F.greatest("v", "leader").alias("b")
    )


def _block_links(
    at: DataFrame, vertices: DataFrame, sets: DataFrame, percent: int, bands: int, wide: int
) -> DataFrame:
    """Links that join components of a bucket, compared and confirmed inside tasks.

    Sketches are compared first. Full sets then travel to those buckets only in which
    their vertex is in a pair in doubt, and there the same pairs are confirmed.
    """
    light = at.join(small(vertices.select("v", "n")), "v")
    light = light.select("bucket", "band", "main", "v", "c", "n", (F.col("c") != F.col("main")).alias("stray"))
    light = stored(light, "strays-and-members")
    met = _meetings(light.join(vertices.select("v", "registers"), "v"), ["v", "c", "n", "registers"], F.lit(2 * REGISTERS))
    doubtful = met.mapInArrow(_doubtful(percent, bands, wide), "bucket long, v long")
    doubtful = stored(doubtful.distinct(), "in-doubt")
    rows = light.join(small(doubtful), ["bucket", "v"], "left_semi")
    rows = rows.join(vertices.select("v", "registers"), "v").join(sets, "v")
    met = _meetings(rows, ["v", "c", "n", "registers", "members"], 8 * F.col("n") + 2 * REGISTERS)
    return met.mapInArrow(_links(percent, bands, wide), "a long, b long")


def _meetings(rows: DataFrame, fields: list[str], weight: Column) -> DataFrame:
    """``bucket, band, main, strays, members``: blocks of strays with all blocks of their bucket.

    The members of a bucket are packed into blocks of about ``BLOCK_BYTES``. Strays
    are those outside the largest component of the bucket; ``BLOCKS_TOGETHER`` blocks
    come under one key of the join.
    """
    rows = stored(rows.withColumn("weight", weight), "members-of-blocks")
    slots = rows.groupBy("bucket").agg(F.ceil(F.sum("weight") / BLOCK_BYTES).alias("slots"))
    rows = rows.join(small(stored(slots.where("slots > 1"), "slots")), "bucket", "left").withColumn("slots", F.coalesce("slots", F.lit(1)))
    rows = rows.select(
        "bucket", "band", "main", "stray", F.pmod(F.xxhash64("v"), F.col("slots")).alias("slot"),
        F.ceil(F.col("slots") / BLOCKS_TOGETHER).alias("wholes"), F.struct(*fields).alias("x"),
    )
    whole = F.floor(F.col("slot") / BLOCKS_TOGETHER).alias("whole")
    blocks = rows.groupBy("bucket", "band", "main", "slot").agg(F.collect_list("x").alias("members"))
    strays = rows.where("stray").groupBy("bucket", "slot", "wholes").agg(F.collect_list("x").alias("strays"))
    strays = strays.select("bucket", "strays", F.explode(F.sequence(F.lit(0).cast("long"), F.col("wholes") - 1)).alias("whole"))
    joined = strays.join(blocks.select("bucket", "band", "main", whole, "members"), ["bucket", "whole"])
    return joined.select("bucket", "band", "main", "strays", "members")


def _side(table: DataFrame, end: str) -> DataFrame:
    return table.toDF(end, *[f"{c}_{end}" for c in table.columns[1:]])


def _judged(pairs: DataFrame, vertices: DataFrame, percent: int) -> DataFrame:
    """The pairs that the registers leave in doubt."""
    sketch = vertices.select("v", "n", "registers")
    return pairs.join(_side(sketch, "a"), "a").join(_side(sketch, "b"), "b").mapInArrow(
        _judge(percent), "a long, b long"
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    return pairs.join(_side(sets, "a"), "a").join(_side(sets, "b"), "b").mapInArrow(
        _confirm(percent), "a long, b long"
    )


def op8_near_dedup(spark, sf_dir):
    """Every document with its near-duplicate component."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = near_groups(docs, size=3, percent=85)
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


ORACLE_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS shingles
  FROM texts
), items AS (
  SELECT doc_id, len(shingles) AS n, hash(unnest(shingles)) AS shingle FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT r.doc_id, p.b FROM reach r JOIN pairs p ON p.a = r.other
), lowest AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT s.doc_id, len(s.shingles) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN lowest l USING (doc_id)
"""
