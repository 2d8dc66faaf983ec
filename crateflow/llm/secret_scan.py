"""Secret scans: certain secrets by pattern, weak ones by what stands near them.

Credentials often come in parts: an access identifier, a secret and an
endpoint. Each part alone is weak evidence. The parts of a document are joined
by interval: a weak candidate is reported only when complementary parts lie
within ``SCOPE`` characters of it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateflow.llm.words import slices
from crateflow.session import stored, stored_alone

SCOPE = 200
# Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "weak_secret", "weak_id", "endpoint")
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
HINT = re.compile(r"(?ai:password|passwd|secret|token|api_?key)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
# Weak parts: a long run that mixes cases and digits, a user name, an address.
# None has an upper length; possessive repeats keep the scan linear.
RUN = re.compile(r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/=_-])")
USER = re.compile(r"""\b(?ai:user(?:_?name)?|login|account(?:_?id)?|client_?id|access_?key_?id)["']?[ \t]*[:=][ \t]*["']?[\w.@+-]{3,}+""")
PLACE = re.compile(r"""\b(?:(?ai:https?|s3|postgres(?:ql)?|mysql|redis|amqp)://[^\s"'<>]{3,}+|(?ai:host(?:name)?|endpoint|server)["']?[ \t]*[:=][ \t]*["']?[\w.-]{4,}+)""")
# Identifiers and endpoints that overlap what goes before them: never reported, but
# still the complement of others.
EVIDENCE = {4: 6, 5: 7}
SPAN = "struct<kind:int,start:int,end:int>"
PARTS = f"row long, doc_id long, parts array<{SPAN}>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Certain secrets as (kind, start, end) in code points."""
    out = []
    if HINT.search(text):
        out += [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(1, *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return out + [(2, *m.span()) for m in HEX.finditer(text)]


def apart(spans: list[tuple[int, int, int]], taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans that overlap none of ``taken``."""
    starts, reach, out = [], [], []
    for _, start, end in sorted(taken, key=lambda span: span[1:]):
        starts.append(start)
        reach.append(max(end, reach[-1] if reach else 0))
    for span in spans:
        i = bisect_left(starts, span[2])
        if not i or reach[i - 1] <= span[1]:
            out.append(span)
    return out


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Possible parts of a credential, which are nothing by themselves, beside the ``base``.

    Identifiers and endpoints that overlap a certain secret, and identifiers within
    an endpoint, come as ``EVIDENCE``.
    """
    named, hidden, runs = [], [], [
        (3, *m.span()) for m in RUN.finditer(text)
        if not m[0].islower() and not m[0].isupper() and not m[0].isdigit()
    ]
    if ":" in text or "=" in text:
        places = [(5, *m.span()) for m in PLACE.finditer(text)]
        users = [(4, *m.span()) for m in USER.finditer(text)]
        named = apart(places + apart(users, places), base)
        hidden = [(EVIDENCE[kind], *ends) for kind, *ends in set(places + users).difference(named)]
    return named + apart(runs, base + named) + hidden


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("kind", "start", "end")
    kind = pa.list_(pa.struct([(n, pa.int32()) for n in names]))
    for batch in slices(batches, "text"):
        parts = []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            spans = base + weak_spans(text or "", base)
            parts.append([dict(zip(names, span, strict=True)) for span in spans])
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), pa.array(parts, kind)], ["row", "doc_id", "parts"]
        )


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak candidates of ``row, kind, start, end`` with complementary parts in scope.

    A secret needs an identifier or an endpoint, an identifier needs a secret, an
    endpoint needs both. Identifiers are access identifiers and user names;
    secrets are assigned, hexadecimal and weak ones. ``EVIDENCE`` serves as such but
    is no candidate. Two parts are in scope when
    at most ``scope`` characters lie between them.

    The interval join works on bins as wide as the scope. Each bin and role is
    reduced to its nearest ends, and a candidate meets the bins it touches and
    their neighbours by equal (row, bin): as many lookups as bins, never pairs of
    parts. The ends decide exactly: to the left only the largest end matters, to
    the right the smallest start, and what touches a bin of the candidate is in
    scope anyway.
    """
    role = (
        F.when(F.col("kind").isin(1, 4, 6), "id").when(F.col("kind").isin(0, 2, 3), "secret").otherwise("place")
    )
    parts = parts.withColumn("role", role)
    bin_of = lambda at: F.floor(F.col(at) / scope)
    # A long span takes part in every bin it touches.
    touched = parts.withColumn("bin", F.explode(F.sequence(bin_of("start"), F.floor((F.col("end") - 1) / scope))))
    ends = touched.groupBy("row", "bin", "role").agg(F.min("start").alias("first"), F.max("end").alias("last"))
    weak = parts.where("kind between 3 and 5").withColumn(
        "bin",
        F.explode(F.sequence(bin_of("start") - 1, F.floor((F.col("end") - 1) / scope) + 1)),
    )
    near = weak.alias("w").join(ends.alias("e"), ["row", "bin"]).where(
        (F.col("e.role") != F.col("w.role"))
        & (F.col("e.first") <= F.col("w.end") + scope)
        & (F.col("e.last") >= F.col("w.start") - scope)
    )
    has = lambda name: F.max(F.col("e.role") == name)
    seen = near.groupBy("row", "kind", "start", "end").agg(
        has("id").alias("id"), has("secret").alias("secret"), has("place").alias("place")
    )
    return seen.where(
        "(kind = 3 and (id or place)) or (kind = 4 and secret) or (kind = 5 and id and secret)"
    ).select("row", "kind", "start", "end")


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``doc_id, spans`` for every row of ``docs``: kind, start and end of each finding.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. ``spans``
    holds certain secrets and linked weak ones by start, then kind (an index into
    ``KINDS``), in code points, end exclusive. Weak parts that overlap a certain
    one are left out, though as identifiers and endpoints they still link others. A null or empty text has none; repeated rows and null ids
    give a row each.
    """
    return stored_alone(docs.sparkSession, "secrets", lambda: _find_secrets(docs, scope))


def _find_secrets(docs: DataFrame, scope: int) -> DataFrame:
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    ).mapInArrow(_parts, PARTS)
    # The row number is written down once, so later passes see the same.
    rows = stored(rows, "secret-parts")
    found = linked(rows.select("row", F.explode("parts").alias("p")).select("row", "p.*"), scope)
    span = F.struct("start", "kind", "end")
    found = found.groupBy("row").agg(F.collect_list(span).alias("weak"))
    certain = F.transform(
        F.filter("parts", lambda p: p["kind"] < 3),
        lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end")),
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return rows.join(found, "row", "left").select(
        "doc_id", F.sort_array(F.concat(certain, F.coalesce("weak", none))).alias("spans")
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
        )), ",",
    )


def op3_secret_scan(spark, sf_dir):
    """Secrets in every document, with counts and digest of the certain ones."""
    rows = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id",
        count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
