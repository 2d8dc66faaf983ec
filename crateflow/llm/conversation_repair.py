"""Cheapest repair of the turn structure of conversations.

A conversation is sound when the first letters of its roles read ``(s?(ua)+)?``. Turns
are kept, given another role or deleted, and empty turns are inserted. The costs of
the rest of a conversation, one for each state of that pattern, are computed from
its end; of these vectors only every square root of the length is held, and a walk
from the start computes those in between again, block by block, and takes the edit
that comes first in ASCII among the cheapest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.llm.words import slices
from crateflow.plans.spread import spread_join
from crateflow.session import stored, stored_alone

# Cost of each edit, and of a truncated turn that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED_KEPT = 1, 2, 5, 5
# States: nothing yet, after system, after user, after assistant. In each, the
# letter of the turn that may follow, and where a user or assistant turn leads.
START, SYSTEM, USER, ASSISTANT = range(4)
EXPECTED = "uuau"
ONWARD = (USER, USER, ASSISTANT, USER)
# Cost of the turns that are missing at the end.
AT_END = (0, 2 * INSERT, INSERT, 0)
ROLE = {"u": "user", "a": "assistant"}
# A turn in one byte: first letter of its role, and its faults.
LETTERS = "sua?"
BLANK, DUPLICATE, TRUNCATED = 4, 8, 16
WHITE = " \t\n\x0b\x0c\r"
# Bytes of audits handed on at a time.
HANDED_ON = 1 << 20

AUDITS = (
    "key string, conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long,"
    " cost long, audit string"
)
TURNS = "conv_id long, place long, edit string, turn long, role string, text string"


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults, by the checksum of ``conv_id:turn`` modulo 20.

    0 drops the turn, 1 empties its text, 2 takes away its full stops, exclamation and
    question marks, 3 repeats it, 4 makes its role ``user``. A null reads as a space.
    """
    space = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"), (F.crc32(F.concat(conv, F.lit(":"), turn)) % 20).alias("_kind"),
    ).where("_kind <> 0")
    kind = F.col("_kind")
    times = F.array_repeat(F.lit(1), F.when(kind == 3, 2).otherwise(1))
    return rows.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(times).alias("_time"),
    ).drop("_time")


def _lines(turns: DataFrame) -> DataFrame:
    """Turns with a key that is never null and a digest that orders turns of one number."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    line = F.concat(F.length(role).cast("string"), F.lit(":"), role, F.lit(":"), text)
    return turns.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"), F.unhex(F.sha2(line, 256)).alias("digest"),
    )


def _coded(lines: DataFrame) -> DataFrame:
    """``key, conv_id, turn, digest, code``: turns without their texts."""
    said = F.rtrim("text", F.lit(WHITE))
    letter = F.substring("role", 1, 1)
    first = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3)
    fault = F.when(said == "", BLANK).when(~F.substring(said, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    rows = stored(lines.select("key", "conv_id", "turn", "digest", (first + fault).alias("code")), "turns")
    # Only what occurs more than once can be a repetition of something earlier.
    order = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    firsts = rows.groupBy("key", "digest").agg(F.count("*").alias("times"), F.min(order).alias("first"))
    firsts = stored(firsts.where("times > 1").drop("times"), "repeated")
    rows = spread_join(rows, firsts, ["key", "digest"], keys_from=rows)
    later = F.coalesce(order > F.col("first"), F.lit(False)) & (F.col("code") < BLANK)
    worse = F.coalesce(order > F.col("first"), F.lit(False)) & (F.col("code") >= TRUNCATED)
    code = F.when(later, F.col("code") + DUPLICATE).when(worse, F.col("code") - TRUNCATED + DUPLICATE)
    return rows.select("key", "conv_id", "turn", "digest", F.coalesce(code, "code").cast("int").alias("code"))


def next_state(state: int, letter: str) -> int | None:
    """Where a kept turn leads; None where it may not stand."""
    if state == START and letter == "s":
        return SYSTEM
    return ONWARD[state] if letter == EXPECTED[state] else None


def _edits(state: int, code: int) -> list[tuple[str, int, int]]:
    """What may become of a turn: letter of the edit, cost and state behind it; in ASCII order."""
    found = [("D", DELETE, state)]
    if not code & (BLANK | DUPLICATE):
        extra = TRUNCATED_KEPT if code & TRUNCATED else 0
        onward = next_state(state, LETTERS[code & 3])
        if onward is not None:
            found.append(("K", extra, onward))
        found.append(("R", REROLE + extra, ONWARD[state]))
    return found


@lru_cache(maxsize=1 << 16)
def _before(rest: tuple[int, ...], code: int) -> tuple[int, ...]:
    """Costs from in front of a turn, given those from behind it."""
    costs = [min(cost + rest[to] for _, cost, to in _edits(state, code)) for state in range(4)]
    costs[USER], costs[ASSISTANT] = (
        min(costs[USER], INSERT + costs[ASSISTANT]), min(costs[ASSISTANT], INSERT + costs[USER])
    )
    for state in (START, SYSTEM):
        costs[state] = min(costs[state], INSERT + costs[USER])
    return tuple(costs)


def before(rest: tuple[int, ...], code: int) -> tuple[int, ...]:
    """``_before``, remembered for costs less the smallest, of which there are few."""
    low = min(rest)
    return tuple(low + x for x in _before(tuple(x - low for x in rest), code))


def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and ASCII-least letters of the cheapest edits of a conversation."""
    n = len(codes)
    block = max(isqrt(n), 1)
    held = {n: AT_END}
    rest = AT_END
    for i in range(n - 1, -1, -1):
        rest = before(rest, codes[i])
        if i % block == 0:
            held[i] = rest
    total, state, audit = rest[START], START, []
    for start in range(0, n, block):
        stop = min(start + block, n)
        ahead = [held[stop]]
        for i in range(stop - 1, start - 1, -1):
            ahead.append(before(ahead[-1], codes[i]))
        letters = []
        for i in range(start, stop):
            here, rest = ahead[stop - i], ahead[stop - i - 1]
            while True:
                tight = [(e, to) for e, cost, to in _edits(state, codes[i]) if cost + rest[to] == here[state]]
                # I stands between D and the others
                if (not tight or tight[0][0] > "I") and INSERT + here[ONWARD[state]] == here[state]:
                    letters.append("I")
                    state = ONWARD[state]
                    continue
                edit, state = tight[0]
                letters.append(edit)
                break
        audit.append("".join(letters))
    audit.append("I" * (AT_END[state] // INSERT))
    return total, "".join(audit)


class _Conversation:
    """What is kept of a conversation while its turns pass: a byte for each."""

    def __init__(self, key: str, conv_id: int | None):
        self.key, self.conv_id = key, conv_id
        self.codes = bytearray()
        self.low = self.high = self.last = None
        self.distinct = self.illegal = 0

    def add(self, turn: int | None, digest: bytes, code: int) -> None:
        # equal turns of one number are neighbours
        if self.last == (turn, digest) and not code & BLANK:
            code = code & 3 | DUPLICATE
        if turn is not None:
            if self.last is None or self.last[0] != turn:
                self.distinct += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.codes:
            pair = LETTERS[self.codes[-1] & 3] + LETTERS[code & 3]
            self.illegal += pair not in ("su", "ua", "au")
        self.codes.append(code)
        self.last = turn, digest

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        faults = [sum(map(self.codes.count, range(fault, fault + 4))) for fault in (BLANK, DUPLICATE, TRUNCATED)]
        return (self.key, self.conv_id, gaps, *faults, self.illegal, *cheapest(bytes(self.codes)))


def _audit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        names = [part.split()[0] for part in AUDITS.split(", ")]
        kinds = [pa.string(), *[pa.int64()] * 7, pa.string()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    now, done, size = None, [], 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("key", "conv_id", "turn", "digest", "code"))
        for key, conv_id, turn, digest, code in zip(*columns, strict=True):
            if now is None or now.key != key:
                if now is not None:
                    done.append(now.row())
                    size += len(done[-1][-1]) + 100
                    if size > HANDED_ON:
                        yield batch_of(done)
                        done, size = [], 0
                now = _Conversation(key, conv_id)
            now.add(turn, digest, code)
    if now is not None:
        done.append(now.row())
    yield batch_of(done)


def audited(turns: DataFrame) -> DataFrame:
    """``key, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` for every conversation.

    ``turns`` has ``conv_id, turn, role, text``; other columns are not read. Turns are
    taken by number, those without one first, turns of one number by a digest of role
    and text. A null role or text is a space, a null ``conv_id`` a conversation of its
    own. The first fault of a turn counts: blank, a repetition of an earlier role and
    text, or an end without full stop, exclamation or question mark. ``gaps`` are the
    missing numbers, ``illegal`` the neighbours whose letters are not ``su``, ``ua``
    or ``au``. ``audit`` has a letter for each edit: D(elete), I(nsert), K(eep),
    R(erole). An empty table gives an empty result.

    Texts stay behind: a turn travels as a digest and a byte, and a task that
    works on a conversation holds a byte for each turn, as the audit itself does.
    """
    rows = _coded(_lines(turns)).repartition("key").sortWithinPartitions("key", "turn", "digest")
    return rows.mapInArrow(_audit, AUDITS)


def _rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns as their audit says; the audit comes in front of the turns of its conversation."""
    names = [part.split()[0] for part in TURNS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    out: list[tuple] = []
    conv_id, audit, at, state, place = None, "", 0, START, 0

    def insert() -> None:
        nonlocal at, state, place
        while audit[at : at + 1] == "I":
            out.append((conv_id, place, "I", None, ROLE[EXPECTED[state]], ""))
            at, state, place = at + 1, ONWARD[state], place + 1

    for batch in slices(batches, "text"):
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "kind", "turn", "role", "text"))
        for conv, kind, turn, role, text in zip(*columns, strict=True):
            if kind == 0:
                insert()
                conv_id, audit, at, state, place = conv, text, 0, START, 0
                continue
            insert()
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            if edit == "R":
                role = ROLE[EXPECTED[state]]
            out.append((conv_id, place, edit, turn, role, text))
            state, place = next_state(state, role[0]), place + 1
        yield _turns_of(out, names, kinds)
        out.clear()
    insert()
    yield _turns_of(out, names, kinds)


def _turns_of(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def repaired(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv_id, place, edit, turn, role, text``: the turns of sound conversations.

    ``audits`` is what ``audited`` gives for the same turns, stored. Within a partition
    the turns of a conversation come one after the other in order of ``place``. Turns
    are streamed through a task after a sort that may spill, so a conversation of
    any length passes; a task holds its audit and a slice of turns.
    """
    lines = _lines(turns).select(
        "key", "conv_id", F.lit(1).alias("kind"), "turn", "digest", "role", "text"
    )
    heads = audits.select(
        "key", "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
        F.lit(None).cast("binary").alias("digest"), F.lit("").alias("role"), F.col("audit").alias("text"),
    )
    rows = lines.unionByName(heads).repartition("key").sortWithinPartitions("key", "kind", "turn", "digest")
    return rows.mapInArrow(_rewrite, TURNS)


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    running, of = None, None
    for batch in batches:
        ids, sums = [], []
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text"))
        for conv_id, place, role, text in zip(*columns, strict=True):
            if place == 0:
                if running is not None:
                    ids.append(of)
                    sums.append(running.hexdigest())
                running, of = hashlib.sha256(), conv_id
            else:
                running.update(b"\n")
            running.update(f"{role}:{text}".encode())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sums, pa.string())], ["conv_id", "sha256"])
    if running is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([of], pa.int64()), pa.array([running.hexdigest()], pa.string())], ["conv_id", "sha256"]
        )


def digests(turns: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of the lines ``role:text``; ``turns`` as ``repaired`` gives them, not stored before."""
    return turns.mapInArrow(_digest, "conv_id long, sha256 string")


def repair_report(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """A row for every conversation of ``conversations``, with what was done to its ``turns``.

    Conversations without a turn have zeros, an empty audit and the digest of nothing.
    """
    return stored_alone(conversations.sparkSession, "repaired", lambda: _repair_report(conversations, turns))


def _repair_report(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    audits = stored(audited(turns), "audits")
    sums = digests(repaired(turns, audits))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = audits.drop("key").withColumnRenamed("conv_id", "_audited")
    rows = every.join(found, F.col("conv_id").eqNullSafe(F.col("_audited")), "left")
    sums = sums.withColumnRenamed("conv_id", "_summed")
    rows = rows.join(sums, F.col("conv_id").eqNullSafe(F.col("_summed")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return rows.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def op12_conversation_repair(spark, sf_dir):
    """Every conversation with the cheapest repair of its damaged turns."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair_report(conversations, damaged(conversations))


ORACLE_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), read AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
), kinds AS (
  SELECT r.*, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(name, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS kind
  FROM read r, bits
), lines AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(length(role) || ':' || role || ':' || text), copy) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said, left(role, 1) AS letter
  FROM lines
), judged AS (
  SELECT *, CASE WHEN said = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(letter) OVER (PARTITION BY conv_id ORDER BY i) || letter AS pair
  FROM numbered
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), inserted(q, k, after, word, lines) AS (
  VALUES (0, 0, 0, '', []), (1, 0, 1, '', []), (2, 0, 2, '', []), (3, 0, 3, '', []),
    (0, 1, 2, 'I', ['user:']), (1, 1, 2, 'I', ['user:']), (2, 1, 3, 'I', ['assistant:']), (3, 1, 2, 'I', ['user:']),
    (0, 2, 3, 'II', ['user:', 'assistant:']), (1, 2, 3, 'II', ['user:', 'assistant:'])
), best AS (
  SELECT conv_id, n, 0::BIGINT AS i, 0 AS q, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} AS b FROM counted
  UNION ALL
  SELECT conv_id, n, i, q, min(b) FROM (
    SELECT p.conv_id, p.n, j.i,
      CASE e.edit WHEN 'D' THEN s.after WHEN 'K' THEN CASE j.letter WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
        ELSE CASE s.after WHEN 2 THEN 3 ELSE 2 END END AS q,
      {'cost': p.b.cost + 5 * s.k + CASE e.edit WHEN 'D' THEN 2 WHEN 'K' THEN 0 ELSE 1 END
          + CASE WHEN e.edit <> 'D' AND j.fault = 'truncated' THEN 5 ELSE 0 END,
        'audit': p.b.audit || s.word || e.edit,
        'lines': p.b.lines || s.lines::VARCHAR[] || CASE e.edit WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [j.role || ':' || j.text]
          ELSE [CASE s.after WHEN 2 THEN 'assistant:' ELSE 'user:' END || j.text] END} AS b
    FROM best p JOIN inserted s ON s.q = p.q
      JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.i = p.i + 1
      JOIN (VALUES ('D'), ('K'), ('R')) e(edit) ON e.edit = 'D' OR (j.fault NOT IN ('blank', 'duplicate') AND (e.edit = 'R'
        OR (s.after = 0 AND j.letter IN ('s', 'u')) OR (s.after IN (1, 3) AND j.letter = 'u') OR (s.after = 2 AND j.letter = 'a')))
  ) GROUP BY conv_id, n, i, q
), ended AS (
  SELECT p.conv_id, min({'cost': p.b.cost + 5 * s.k, 'audit': p.b.audit || s.word, 'lines': p.b.lines || s.lines::VARCHAR[]}) AS b
  FROM best p JOIN inserted s ON s.q = p.q WHERE p.i = p.n AND s.after IN (0, 3) GROUP BY p.conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank,
  coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
  coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(e.b.cost, 0)::BIGINT AS cost,
  coalesce(e.b.audit, '') AS audit, sha256(coalesce(array_to_string(e.b.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
