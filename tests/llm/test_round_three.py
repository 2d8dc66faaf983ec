"""Source divergence, conversation repair and packing against plain versions of their rules."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crateflow.llm import conversation_repair as repair
from crateflow.llm import divergence, near_dedup, packing, quality

WORD = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, value date, rank string"


# --- source divergence -----------------------------------------------------------


def plain_divergence(docs, min_docs, top):
    def terms(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)

    counts, in_docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in docs:
        counts[lang or "", source or ""].update(terms(text))
        in_docs[lang or ""].update(set(terms(text)))
    out = Counter()
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in in_docs | {lang: 0 for lang, _ in counts}:
        kept = sorted(t for t, n in in_docs[lang].items() if n >= min_docs)

        def shares(found, kept=kept):
            n = sum(found[t] for t in kept)
            return {t: 1 + 10**9 * (found[t] + 2) // (n + 2 * len(kept)) for t in kept}

        groups = {s: c for (own, s), c in counts.items() if own == lang}
        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            found = [(f(p[s][t], q[t]), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", found, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out.update((lang, s, part, item, v, r) for r, (v, item) in enumerate(ranked, 1))
    return out


def test_source_divergence(spark):
    rnd = random.Random(3)
    words = ["alpha", "Beta", "gamma", "été", "Été", "日本", "zeta9eta", "x_y", "don't", "İ"]
    docs = [
        (i % 40, " ".join(rnd.choices(words, k=rnd.randrange(30))), rnd.choice(["en", "fr", None]),
         rnd.choice(["a", "b", "c", "é", "", None]), None, "x")
        for i in range(120)
    ]
    docs += [(1, None, "en", "empty", None, None), (2, "", "it", "alone", None, None), (None, "rare", "it", "two", None, None)]
    docs += [docs[0]] * 3 + [(7, "long " * 300_000 + "q" * 70_000, "en", "a", None, None)]
    df = spark.createDataFrame(docs, DOCS).repartition(5)
    got = divergence.source_divergence(df, 4, 3)
    assert Counter(map(tuple, got.collect())) == plain_divergence(docs, 4, 3)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert divergence.source_divergence(df.limit(0)).count() == 0


def test_shares_are_exact_beyond_long(spark):
    counts, total, v = 9 * 10**15, 10**18, 10**6
    row = spark.range(1).selectExpr(f"{counts}L AS n", f"{total}L AS t", f"{v}L AS v")
    from pyspark.sql import functions as F

    got = row.select(divergence.share(F.col("n"), F.col("t"), F.col("v"))).first()[0]
    assert got == 1 + 10**9 * (counts + 2) // (total + 2 * v)


# --- conversation repair -----------------------------------------------------------


def plain_repair(letters, faults):
    """The cheapest and then ASCII-least edits, out of all that could be cheapest."""
    best = None
    step = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    todo = [(0, 0, 0, "")]
    limit = 2 * len(letters)
    while todo:
        i, state, cost, audit = todo.pop()
        if cost > limit:
            continue
        if i == len(letters) and state in (0, 3):
            best = min(best or (cost, audit), (cost, audit))
        onward = [q for role, q in step[state].items() if role != "s"][0]
        todo.append((i, onward, cost + 5, audit + "I"))
        if i < len(letters):
            todo.append((i + 1, state, cost + 2, audit + "D"))
            if faults[i] not in ("blank", "duplicate"):
                more = cost + (5 if faults[i] == "truncated" else 0)
                if letters[i] in step[state]:
                    todo.append((i + 1, step[state][letters[i]], more, audit + "K"))
                todo.append((i + 1, onward, more + 1, audit + "R"))
    return best


def test_cheapest_edits_of_all_short_conversations():
    kinds = [(letter, fault) for letter in "sua?" for fault in ("", "blank", "truncated")]
    code = {"": 0, "blank": repair.BLANK, "duplicate": repair.DUPLICATE, "truncated": repair.TRUNCATED}
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            codes = bytes("sua?".index(x) | code[f] for x, f in rows)
            assert repair.cheapest(codes) == plain_repair([x for x, _ in rows], [f for _, f in rows])
    rnd = random.Random(5)
    for _ in range(60):
        rows = [(rnd.choice("suaua?"), rnd.choice(["", "", "truncated", "duplicate"])) for _ in range(rnd.randrange(5, 8))]
        codes = bytes("sua?".index(x) | code[f] for x, f in rows)
        assert repair.cheapest(codes) == plain_repair([x for x, _ in rows], [f for _, f in rows])


def test_a_very_long_conversation_is_repaired():
    cost, audit = repair.cheapest(bytes([1, 2] * 100_000 + [1]))
    assert cost == 2 and audit.count("D") == 1 and audit.count("K") == 200_000


def test_conversations_of_all_kinds(spark):
    turns = [
        (1, None, "user", "Hi."), (1, None, "assistant", "Yes!"), (1, 4, "user", "Hi."), (1, 4, "user", "Hi."),
        (2, 0, None, None), (2, 1, "user", ""), (None, 0, "user", "x" * 100_000), (None, 2, "assistant", "ok.\t\n"),
        (3, 0, "system", "S."), (3, 2, "user", "a.\nb?"), (3, 3, "assistant", "c"), (3, 3, "assistant", "c"),
        (4, 0, "assistant", " \x0b"), (5, 7, "tool", "t."), (5, 9, "user", "é!"), (5, 9, "user", "b"),
    ]
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(turns, schema).selectExpr("*", "1 AS audit", "'x' AS key")
    report = {r["conv_id"]: r for r in repair.repair_report(df, df).collect()}
    assert set(report) == {1, 2, 3, 4, 5, None}
    for conv, row in report.items():
        mine = [(t, r or " ", " " if x is None else x) for c, t, r, x in turns if c == conv]
        mine.sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.sha256(f"{len(t[1])}:{t[1]}:{t[2]}".encode()).digest()))
        faults, seen = [], set()
        for _, role, text in mine:
            said = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not said else "duplicate" if (role, text) in seen else "" if said[-1] in ".!?" else "truncated")
            seen.add((role, text))
        letters = [r[0] if r[0] in "sua" else "?" for _, r, _ in mine]
        assert (row["cost"], row["audit"]) == plain_repair(letters, faults)
        assert [row[f] for f in ("blank", "duplicate", "truncated")] == [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        assert row["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:]))
        numbers = [t for t, _, _ in mine if t is not None]
        assert row["gaps"] == (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0)
    audits = repair.stored(repair.audited(df), "audits")
    lines = defaultdict(list)
    for r in sorted(repair.repaired(df, audits).collect(), key=lambda r: r["place"]):
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for conv, row in report.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines[conv]))
        assert row["repaired_sha256"] == hashlib.sha256("\n".join(lines[conv]).encode()).hexdigest()
    nothing = repair.repair_report(df, df.limit(0)).collect()
    assert {tuple(r)[1:8] for r in nothing} == {(0, 0, 0, 0, 0, 0, "")} and len(nothing) == 6
    assert repair.repair_report(df.limit(0), df.limit(0)).count() == 0


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "system", "One. Two! Three?") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    got = Counter(map(tuple, repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()))
    expected = Counter()
    for c, t, role, text in rows:
        name = f"{' ' if c is None else c}:{' ' if t is None else t}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = role or " ", text or " "
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        if kind:
            expected[c, t, "user" if kind == 4 else role, text] += 2 if kind == 3 else 1
    assert got == expected


# --- packing -----------------------------------------------------------------------


TEXTS = [
    "", None, "One two three.", "Don't stop!!", "<|endoftext|> é É ́x <|STARTOFTEXT|>", "a.b,c;d. (e.) f... 3. ™ ™.x",
    "İstanbul Σ ΣΑΣ ﬁ     日本語 mixed, 12.5 'tis 'S. x's.", "word " * 9000, "z" * 30_000, "Repeat me. " * 50, "Repeat me. " * 50,
]


@pytest.mark.parametrize("length,together", [(2048, 512), (64, 4)])
def test_every_id_is_packed_once(spark, length, together):
    rnd = random.Random(9)
    rows = [(i % 60, t, 1, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", 2, "y")]
    rows += [(100 + i, " ".join(rnd.choices(["alpha", "beta,", "Gamma.", "delta"], k=rnd.randrange(300))), 1, "x") for i in range(150)]
    # one partition a text, so that rows can be told apart below
    df = spark.createDataFrame(rows, "doc_id long, text string, start int, ids string").repartition(3)
    pieces = packing.packed(df, WORD, 1, length=length, together=together).collect()
    library = Tokenizer.from_file(WORD)
    expected = Counter()
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        expected[i, np.array(ids, "<u4").tobytes()] += 1
    total = sum(len(ids) // 4 * n for (_, ids), n in expected.items())
    assert sum(p["length"] for p in pieces) == total == sum(len(p["ids"]) // 4 for p in pieces)
    # pieces of a document join to its ids; documents of one id are told apart by size
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"], p["doc_tokens"]].append((p["start"], bytes(p["ids"])))
    for (i, tokens), found in by_doc.items():
        wanted = [(ids, n) for (j, ids), n in expected.items() if j == i and len(ids) == 4 * tokens]
        if len(wanted) == 1 and wanted[0][1] == 1:
            assert b"".join(ids for _, ids in sorted(found)) == wanted[0][0]
        assert sum(len(ids) for _, ids in found) == sum(len(ids) * n for ids, n in wanted)
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in sequences.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end and size > 0
            end += size
        assert end <= length and (end == length or end & (end - 1) == 0)
    assert packing.packed(df.limit(0), WORD, 1).count() == 0


def test_sequences_are_balanced_and_little_is_cut():
    rnd = random.Random(2)
    pieces = [packing.Piece(i, 0, np.zeros(n, "<u4"), n) for i, n in enumerate(rnd.choices(range(1, 900), k=2000))]
    total = sum(len(p.ids) for p in pieces)
    sizes = [2048] * (total // 2048) + packing.powers(total % 2048)
    filled, left = packing.assign(pieces, sizes)
    assert not left and [sum(len(p.ids) for p in s) for s in filled] == sizes
    costs = [sum(packing.cost(len(p.ids)) for p in s) for s in filled[: total // 2048]]
    assert max(costs) < 1.06 * min(costs)
    assert sum(map(len, filled)) < 1.25 * len(pieces)


def test_a_tokenizer_that_keeps_white_space_is_refused():
    with pytest.raises(ValueError):
        packing.Words(public_tokenizers.path("byte_bpe_50k.json"))


# --- near duplicates in a wide group ----------------------------------------------


def test_a_wide_group_gives_no_more_links_than_texts(spark, monkeypatch):
    """Texts of one stock with similarities on both sides of the threshold."""
    rnd = random.Random(4)
    stock = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(150):
        words = list(stock)
        for k in range(4):
            words[rnd.randrange(200)] = f"n{i}x{k}"
        texts.append((i, " ".join(words)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rows, build = [], near_dedup._block_links

    def counted(*args):
        out = near_dedup.stored(build(*args), "counted")
        rows.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "_block_links", counted)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(df, 3, 85).collect()}
    sets = [{tuple(t.split()[k : k + 3]) for k in range(198)} for _, t in texts]
    root = list(range(150))
    for a, b in itertools.combinations(range(150), 2):
        common = len(sets[a] & sets[b])
        if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    assert got == dict(enumerate(root))
    assert sum(rows) <= 8 * 150


def test_rules_as_columns_are_the_rules_learned_from(spark):
    rng = np.random.default_rng(4)
    names = list(quality.STATISTICS)
    rows = [(float(n % 2), *rng.random(len(names)).round(1).tolist()) for n in range(1300)]
    known = spark.createDataFrame(rows, ["label", *(f"{quality.PREFIX}{n}" for n in names)])
    paths = [
        tuple(quality.Test(str(rng.choice(names)), float(rng.integers(11)) / 10, bool(rng.integers(2))) for _ in range(size))
        for size in (1, 1, 2, 2, 3, 5)
    ]
    plain = [
        (row[0], [float(all((row[1 + names.index(t.statistic)] > t.threshold) == t.above for t in p)) for p in paths])
        for row in rows
    ]
    learned = [(r["label"], r["holds"]) for r in quality.rule_table(known.coalesce(1), paths).collect()]
    compiled = F.array(*[F.when(quality.conjunction(p), 1.0).otherwise(0.0) for p in paths]).alias("holds")
    scored = [(r["label"], r["holds"]) for r in known.coalesce(1).select("label", compiled).collect()]
    assert sorted(learned) == sorted(scored) == sorted(plain)
    assert quality.rule_table(known.limit(0), paths).count() == 0
