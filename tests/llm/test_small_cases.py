"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import itertools
import math
import random
import re
import weakref
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from crateflow.llm import (
    byte_bpe,
    decontaminate,
    exact_dedup,
    near_dedup,
    passages,
    preference,
    quality,
    secret_scan,
    token_counts,
    url_filter,
)

DOCS = "doc_id long, text string, kept string, n_tokens int, score date"
WORDS = [f"w{i}" for i in range(400)]
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def text_of(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) for _ in range(n))


LONG = text_of(1, 30_000) + " " + "é" * 5_000 + " " + " " * 3_000 + "x" * 20_000
BASE = text_of(2, 120)
TEXTS = [
    (5, None), (6, ""), (7, "  \n "), (3, BASE), (1, BASE.replace(" ", "\n", 7)), (1, BASE),
    (1, BASE), (9, BASE + " tail"), (None, BASE), (None, None), (20, LONG), (21, "one two"),
    (22, "One  TWO"), (23, "a b c d e f g"), (23, "other text under one id"),
    (24, "tail " + text_of(3, 40) + " mid " + text_of(3, 40)), (25, "\U0001f600 <|endoftext|> ſecret=abcdefgh"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1, None) for i, t in TEXTS]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


# --- exact dedup ---------------------------------------------------------------


def test_exact_groups(docs, none):
    plain = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in TEXTS]
    expected = Counter()
    for i, t in plain:
        ids = [j for j, u in plain if u == t]
        keep = min((j for j in ids if j is not None), default=None)
        expected[i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()] += 1
    got = rows_of(exact_dedup.exact_groups(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == expected
    assert exact_dedup.exact_groups(none).count() == 0


def test_chunks_join_to_the_text_and_follow_the_content():
    text = text_of(4, 20_000).encode()
    ends = exact_dedup.cuts(text)
    assert ends[-1] == len(text) and ends == sorted(set(ends))
    assert max(b - a for a, b in zip([0, *ends], ends)) <= exact_dedup.MAX_CHUNK
    moved = b"some words in front " + text
    far = {text[a:b] for a, b in zip(ends, ends[1:])}
    again = exact_dedup.cuts(moved)
    assert len(far & {moved[a:b] for a, b in zip(again, again[1:])}) > 0.9 * len(far)
    assert exact_dedup.cuts(b"") == [0] and exact_dedup.cuts(b"ab") == [2]
    assert exact_dedup.cuts(b"a" * 200_000)[-1] == 200_000


def test_a_clash_of_chunk_keys_falls_back_on_the_text(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "distinct_chunks", lambda docs: docs.sparkSession.createDataFrame(
        [(bytearray(hashlib.blake2b(b"aa", digest_size=16).digest()), bytearray(b"aa"), bytearray(b"bb"))],
        "key binary, low binary, high binary",
    ))
    docs = spark.createDataFrame([(1, "aa"), (2, "aa"), (3, "cc")], "doc_id long, text string")
    assert rows_of(exact_dedup.exact_groups(docs), "doc_id", "keep_id") == {(1, 1): 1, (2, 1): 1, (3, 3): 1}


# --- near dedup ----------------------------------------------------------------


def linked_components(texts, size, percent):
    sets = []
    for _, text in texts:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    return [len(s) for s in sets], [find(k) for k in range(len(sets))]


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_groups(spark, docs, size, percent):
    rnd = random.Random(5)
    chain = [WORDS[k % 400] + str(k // 400) for k in range(300)]
    texts = list(TEXTS)
    for k in range(30):  # a chain of edits: neighbours are linked, ends are not
        chain[rnd.randrange(300)] = f"new{k}"
        texts.append((100 + k, " ".join(chain)))
    sizes, roots = linked_components(texts, size, percent)
    expected = Counter()
    for k, (i, _) in enumerate(texts):
        ids = [texts[j][0] for j in range(len(texts)) if roots[j] == roots[k] and texts[j][0] is not None]
        low = (min(ids) if ids else None) if sizes[k] else i
        expected[i, sizes[k], low, i == low] += 1
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = rows_of(near_dedup.near_groups(df, size, percent), "doc_id", "n_shingles", "component_id", "kept")
    assert got == expected


@pytest.mark.parametrize("percent", [6, 10, 30, 50, 60, 75, 80, 85, 95, 100])
def test_bands_follow_from_the_threshold(percent):
    bands, width = near_dedup.bands_for(percent)
    assert (1 - (percent / 100) ** width) ** bands <= near_dedup.MISS and bands * width <= near_dedup.REGISTERS
    assert near_dedup.bands_for(85) == (28, 5) and near_dedup.bands_for(80) == (41, 5)
    with pytest.raises(ValueError):
        near_dedup.bands_for(1)


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_screens_miss_no_more_than_bands(percent):
    import math

    import numpy as np

    n, p = near_dedup.REGISTERS, percent / 100
    floor = near_dedup.least_equal(percent)
    assert sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(floor)) <= near_dedup.MISS
    assert math.erfc(math.sqrt(near_dedup.DOUBT)) / 2 <= near_dedup.MISS
    more = (n - floor) // 2
    counts, size = np.array([[more], [n - floor - more], [floor]]), np.array([1000.0])
    assert near_dedup.in_doubt(counts, size, size, percent).all()


def test_links_at_a_low_threshold_are_found(spark):
    texts = []
    for k in range(60):
        words = text_of(1000 + k, 90).split()
        texts += [(2 * k, " ".join(words[:60])), (2 * k + 1, " ".join(words[20:80]))]
    sizes, roots = linked_components(texts, 1, 50)
    low = {}
    for k, root in enumerate(roots):
        low.setdefault(root, texts[k][0])
    expected = {i: low[roots[k]] for k, (i, _) in enumerate(texts)}
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(df, 1, 50).collect()} == expected


def test_near_groups_of_nothing(none):
    assert near_dedup.near_groups(none).count() == 0


def test_registers_merge_and_likelihood_finds_the_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    every = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    a, b = every[:2000], every[500:2500]
    first, second = near_dedup.registers(a), near_dedup.registers(b)
    both = near_dedup.registers(np.union1d(a, b))
    assert (np.maximum(first, second) == both).all()
    first, second = first.astype(int), second.astype(int)
    counts = np.array([[(first > second).sum()], [(first < second).sum()], [(first == second).sum()]])
    grid = np.linspace(0, 1, 101)
    best = grid[np.argmax([near_dedup.log_likelihood(np.array([g]), np.array([0.5]), counts)[0] for g in grid])]
    assert abs(best - 0.6) < 0.13


def test_components_of_a_long_chain(spark):
    from crateflow.llm.components import connected_components

    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 60)] + [(200, 201), (300, 300)], "a long, b long")
    got = {r["v"]: r["root"] for r in connected_components(edges).collect()}
    assert got == {k: 0 for k in range(61)} | {200: 200, 201: 200}
    assert connected_components(edges.limit(0)).count() == 0


# --- substring dedup -----------------------------------------------------------


def removed(texts):
    order = sorted({(i is None, i or 0, near_key(t), t, i) for i, t in texts}, key=lambda x: x[:3])
    seen, out = set(), {}
    for _, _, _, text, i in order:
        words = (text or "").encode().split()
        gone = set()
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            if window in seen:
                gone.update(range(k, k + 20))
            seen.add(window)
        out[i, text] = (len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode())
    return out


KEYS = {}


def near_key(text):
    return KEYS[text or ""]


@pytest.mark.parametrize("pieces", [passages.ANCHOR_PIECES, 2])
def test_remove_repeats(spark, pieces, monkeypatch):
    monkeypatch.setattr(passages, "ANCHOR_PIECES", pieces)
    shared = text_of(6, 70)
    texts = [t for t in TEXTS if t[0] != 20] + [
        (40 + k, f"{text_of(50 + k, 30)} {shared if k % 2 else shared[:200]} {text_of(90 + k, 25)}") for k in range(8)
    ] + [(60, "same " * 70), (61, "\n".join(["line of the very same words again and again"] * 9)), (62, "same " * 45)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for row in df.selectExpr("coalesce(text, '') AS t", "xxhash64(coalesce(text, '')) AS k").collect():
        KEYS[row["t"]] = row["k"]
    expected = removed(texts)
    got = rows_of(passages.remove_repeats(df.repartition(3)), "doc_id", "n_words", "n_removed", "kept")
    assert got == Counter((i, *expected[i, t]) for i, t in texts)


def test_remove_repeats_of_nothing(none):
    assert passages.remove_repeats(none).count() == 0


# --- tokens --------------------------------------------------------------------


def test_encode_and_decode(docs, none):
    ranks = {token: rank for rank, token in byte_bpe.load_ranks(RANKS).tokens.items()}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    rows = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    assert rows.columns == ["doc_id", "kept", "score", "n_tokens", "ids", "decoded"]
    expected = Counter()
    for i, text in TEXTS:
        ids = library.encode_ordinary(text or "")
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        expected[i, len(ids), packed, (text or "").encode()] += 1
    got = Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), bytes(r["decoded"])) for r in rows.collect())
    assert got == expected
    assert byte_bpe.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_merges_are_those_of_the_library():
    ranks = byte_bpe.load_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={
        token: rank for rank, token in ranks.tokens.items()
    }, special_tokens={})
    rnd = random.Random(7)
    pieces = [bytes(rnd.choice(b"aab \ne\xc3\xa9") for _ in range(rnd.randint(1, 100))) for _ in range(2000)]
    pieces += [b"a" * 64, b"a" * 65, b" " * 3000, bytes(range(256))]
    for piece, ids in zip(pieces, byte_bpe.encode_pieces(pieces, ranks)):
        assert ids.tolist() == library._encode_single_piece(piece)
    for piece in pieces[:200]:
        assert byte_bpe.merge_long(piece, ranks).tolist() == library._encode_single_piece(piece)


@pytest.mark.parametrize("frequent", [0, 5, token_counts.FREQUENT])
def test_count_tokens(docs, none, frequent):
    library = Tokenizer.from_file(JSON)
    expected = Counter(
        (i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t in TEXTS
    )
    assert rows_of(token_counts.count_tokens(docs, JSON, frequent), "doc_id", "n_bytes", "n_tokens") == expected
    assert token_counts.count_tokens(none, JSON, frequent).count() == 0


def test_settled_characters_are_cut_as_the_library_does():
    import regex

    cut, settled = token_counts.Pretokens(JSON), regex.compile(token_counts.SETTLED)
    library = Tokenizer.from_file(JSON).pre_tokenizer
    letters = [c for c in map(chr, range(0x10000)) if settled.fullmatch(c)]
    assert len(letters) > 40_000
    for start in range(0, len(letters), 997):
        text = "".join(f"a{c}a1{c}1!{c}! {c}" for c in letters[start : start + 997])
        assert cut.of(text)[0] == [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]


# --- benchmark -----------------------------------------------------------------


def leaks(texts, items):
    out = {}
    for i, text in texts:
        words = (text or "").encode().lower().split()
        for item, passage in items:
            own = (passage or "").encode().lower().split()
            if not own:
                continue
            size = min(5, len(own))
            target = Counter(tuple(own[k : k + size]) for k in range(len(own) - size + 1))
            for start in range(len(words) - len(own) + 1):
                part = words[start : start + len(own)]
                here = Counter(tuple(part[k : k + size]) for k in range(len(own) - size + 1))
                common = sum((here & target).values())
                value = common / (here.total() + target.total() - common)
                if value >= 0.8 - 1e-12:
                    old = out.get((i, text, item), (0, 0, 0))
                    out[i, text, item] = max(old, (value, -start, len(own)))
    return out


def test_find_leaks(spark, docs, none):
    rnd = random.Random(8)
    items = [(k, text_of(200 + k, rnd.choice([1, 2, 4, 5, 8, 20, 40]))) for k in range(30)]
    items += [(90, None), (91, ""), (92, "One TWO"), (92, BASE[:60])]
    spec = "item_id long, text string, score int"
    table = spark.createDataFrame([(*x, 1) for x in items], spec)
    texts = list(TEXTS)
    for k, (item, passage) in enumerate(items[:30]):
        words = passage.split()
        if k % 3 == 1 and len(words) > 30:
            words[3] = "edited"
        texts.append((300 + k, f"{text_of(400 + k, 30)} {' '.join(words).upper()} {text_of(500 + k, 30)}"))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = Counter(
        (r["doc_id"], r["item_id"], -r["start"], r["n_words"], round(r["similarity"], 9))
        for r in decontaminate.find_leaks(df, table).collect()
    )
    expected = Counter()
    for i, text in texts:
        for (_, _, item), (value, start, n) in leaks([(i, text)], items).items():
            expected[i, item, start, n, round(value, 9)] += 1
    assert {x[:2] for x in got} == {x[:2] for x in expected}
    assert got == expected
    assert decontaminate.find_leaks(none, table).count() == 0
    assert decontaminate.find_leaks(df, table.limit(0)).count() == 0


def test_texts_shorter_than_an_item_leak_it(spark):
    """Against a count of shingles that takes a shorter text as a whole."""
    rnd = random.Random(12)
    items = [(k, text_of(800 + k, n)) for k, n in enumerate([3, 5, 6, 9, 15, 30, 59, 59])]
    items.append((8, "again " * 20))
    texts = []
    for _, passage in items:
        words = passage.split()
        for cut in (0, 1, 2, 3, 5, 9, 12):
            for at in {0, cut // 2, cut}:
                texts.append((len(texts), " ".join(words[at : len(words) - cut + at])))
        words[rnd.randrange(len(words))] = "edited"
        texts.append((len(texts), " ".join(words[1:])))

    def grams(words, size):
        return Counter(" ".join(words[k : k + size]) for k in range(len(words) - size + 1))

    expected = {}
    for doc, text in texts:
        for item, passage in items:
            words, own = text.split(), passage.split()
            size, n = min(5, len(own)), min(len(own), len(words))
            for start in range(len(words) - n + 1):
                here, there = grams(words[start : start + n], size), grams(own, size)
                value = (here & there).total() / (here | there).total()
                if value >= 0.8 and value > expected.get((doc, item), (0,))[0]:
                    expected[doc, item] = (value, start, n)
    short = [k for k in expected if expected[k][2] < len(items[k[1]][1].split())]
    assert len(short) > 20
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rows = decontaminate.find_leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"], r["n_words"]) for r in rows}
    assert len(got) == len(rows) and got == {k: (pytest.approx(v), s, n) for k, (v, s, n) in expected.items()}


def test_every_fingerprint_in_the_radius_is_found():
    rng = np.random.default_rng(9)
    items = decontaminate.Items.of([(k, text_of(700 + k, 12)) for k in range(50)], decontaminate.RADIUS, 0.8)
    _, prints = items.index[12]
    for i, own in enumerate(prints):
        bits = np.unpackbits(own.view(np.uint8))
        bits[rng.choice(decontaminate.BITS, decontaminate.RADIUS, replace=False)] ^= 1
        assert i in items.near(12, np.packbits(bits).view(np.uint64))


def test_few_unlike_windows_agree_in_enough_blocks():
    rng = np.random.default_rng(10)
    prints = decontaminate.fingerprints(rng.integers(0, 1 << 63, (2000, 30), np.uint64))
    asked = decontaminate.BITS // decontaminate.BLOCK - decontaminate.RADIUS
    passed = sum((decontaminate.agreeing_blocks(prints, own) >= asked).sum() - 1 for own in prints)
    assert passed / (2000 * 1999) < 0.01
    blocks = prints.view(np.uint8)[..., None] >> np.arange(0, 8, 2, dtype=np.uint8) & 3
    plain = (blocks[0] == blocks).sum(axis=(1, 2))
    assert decontaminate.agreeing_blocks(prints, prints[0]).tolist() == plain.tolist()


def test_windows_at_the_threshold_lie_within_the_radius():
    def sums(n):
        return {2 * k - n: math.comb(n, k) / 2**n for k in range(n + 1)}

    def differs(common, a, b):
        """How likely one bit differs, with so many shingles in both and in one only."""
        cases = itertools.product(sums(common).items(), sums(a).items(), sums(b).items())
        return sum(p * q * r for (s, p), (x, q), (y, r) in cases if (s + x > 0) != (s + y > 0))

    def missed(p):
        n = decontaminate.BITS
        return sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(decontaminate.RADIUS + 1, n + 1))

    sizes = [(c, d, a) for c in range(1, 61) for d in range(c // 4 + 1) for a in range(d + 1)]
    assert max(missed(differs(c, a, d - a)) for c, d, a in sizes) < 1 / 3e6
    assert max(missed(differs(c, a, a)) for c, d, a in sizes if d == 2 * a) < 1e-11
    # measured bits follow the formula: 36 shingles in common, 4 in one only, 5 in the other
    rng = np.random.default_rng(11)
    rows = rng.integers(0, 1 << 63, (1000, 45), np.uint64)
    apart = np.bitwise_count(
        decontaminate.fingerprints(rows[:, :40]) ^ decontaminate.fingerprints(np.delete(rows, slice(36, 40), axis=1))
    ).sum(axis=1)
    assert abs(apart.mean() / decontaminate.BITS - differs(36, 4, 5)) < 0.005
    assert apart.max() <= decontaminate.RADIUS


def test_a_window_of_just_the_threshold_is_found(spark):
    item = text_of(30172, 40)
    text = " ".join([*item.split()[:36], "x1", "x2", "x3", "x4"])
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = decontaminate.find_leaks(df, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert (row["item_id"], row["similarity"]) == (7, 0.8)


def test_the_index_of_a_block_goes_before_the_next_is_built(spark, monkeypatch):
    items = [(k, text_of(900 + k, 20)) for k in range(12)]
    texts = [(k, f"{text_of(950 + k, 10)} {passage}") for k, passage in items]
    table = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(texts, "doc_id long, text string")
    steps, alive, build, store = [], [], decontaminate.Items.of, decontaminate.stored

    def built(*args):
        steps.append(("build", sum(x() is not None for x in alive)))
        out = build(*args)
        alive.append(weakref.ref(out))
        return out

    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 600)
    monkeypatch.setattr(decontaminate.Items, "of", built)
    monkeypatch.setattr(decontaminate, "stored", lambda *args: steps.append("store") or store(*args))
    got = decontaminate.find_leaks(df, table)
    assert len(steps) > 4 and steps == [("build", 0), "store"] * (len(steps) // 2)
    assert rows_of(got, "doc_id", "item_id") == {(k, k): 1 for k, _ in items}


# --- secrets -------------------------------------------------------------------


def test_find_secrets(spark, docs, none):
    got = {r["doc_id"]: r["spans"] for r in secret_scan.find_secrets(docs).collect() if r["doc_id"] == 25}
    assert got == {25: []}  # a long s is no s
    assert secret_scan.find_secrets(none).count() == 0
    key = "aB3" * 12
    filler = "x " * 300
    texts = {
        1: f"{key} alone",
        2: f"AKIA{'A1' * 8} then {key}",
        3: f"AKIA{'A1' * 8} {filler} {key}",
        4: f"https://host.example/x user=someone {key}",
        5: "https://host.example/x user=someone",
        6: "secret=token:abcdefgh Password : 'longenough' api-key=abcdefgh apikey=\"abcdef",
        7: None,
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    spans = {r["doc_id"]: [(secret_scan.KINDS[s["kind"]], s["start"], s["end"]) for s in r["spans"]]
             for r in secret_scan.find_secrets(df.union(df.where("doc_id = 2"))).collect()}
    assert spans[1] == spans[5] == spans[7] == []
    assert spans[2] == [("access", 0, 20), ("weak_secret", 26, 62)]
    assert spans[3] == [("access", 0, 20)]
    assert [s[0] for s in spans[4]] == ["endpoint", "weak_id", "weak_secret"]
    assert [s[0] for s in spans[6]] == ["assign", "assign"]


def test_long_parts_and_overlapped_evidence(spark):
    run, address = "aB3" * 12, "https://host.example/" + "p/" * 400
    texts = {
        1: f"user=someone {'aB3' * 43}",
        2: f"{'aB3' * 2000}== user=someone",
        3: f"{address} {'x ' * 60}user=someone {run}",
        4: f"user={'someone' * 60} {run}",
        5: f"https://host.example/x?token=abcdefgh {run}",
        6: f"host={'a.' * 200}example {run}",
        7: f"https://host.example/x?user=someone {run}",
        8: "https://host.example/x?token=abcdefgh",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    spans = {r["doc_id"]: [(secret_scan.KINDS[s["kind"]], texts[r["doc_id"]][s["start"] : s["end"]]) for s in r["spans"]]
             for r in secret_scan.find_secrets(df).collect()}
    user = ("weak_id", "user=someone")
    assert spans[1] == [user, ("weak_secret", "aB3" * 43)]
    assert spans[2] == [("weak_secret", "aB3" * 2000 + "=="), user]
    assert spans[3] == [("endpoint", address), user, ("weak_secret", run)]
    assert spans[4] == [("weak_id", "user=" + "someone" * 60), ("weak_secret", run)]
    assert spans[5] == [("assign", "token=abcdefgh"), ("weak_secret", run)]
    assert spans[6] == [("weak_secret", run)]
    assert spans[7] == [("endpoint", "https://host.example/x?user=someone"), ("weak_secret", run)]
    assert spans[8] == [("assign", "token=abcdefgh")]


def test_linking_by_bins_is_linking_by_distance(spark):
    rnd = random.Random(10)
    parts = []
    for row in range(40):
        for _ in range(rnd.randint(1, 9)):
            start = rnd.randint(0, 3000)
            parts.append((row, rnd.randint(0, 5), start, start + rnd.choice([3, 20, 300, 900])))
    parts = sorted(set(parts))
    role = {0: "s", 2: "s", 3: "s", 1: "i", 4: "i", 5: "p"}
    expected = set()
    for row, kind, start, end in parts:
        near = {role[k] for r, k, a, b in parts if r == row and a <= end + 200 and b >= start - 200}
        if (kind == 3 and near & {"i", "p"}) or (kind == 4 and "s" in near) or (kind == 5 and near >= {"i", "s"}):
            expected.add((row, kind, start, end))
    df = spark.createDataFrame(parts, "row long, kind int, start int, end int")
    assert set(map(tuple, secret_scan.linked(df).collect())) == expected


# --- urls ----------------------------------------------------------------------


def test_judge_urls(spark):
    urls = [
        None, "no scheme", "http://", "http://EXAMPLE.com", "http://example.com/", "HTTP://www.Example.COM/en/x?y#z",
        "https://a.b.example.net/es/?q", "ftp://notexample.com/en/", "http://example.com/en", "x://y://z.net/fr/",
        "http://net/fr/", "http://q.net?a/es/", "http://com/ünï",
    ]
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)] + [(None, urls[4], "y"), (4, urls[4], "z")],
                                  "page_id long, url string, rule string")
    rules = spark.createDataFrame(list(url_filter.RULES), "host string, path string, verdict string")

    def judge(url):
        host, path = "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.split(r"[/?#]", rest)[0]
            path = re.split(r"[?#]", rest[len(host):])[0]
            host = "".join(c.lower() if c.isascii() else c for c in host)
        fit = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, None, "allow"))
        return host, path, best[1], best[2]

    expected = Counter((k, *judge(u)) for k, u in enumerate(urls)) + Counter([(None, *judge(urls[4])), (4, *judge(urls[4]))])
    got = rows_of(url_filter.judge_urls(pages, rules), "page_id", "host", "path", "rule", "verdict")
    assert got == expected
    assert rows_of(url_filter.judge_urls(pages, rules.limit(0)), "rule", "verdict") == {(None, "allow"): len(urls) + 2}
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


# --- preferences ---------------------------------------------------------------


def test_format_preferences(spark):
    u, a, b = (1, "user", "hi"), (2, "assistant", "yes"), (2, "assistant", "no")
    rows = [
        (1, [u, a], [u, b]), (2, [u, a], [u, a]), (3, None, [u]), (4, [u, a, u], [u, a]),
        (5, [(1, None, None), a], [(1, None, None), b]), (1, [u, a], [u, b]),
    ]
    kind = "array<struct<turn:long,role:string,text:string>>"
    df = spark.createDataFrame(rows, f"pair_id long, chosen {kind}, rejected {kind}")
    out = {r["pair_id"]: r for r in preference.format_preferences(df).collect()}
    one = out[1]
    assert (one["n_prompt_turns"], one["prompt"]) == (1, "<|user|>\nhi\n")
    assert one["chosen_completion"] == "<|assistant|>\nyes\n" and one["rejected_completion"] == "<|assistant|>\nno\n"
    start, end = map(int, one["chosen_loss"].split(":"))
    assert one["chosen_completion"][start:end] == "yes\n"
    assert (out[2]["n_prompt_turns"], out[2]["chosen_completion"], out[2]["chosen_loss"]) == (2, "", "")
    assert (out[3]["n_prompt_turns"], out[3]["prompt"], out[3]["chosen_completion"]) == (0, "", "")
    assert (out[4]["n_prompt_turns"], out[4]["chosen_loss"]) == (2, "")
    assert out[5]["prompt"] == "<||>\n\n"
    assert preference.format_preferences(df).count() == len(rows)
    assert preference.format_preferences(df.limit(0)).count() == 0


def test_pairs_from_conversations(spark):
    rows = [
        (2, 0, "user", "q"), (2, 1, "assistant", "r"), (2, 2, "user", "more"), (3, 0, "user", "q"),
        (3, 1, "assistant", None), (4, 0, "assistant", "alone"), (5, 0, "user", "no answer"), (None, 0, "user", "x"),
        (6, 0, "assistant", "t"), (7, 0, "assistant", "t"), (7, 0, "assistant", "t"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["pair_id"]: r for r in preference.format_preferences(preference.answer_pairs(df)).collect()}
    assert set(out) == {2, 3, 4, 6, 7}
    assert out[2]["prompt"] == "<|user|>\nq\n" and out[2]["chosen_completion"] == "<|assistant|>\nr\n"
    assert out[2]["rejected_completion"] == "<|assistant|>\n\n"
    assert out[3]["rejected_completion"] == "<|assistant|>\nalone\n"
    assert out[6]["n_prompt_turns"] == 1 and out[6]["rejected_completion"] == ""
    assert out[7]["n_prompt_turns"] == 1 and out[7]["rejected_completion"] == "<|assistant|>\nr\n"


def test_every_answered_conversation_gives_a_pair_whatever_its_id(spark):
    rows = [(i, 0, "assistant", f"t{i}") for i in range(0, 400, 4)] + [(9, 0, "user", "no answer")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["pair_id"]: r["rejected_completion"] for r in preference.format_preferences(preference.answer_pairs(df)).collect()}
    assert out == {i: f"<|assistant|>\nt{(i + 4) % 400}\n" for i in range(0, 400, 4)}


def test_an_answer_without_a_partner_is_kept_on_request(spark):
    rows = [(4, 0, "user", "q"), (4, 1, "assistant", "alone"), (5, 0, "user", "no answer")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert preference.answer_pairs(df).count() == 0
    (only,) = preference.format_preferences(preference.answer_pairs(df, unpaired=True)).collect()
    assert (only["pair_id"], only["prompt"], only["n_prompt_turns"]) == (4, "<|user|>\nq\n", 1)
    assert only["chosen_completion"] == "<|assistant|>\nalone\n"
    assert only["rejected_completion"] == only["rejected_loss"] == ""
    assert preference.answer_pairs(df.where("conv_id = 5")).count() == 0


# --- quality -------------------------------------------------------------------


def test_quality(spark, docs, none):
    rnd = random.Random(11)
    good = [(k, text_of(k, rnd.randint(20, 60)) + ".", 1) for k in range(0, 120, 2)]
    bad = [(k, " ".join("BUY!! NOW!!" for _ in range(rnd.randint(10, 30))), 0) for k in range(1, 120, 2)]
    df = spark.createDataFrame([x[:2] for x in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, q, 0) for i, _, q in good + bad] + [(good[0][0], 1, 0), (None, 0, 0), (5000, 1, 0), (3, None, 0)],
        "doc_id long, quality int, toxic int",
    )
    model = quality.fit(df, labels)
    assert model.rules and all(weight for _, weight in model.rules)
    scored = {r["doc_id"]: r for r in quality.score_documents(df, model).collect()}
    truth = {i: q for i, _, q in good + bad}
    assert all(scored[i]["predicted"] == q for i, q in truth.items())
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in scored.items())
    small = quality.score_documents(docs, model)
    assert small.count() == len(TEXTS) and small.where("score is null or score < 0 or score > 1").count() == 0
    assert small.columns == ["doc_id", "text", "kept", "n_tokens", "held_out", "score", "predicted"] or (
        set(small.columns) == {"doc_id", "text", "kept", "n_tokens", "held_out", "score", "predicted"}
    )
    empty = quality.fit(none, labels)
    assert empty.rules == () and quality.score_documents(docs, empty).where("score = 0.5").count() == len(TEXTS)
    one_kind = quality.fit(df, labels.where("quality = 1"))
    assert one_kind.rules == () and one_kind.constant > 0


def test_stages_leave_columns_of_any_name_alone(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60).selectExpr(
        "*", "doc_id as _id", "doc_id as _key", "doc_id as _LOSER", "'x' as _s_comma_share", "1 as N_TOKENS",
        "named_struct('a b', 1, 'c', 'd') as nested", "2 as Score", "3 as component", "4 as Kept", "5 as Decoded",
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.drop("Score") if stage is corpus_pipeline.quality else docs, folder)
        assert set(out.columns) >= set(docs.columns) - {"Score"}
        assert 0 < out.count() <= 60
    last = corpus_pipeline.byte_bpe(spark, docs, folder)
    assert last.columns.count("n_tokens") == 1 and "N_TOKENS" not in last.columns
    assert last.where("exact and _id = doc_id and nested.`a b` = 1").count() == 60
