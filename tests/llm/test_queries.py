"""Every registered query of the subpackage on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import database, differences
from crateflow.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_they_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_gives_what_sql_gives(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), database(FOLDER), ORACLE[name]) is None


def test_pipeline_stages_do_what_they_say(spark):
    """Each stage against a plain version of its rule, on what the one before kept."""
    import public_tokenizers
    import tiktoken
    from test_small_cases import leaks, linked_components

    from crateflow.llm import byte_bpe

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    quality, exact, near, clean = kept
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    judged = [(r["quality"], r["doc_id"] in quality) for r in labels if r["quality"] is not None]
    assert sum(q == k for q, k in judged) > 0.97 * len(judged)
    by_text = {}
    for i in sorted(quality):
        by_text.setdefault(" ".join((quality[i] or "").split()), i)
    assert set(exact) == set(by_text.values())
    texts = sorted(exact.items())
    sizes, roots = linked_components(texts, 5, 80)
    first = {}
    for k, (i, _) in enumerate(texts):
        first.setdefault(roots[k] if sizes[k] else ("alone", k), i)
    assert set(near) == set(first.values())
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    vocabulary = {w for _, text in items for w in (text or "").lower().split()}
    assert vocabulary
    assert set(clean) == set(near) - {i for i, _, _ in leaks(near.items(), items)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={
        t: r for r, t in byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")).tokens.items()
    }, special_tokens={})
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r["doc_id"] for r in rows} == set(clean) and all(r["exact"] for r in rows)
    for r in rows:
        ids = library.encode_ordinary(clean[r["doc_id"]] or "")
        assert bytes(r["ids"]) == b"".join(x.to_bytes(4, "little") for x in ids)


def test_stages_keep_one_of_repeated_rows(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text, "en", "s", 1)] * 3 + [(1, text.replace(" ", "  "), "en", "s", 1), (None, text, None, None, None),
            (2, text + " more", "en", "s", 1), (None, None, None, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    once = corpus_pipeline.exact_dedup(spark, docs, FOLDER)
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[-4:]) for r in once.collect()) == [(0, ""), (1, " w59"), (2, "more")]
    last = corpus_pipeline.near_dedup(spark, docs, FOLDER)
    assert sorted((r["doc_id"] or 0) for r in last.collect()) == [0, 1]
