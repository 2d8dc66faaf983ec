"""A training corpus from raw documents, stage by stage.

Each stage takes what the one before it kept; its decisions take effect. All but
the last return the columns of ``documents``; the last returns token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crateflow.llm.byte_bpe import round_trip
from crateflow.llm.decontaminate import leaking_rows
from crateflow.llm.exact_dedup import exact_groups
from crateflow.llm.near_dedup import near_groups
from crateflow.llm.quality import fit, score_documents
from crateflow.llm.rows import one_row_each, without
from crateflow.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).where("predicted = 1").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return one_row_each(docs, exact_groups(docs), "recipe").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return one_row_each(docs, near_groups(docs), "component").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without(docs, leaking_rows(docs, items)).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as packed token ids; ``exact`` says that the ids decode to the text."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    rows = round_trip(rows, path, public_tokenizers.PATTERN)
    return rows.withColumn("exact", F.sha2("decoded", 256) == F.col("text_sha256")).drop("decoded")


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

# Learned weights and token ids are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
