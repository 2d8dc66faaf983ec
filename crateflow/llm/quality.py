"""Quality classifier: a sparse ensemble of rules over text statistics.

Trees are grown on statistics of labelled texts, every path from a root becomes
a rule (a conjunction of comparisons), a lasso logistic regression weighs the
rules and drops most, and what is left is compiled into one column expression.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crateflow.llm.rows import small
from crateflow.llm.words import encoded, slices
from crateflow.session import scratch_of_job, stored

# Labelled rows to learn from; of more, a share picked by a hash of the id.
MAX_ROWS = 200_000
TREES, DEPTH, BINS, LASSO, SEED = 20, 5, 128, 0.0003, 7
ROWS_PER_PART = 25_000
RULE_ROWS = 500


# In front of the names of their columns, longer where a column of the user begins so.
PREFIX = "_s_"
# Inputs of the rules, from the text alone, in the order in which ``measured``
# gives them. Shares are of all bytes, or of all words where the name says so.
STATISTICS = (
    "log_bytes", "log_words", "upper_share", "digit_share", "letter_share", "symbol_share",
    "stop_share", "comma_share", "word_length", "distinct_words", "echoed_words", "short_words",
    "longest_word", "lines_per_word", "distinct_lines",
)


def _marks(characters: str) -> np.ndarray:
    marks = np.zeros(256, np.int64)
    marks[list(characters.encode())] = 1
    return marks


_UPPER, _DIGIT = _marks("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _marks("0123456789")
# Beyond ASCII a character counts once, by its first byte, and as a letter.
_LETTER = _UPPER + _marks("abcdefghijklmnopqrstuvwxyz") + (np.arange(256) >= 0xC0)
_SYMBOL, _STOP, _COMMA = _marks("#$%&*|<>{}\\^~=+@!"), _marks(".?"), _marks(",")
_CLASSES = np.stack([_UPPER, _DIGIT, _LETTER, _SYMBOL, _STOP, _COMMA])


def measured(text: bytes) -> tuple[float, ...]:
    """The statistics of one text."""
    words, lines = text.split(), [line for line in text.split(b"\n") if line]
    n, size = max(len(words), 1), max(len(text), 1)
    shares = _CLASSES @ np.bincount(np.frombuffer(text, np.uint8), minlength=256) / size
    return (
        math.log1p(len(text)), math.log1p(len(words)), *shares.tolist(), len(text) / n,
        len(set(words)) / n, sum(map(eq, words, islice(words, 1, None))) / n,
        sum(len(w) <= 3 for w in words) / n, float(max(map(len, words), default=0)),
        len(lines) / n, len(set(lines)) / max(len(lines), 1),
    )


def _measurer(keep_text: bool, prefix: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            table = np.array([measured(text) for text in encoded(batch.column("text"))], float)
            table = table.reshape(-1, len(STATISTICS))
            rest = [name for name in batch.schema.names if keep_text or name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in rest), *map(pa.array, table.T)],
                [*rest, *(f"{prefix}{name}" for name in STATISTICS)],
            )

    return run


@dataclass(frozen=True)
class Test:
    """``statistic <= threshold``, or ``>`` when ``above``."""

    statistic: str
    threshold: float
    above: bool

    def column(self, prefix: str) -> Column:
        value = F.col(f"`{prefix}{self.statistic}`")
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, values: np.ndarray) -> np.ndarray:
        """The same for many values of the statistic."""
        return values > self.threshold if self.above else values <= self.threshold


@dataclass(frozen=True)
class RuleModel:
    """Weighted conjunctions and a constant, as log-odds of a good text."""

    rules: tuple[tuple[tuple[Test, ...], float], ...]
    constant: float

    def score(self, prefix: str = PREFIX) -> Column:
        total = F.lit(self.constant)
        for tests, weight in self.rules:
            total = total + F.when(conjunction(tests, prefix), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def conjunction(tests: tuple[Test, ...], prefix: str = PREFIX) -> Column:
    out = tests[0].column(prefix)
    for test in tests[1:]:
        out = out & test.column(prefix)
    return out


def rule_table(known: DataFrame, paths: list[tuple[Test, ...]]) -> DataFrame:
    """``label`` and ``holds``: 1.0 or 0.0 for each rule.

    Trees give over a thousand rules before the lasso drops most. As columns they
    would be a plan and generated code of that size in the driver's memory.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, RULE_ROWS):
                part = batch.slice(start, RULE_ROWS)
                values = {n: part.column(f"{PREFIX}{n}").to_numpy(zero_copy_only=False) for n in STATISTICS}
                tests = {t: t.holds(values[t.statistic]) for path in paths for t in path}
                table = np.empty((part.num_rows, len(paths)))
                for at, path in enumerate(paths):
                    table[:, at] = np.logical_and.reduce([tests[t] for t in path])
                ends = np.arange(part.num_rows + 1, dtype=np.int32) * len(paths)
                holds = pa.ListArray.from_arrays(pa.array(ends), pa.array(table.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("label"), holds], ["label", "holds"])

    return known.mapInArrow(run, "label double, holds array<double>")


def with_statistics(docs: DataFrame, keep_text: bool = True, prefix: str = PREFIX) -> DataFrame:
    """``docs`` with a column ``<prefix><name>`` for each statistic; null texts are empty."""
    fields = [f for f in docs.schema if keep_text or f.name != "text"]
    fields += [T.StructField(f"{prefix}{name}", T.DoubleType()) for name in STATISTICS]
    return docs.mapInArrow(_measurer(keep_text, prefix), T.StructType(fields))


def held_out() -> Column:
    """Rows that are never learned from: CRC-32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def tree_paths(model) -> set[tuple[Test, ...]]:
    """The conjunction above every node of every tree, the tests of a path simplified."""
    names, out = list(STATISTICS), set()

    def walk(node, path: dict[tuple[str, bool], float]) -> None:
        if path:
            out.add(tuple(Test(name, at, above) for (name, above), at in sorted(path.items())))
        if node.numDescendants() == 0:
            return
        split = node.split()
        name, at = names[split.featureIndex()], split.threshold()
        walk(node.leftChild(), path | {(name, False): min(at, path.get((name, False), math.inf))})
        walk(node.rightChild(), path | {(name, True): max(at, path.get((name, True), -math.inf))})

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), {})
    return out


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> RuleModel:
    """Learn from the labelled rows that are not held out.

    Several labels of one document count by their mean; null labels and labels
    without a document do not count. Without rows of both kinds the model is a
    constant: the share of good labels among what there is, smoothed towards a
    half, so an empty table scores a half. At most about ``max_rows`` rows are
    learned from.
    """
    with scratch_of_job(docs.sparkSession):
        return _fit(docs, labels, max_rows)


def _fit(docs: DataFrame, labels: DataFrame, max_rows: int) -> RuleModel:
    marks = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    )
    marks = small(stored(marks, "marks"))
    known = docs.select("doc_id", "text").where(~held_out())
    known = known.join(marks, F.col("doc_id").cast("long") == F.col("_id")).select("doc_id", "label", "text")
    known = stored(with_statistics(known, keep_text=False), "labelled")
    total, good = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if good in (0, total):
        return RuleModel((), math.log((good + 1) / (total - good + 1)))
    if total > max_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < 1_000_000 * max_rows // total)
        total = max_rows
    # A fixed order within a fixed number of parts: the same trees every time.
    known = known.repartition(-(-int(total) // ROWS_PER_PART), "doc_id").sortWithinPartitions(*known.columns)
    known = stored(known, "training")

    features = VectorAssembler(inputCols=[f"{PREFIX}{name}" for name in STATISTICS], outputCol="features")
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, maxBins=BINS, seed=SEED, minInstancesPerNode=3,
        featureSubsetStrategy="onethird",
    )
    paths = sorted(tree_paths(forest.fit(features.transform(known))), key=repr)
    if not paths:
        return RuleModel((), math.log((good + 1) / (total - good + 1)))
    table = rule_table(known, paths).select("label", array_to_vector("holds").alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, tol=1e-5)
    fitted = lasso.fit(table)
    weights = fitted.coefficients.toArray().tolist()
    rules = tuple((tests, w) for tests, w in zip(paths, weights, strict=True) if w)
    return RuleModel(rules, float(fitted.intercept))


def score_documents(docs: DataFrame, model: RuleModel, keep_text: bool = True) -> DataFrame:
    """The columns of ``docs`` (``text`` if it is to be kept) with ``held_out``,
    ``score`` and ``predicted``.

    A null or empty text is scored like others. Columns of these names are
    replaced; repeated rows and null ids (never held out) are rows like others.
    """
    docs = docs.drop("held_out", "score", "predicted")
    prefix = PREFIX
    while any(name.lower().startswith(prefix) for name in docs.columns):
        prefix += "_"
    rows = with_statistics(docs, keep_text, prefix).withColumns({"held_out": held_out(), "score": model.score(prefix)})
    rows = rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    return rows.drop(*[f"{prefix}{name}" for name in STATISTICS])


def op7_quality_classifier(spark, sf_dir):
    """Every document with its score."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_documents(docs, fit(docs, labels), keep_text=False)
