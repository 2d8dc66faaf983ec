"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.llm.rows import small
from crateflow.session import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``v, root`` for every end of ``edges`` (``a, b`` long, not null).

    ``root`` is the smallest vertex reachable. Each step takes the smallest label
    among neighbours and then the label of that label, so paths halve; steps are
    written tables, and the end is when one changes nothing. Sums over
    neighbours are combined before the shuffle, and a vertex with very many
    edges is split by the adaptive skew join.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    both = stored(both.toDF("v", "other"), "edges")
    labels = both.groupBy("v").agg(F.min("other").alias("low")).select(
        "v", F.least("v", "low").alias("root"), F.lit(True).alias("moved")
    )
    labels = stored(labels, "labels")
    while not labels.where("moved").isEmpty():
        known = labels.select("v", "root")
        near = (
            both.join(small(known.toDF("other", "low")), "other").groupBy("v").agg(F.min("low").alias("low"))
        )
        step = near.join(small(known), "v").select("v", F.col("root").alias("old"), F.least("root", "low").alias("root"))
        jump = step.join(small(known.toDF("root", "further")), "root")
        labels = stored(
            jump.select("v", F.col("further").alias("root"), (F.col("further") != F.col("old")).alias("moved")),
            "labels",
        )
    return labels.select("v", "root")
