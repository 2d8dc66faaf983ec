"""CSV sources, read as strings."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crateflow.contracts import ROW_SEQ


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    multiline: bool = True,
    row_seq: bool = False,
    check: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Read CSV with a header; nothing is inferred, a ragged row fails the read.

    Columns are named by the header of their own file. Spark binds all files of
    one read by position, so files are read in groups of one header line, and
    the groups are joined by name; a column that a group lacks is NULL there.
    A path is taken as it stands if there is a file or folder of that name,
    otherwise as a pattern.
    ``check`` sees each group before that and may raise. An empty file has no
    header and fails the read. ``row_seq`` adds the place of
    each row in the file; of several files read at once each keeps its own
    order, but which file comes first is up to Spark.
    """
    groups = _by_header(spark, [path] if isinstance(path, str) else path)
    frames = [_scan(spark, head, files, multiline) for head, files in groups.items()]
    for frame in frames if check else ():
        check(frame)
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return df.withColumn(ROW_SEQ, F.monotonically_increasing_id()) if row_seq else df


def _scan(spark: SparkSession, head: str, files: list[str], multiline: bool) -> DataFrame:
    reader = spark.read
    if any(_literal(file) != file for file in files):
        # to find the columns Spark would take the names for patterns once more
        names = next(csv.reader([head]))
        kinds = [T.StructField(name or f"_c{at}", T.StringType()) for at, name in enumerate(names)]
        reader = reader.schema(T.StructType(kinds))
    return (
        reader.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("multiLine", multiline)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv([_literal(file) for file in files])
    )


def _by_header(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Files by their header line.

    One pass over the first block of each file finds its first line; a row per
    file comes to the driver, as the file names do for any read.
    """
    text = spark.read.text([_literal(path) if _there(spark, path) else path for path in paths])
    lines = text.where("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place"), "value"
    )
    heads = lines.groupBy("file").agg(F.min_by("value", "place").alias("head"))
    groups, empty = defaultdict(list), set(map(_plain, text.inputFiles()))
    for row in heads.sort("file").collect():
        file = _plain(row["file"])
        groups[row["head"]].append(file)
        empty.discard(file)
    if empty or not groups:
        raise ValueError(f"no header: {sorted(empty) or paths}")
    return dict(groups)


def _literal(path: str) -> str:
    """A path whose name holds signs of a pattern, as a pattern that only it fits."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _there(spark: SparkSession, path: str) -> bool:
    """Whether a path is the name of something; otherwise it may be a pattern."""
    if not re.search(r"[\\{}\[\]*?]", path):
        return False
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)


def _plain(file: str) -> str:
    """A file as a path that can be read: Spark reports it percent-encoded, local ones in two forms."""
    return unquote(file).replace("file:///", "file:/")
