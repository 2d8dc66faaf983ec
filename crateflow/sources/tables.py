"""Layer tables on disk: ``<layer>/<yyyymmdd>/<name>.parquet``.

A table that is replaced as a whole has versions below ``_versions`` and, below
``_commits``, a file for every change of the current one, whose name counts up and
says the version. Readers take the highest name. A version is complete before its
file is there and is never written again by a replacement, so a reader has the old
table or the new one, and a lost driver leaves the old one in place.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crateflow.plans.sizing import fits_broadcast
from crateflow.session import SMALL as SMALL

# Versions that can be read or gone back to; older ones are deleted.
KEPT_VERSIONS = 3
_VERSIONS, _COMMITS = "_versions", "_commits"
# Said by a commit instead of a version: none at all, or that before the last.
_NOTHING, _BACK = "nothing", "back"


def run_dir(root: str, run_date: str) -> str:
    """Folder of one run date, ``2026-07-22`` becoming ``20260722``."""
    return f"{root.rstrip('/')}/{run_date.replace('-', '')}"


def table_path(root: str, run_date: str, name: str) -> str:
    """Folder of one table of one run date."""
    return f"{run_dir(root, run_date)}/{name}.parquet"


def read_table(
    spark: SparkSession,
    root: str,
    run_date: str,
    name: str,
    schema: T.StructType | None = None,
) -> DataFrame:
    """One table of one run date, as it stands now; parts landed in it belong to it.

    Parts may have columns of their own: a column that a part lacks is NULL in
    its rows. A known ``schema`` saves the job that looks it up in the files. A
    frame that was read before the table is replaced goes on reading the
    version it has found.
    """
    target = table_path(root, run_date, name)
    paths = _live_paths(spark, target)
    if not paths:
        raise FileNotFoundError(f"there is no table {target}")
    reader = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*paths)


def publish(df: DataFrame, root: str, run_date: str, name: str, codec: str | None = None) -> str:
    """Replace one table of one run date, or leave it as it was.

    Spark evaluates at the write, and ``overwrite`` deletes first: a failing
    transform would take yesterday's good table with it. So the rows are written
    to a version of their own, and one new file makes that the current one.
    ``codec`` is the compression, if not that of the session.
    """
    target = table_path(root, run_date, name)
    write_replacing(df, target, codec)
    return target


def write_replacing(df: DataFrame, target: str, codec: str | None = None) -> None:
    """Write ``df`` as a new version of ``target``, current once it is complete."""
    version = uuid.uuid4().hex
    staged = f"{target}/{_VERSIONS}/{version}"
    try:
        df.write.parquet(staged, compression=codec)
    except Exception:
        discard(df.sparkSession, staged)
        raise
    _commit(df.sparkSession, target, version)


def replace(spark: SparkSession, staged: str, target: str) -> None:
    """Make the finished folder ``staged`` the current version of ``target``."""
    version = uuid.uuid4().hex
    old, fs = _file_system(spark, staged)
    new, _ = _file_system(spark, f"{target}/{_VERSIONS}/{version}")
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"cannot move {staged} to {target}")
    _commit(spark, target, version)


def withdraw(spark: SparkSession, target: str) -> None:
    """Leave ``target`` without rows, if it has any; ``take_back`` undoes it."""
    if _history(spark, target):
        _commit(spark, target, _NOTHING)


def take_back(spark: SparkSession, root: str, run_date: str, name: str) -> None:
    """Undo the last replacement of a table: the version before it is current again.

    Without one before, the day has no such table any more. Rows appended to the
    version go with it. Up to ``KEPT_VERSIONS`` versions can be gone back through.
    """
    target = table_path(root, run_date, name)
    history = _history(spark, target)
    if not history:
        raise FileNotFoundError(f"{target} was never published")
    if len(history) > 1 and history[-2] != _NOTHING:
        before, fs = _file_system(spark, f"{target}/{_VERSIONS}/{history[-2]}")
        if not fs.exists(before):
            raise FileNotFoundError(f"the version of {target} before this one is no longer kept")
    _commit(spark, target, _BACK)


def discard(spark: SparkSession, name: str) -> None:
    """Delete a folder if it is there."""
    path, fs = _file_system(spark, name)
    fs.delete(path, True)


def publish_days(df: DataFrame, day: str, root: str, name: str) -> None:
    """Replace one table of many run dates in one write; ``day`` holds yyyymmdd.

    The dates become current one after the other.
    """
    spark = df.sparkSession
    staged = f"{root.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    df.write.partitionBy(day).parquet(staged)
    path, fs = _file_system(spark, staged)
    for entry in fs.listStatus(path):
        folder = entry.getPath().getName()
        if folder.startswith(f"{day}="):
            replace(spark, f"{staged}/{folder}", table_path(root, folder.split("=", 1)[1], name))
    fs.delete(path, True)


def part_path(spark: SparkSession, target: str, part: str) -> str:
    """Where a part of ``target`` belongs: in its current version, if it has versions."""
    return f"{_folder_to_add_to(spark, target)}/{part}"


def append_rows(df: DataFrame, root: str, run_date: str, name: str) -> str:
    """Add rows to one table of one run date."""
    target = table_path(root, run_date, name)
    df.write.mode("append").parquet(_folder_to_add_to(df.sparkSession, target))
    return target


def log_frame(spark: SparkSession, records: list[dict], schema: T.StructType) -> DataFrame:
    """Log records as a table with fixed types, also when a column is all NULL."""
    rows = [tuple(record[name] for name in schema.fieldNames()) for record in records]
    return spark.createDataFrame(rows, schema).coalesce(1)


def run_history(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table over all run dates, with the folder it came from as ``run_day``.

    A bad day is taken back with ``take_back``: its rows are those of the version
    before, or none.
    """
    path, fs = _file_system(spark, root)
    days = sorted(entry.getPath().getName() for entry in fs.listStatus(path))
    folders = [f"{root.rstrip('/')}/{day}/{name}.parquet" for day in days if re.fullmatch(r"\d{8}", day)]
    paths = [live for folder in folders for live in _live_paths(spark, folder)]
    if not paths:
        raise FileNotFoundError(f"no day of {root} has a table {name}")
    day = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{8})/[^/]+\.parquet/", 1)
    reader = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True)
    return reader.parquet(*paths).withColumn("run_day", day)


def latest_per(history: DataFrame, by: list[str], order_by: str = "run_day") -> DataFrame:
    """The rows of the newest run of each group; all of them, if it has several."""
    newest = history.groupBy(*by).agg(F.max(order_by).alias("_newest"))
    newest = newest.withColumnsRenamed({name: f"_n_{name}" for name in by})
    match = F.col(order_by) == F.col("_newest")
    for name in by:
        match = match & F.col(name).eqNullSafe(F.col(f"_n_{name}"))
    return history.join(F.broadcast(newest) if fits_broadcast(newest) else newest, match, "left_semi")


def _file_system(spark: SparkSession, name: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())


def _children(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """Names in a folder that readers see, and whether each is a folder."""
    path, fs = _file_system(spark, folder)
    if not fs.exists(path):
        return []
    entries = [(entry.getPath().getName(), entry.isDirectory()) for entry in fs.listStatus(path)]
    return sorted((name, is_folder) for name, is_folder in entries if name[0] not in "_.")


def _history(spark: SparkSession, target: str) -> list[str]:
    """Versions of ``target`` from the first to the current one, without those taken back."""
    path, fs = _file_system(spark, f"{target}/{_COMMITS}")
    if not fs.exists(path):
        return []
    history: list[str] = []
    for name in sorted(entry.getPath().getName() for entry in fs.listStatus(path)):
        version = name.partition("-")[2]
        if version != _BACK:
            history.append(version)
        elif history:
            history.pop()
    return history or [_NOTHING]


def _commit(spark: SparkSession, target: str, version: str) -> None:
    """Add a file whose name says what is current; nothing is overwritten or moved.

    Files count upwards. Should two writers take one number, the later name is the
    current version for every reader, and no reader sees rows of both.
    """
    folder, fs = _file_system(spark, f"{target}/{_COMMITS}")
    fs.mkdirs(folder)
    numbers = [int(entry.getPath().getName().partition("-")[0]) for entry in fs.listStatus(folder)]
    path, _ = _file_system(spark, f"{target}/{_COMMITS}/{max(numbers, default=0) + 1:012d}-{version}")
    if not fs.createNewFile(path):
        raise OSError(f"cannot make {version} the current version of {target}")
    if version == _BACK:
        return
    kept = set(_history(spark, target)[-KEPT_VERSIONS:])
    known = {entry.getPath().getName().partition("-")[2] for entry in fs.listStatus(folder)}
    for old in known - kept - {version, _BACK, _NOTHING}:
        discard(spark, f"{target}/{_VERSIONS}/{old}")


def _live_paths(spark: SparkSession, folder: str) -> list[str]:
    """Folders and files that hold the rows of ``folder`` now.

    A folder with commits stands for its current version, at any depth. One with
    files and sub-folders is given by its files, or readers would take a part twice.
    """
    history = _history(spark, folder)
    if history:
        if history[-1] == _NOTHING:
            return []
        folder = f"{folder}/{_VERSIONS}/{history[-1]}"
    children = _children(spark, folder)
    files = [f"{folder}/{name}" for name, is_folder in children if not is_folder]
    parts = [live for name, is_folder in children if is_folder for live in _live_paths(spark, f"{folder}/{name}")]
    if files and not any(is_folder for _, is_folder in children):
        return [folder]
    return [*map(_literal, files), *parts]


def _literal(path: str) -> str:
    """A path whose characters stand for themselves."""
    return re.sub(r"([*?{}\[\]\\])", r"\\\1", path)


def _folder_to_add_to(spark: SparkSession, target: str) -> str:
    """The current version of ``target``, or ``target`` itself when it has no versions."""
    history = _history(spark, target)
    if not history:
        return target
    if history[-1] == _NOTHING:
        history.append(uuid.uuid4().hex)
        _commit(spark, target, history[-1])
    return f"{target}/{_VERSIONS}/{history[-1]}"
