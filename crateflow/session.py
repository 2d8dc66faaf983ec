"""Folders every executor can reach, and intermediate tables in them."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from threading import Lock

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

# Compression that makes strings of a source a quarter smaller than the default and takes longer.
SMALL = "zstd"
# Whether Spark removes the shuffle files of an execution with it; how many jobs of a session
# want that, and what was set before them.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: defaultdict[SparkSession, int] = defaultdict(int)
_cleanup_before: dict[SparkSession, str | None] = {}
_cleanup_lock = Lock()
# Folder below the scratch folder of the application, while a job runs: that of the
# innermost job of this thread, and of threads that work for it (``in_this_job``).
_JOB: ContextVar[str | None] = ContextVar("crateflow_job", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, also set on the context.

    Only a local session may go without the setting (it then gets a temporary
    folder): on a cluster a machine-local folder would lose checkpointed
    partitions together with the executor that wrote them. That the named folder
    is a shared one cannot be seen from here.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="crateflow-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate tables.

    It lies in a folder of this application, which goes when the application
    ends, or in that of the running job (``scratch_of_job``), which goes with
    the job.
    """
    root = f"{shared_dir(spark).rstrip('/')}/scratch-{spark.sparkContext.applicationId}"
    path, fs = _file_system(spark, root)
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return "/".join(filter(None, [root, _JOB.get(), f"{label}-{uuid.uuid4().hex}"]))


@contextmanager
def scratch_of_job(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables of a job once its results are written.

    Jobs in other threads have folders of their own.
    """
    outer = _JOB.set(f"job-{uuid.uuid4().hex}")
    folder = scratch_dir(spark, "x").rsplit("/", 1)[0]
    try:
        yield
    finally:
        _JOB.reset(outer)
        path, fs = _file_system(spark, folder)
        fs.delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of each execution when it ends, not once the driver collects garbage.

    A frame that is run again shuffles again, so this is for jobs that run each once.
    The setting is that of the session: the last of several jobs puts it back.
    """
    with _cleanup_lock:
        if not _cleaning[spark]:
            _cleanup_before[spark] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _cleaning[spark] += 1
    try:
        yield
    finally:
        with _cleanup_lock:
            _cleaning[spark] -= 1
            if not _cleaning[spark]:
                del _cleaning[spark]
                before = _cleanup_before.pop(spark)
                if before is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, before)


def in_this_job(work: Callable) -> Callable:
    """``work`` for threads of a pool: what it stores belongs to the job that runs now."""
    context = copy_context()
    return lambda *args: context.copy().run(work, *args)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a scratch table and read back.

    For a result that is used several times: later passes see the very same
    rows and partitions, also after executors were lost, and its size is known
    from the files.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path, compression=SMALL)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_alone(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` gives, stored; the tables it stored on the way are removed."""
    path = scratch_dir(spark, label)
    with scratch_of_job(spark):
        df = build()
        df.write.parquet(path, compression=SMALL)
    return spark.read.schema(df.schema).parquet(path)


def rows_per_task(spark: SparkSession, path: str) -> dict[int, int]:
    """Rows that each task wrote to a Parquet folder, from the footers of its files."""
    rows: dict[int, int] = defaultdict(int)
    for task, footer in footers(spark, path):
        rows[task] += sum(block.getRowCount() for block in footer.getBlocks())
    return dict(rows)


def footers(spark: SparkSession, path: str) -> Iterator[tuple[int, JavaObject]]:
    """Task and footer of each file of a Parquet folder that one job wrote; no job is needed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    parquet = jvm.org.apache.parquet.hadoop
    folder, fs = _file_system(spark, path)
    for entry in fs.listStatus(folder):
        part = re.match(r"part-(\d+)-", entry.getPath().getName())
        if part:
            reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromStatus(entry, conf))
            footer = reader.getFooter()
            reader.close()
            yield int(part[1]), footer


def _file_system(spark: SparkSession, name: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())
