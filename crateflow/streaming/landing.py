"""Incremental landing: each new file is taken in once, with a status per file."""

from __future__ import annotations

import uuid
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession

from crateflow.contracts import LANDING_LOG, SOURCES, SourceSpec
from crateflow.jobs import Reader, bronze_frame, default_readers
from crateflow.sources.tables import (
    discard,
    log_frame,
    part_path,
    replace,
    run_dir,
    table_path,
    withdraw,
    write_replacing,
)

# fixed schema of the binaryFile source; only the path is read here
_FILES = "path string, modificationTime timestamp, length long, content binary"
_FILES_PER_BATCH = 10_000


def ingest_new_files(
    spark: SparkSession,
    landing_dir: str,
    bronze_root: str,
    checkpoint_dir: str,
    run_date: str,
    batch_id: str,
    readers: dict[str, Reader] | None = None,
) -> None:
    """Take every file not seen before into Bronze, then stop.

    Files lie in one folder per source, ``<landing>/<source file>/…``. The
    stream carries paths only. Its checkpoint remembers them, and a repeated
    micro-batch replaces its own part of the table as a whole, so nothing lands
    twice.
    """
    readers = readers or default_readers(spark)

    def take_in(batch: DataFrame, stream_batch: int) -> None:
        # names of new files, bounded by the size of a micro-batch
        paths = [row["path"] for row in batch.select("path").collect()]
        records = []
        for source, files in _by_source(paths).items():
            records += _ingest_source(
                spark, source, sorted(files), stream_batch, bronze_root, run_date, batch_id, readers
            )
        log = table_path(bronze_root, run_date, "landing_log")
        write_replacing(
            log_frame(spark, records, LANDING_LOG), part_path(spark, log, f"landed={stream_batch}")
        )

    stream = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", _FILES_PER_BATCH)
        .load(landing_dir)
        .select("path")
        .writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()


def _by_source(paths: list[str]) -> dict[SourceSpec | None, list[str]]:
    groups = defaultdict(list)
    for path in paths:
        folders = path.split("/")
        groups[next((s for s in SOURCES if s.file in folders), None)].append(path)
    return groups


def _ingest_source(
    spark: SparkSession,
    source: SourceSpec | None,
    files: list[str],
    stream_batch: int,
    bronze_root: str,
    run_date: str,
    batch_id: str,
    readers: dict[str, Reader],
) -> list[dict]:
    """All files of a source in one job; by halves when that fails.

    The half without the bad file goes in at once, so a bad file among n costs
    about log n jobs. What could be read is gathered beside the table and then
    replaces the part of this batch, whatever an earlier attempt left there; when
    nothing could be read, that part goes.
    """
    if source is None:
        return [_record(path, "failed", "no source with this folder name") for path in files]
    table = table_path(bronze_root, run_date, source.name)
    part = part_path(spark, table, f"landed={stream_batch}")
    staged = f"{run_dir(bronze_root, run_date)}/_staging/{uuid.uuid4().hex}"

    def take(paths: list[str]) -> list[dict]:
        target = f"{staged}/files={uuid.uuid4().hex}"
        try:
            raw = readers[source.format](source, paths)
            bronze_frame(raw, source, run_date, batch_id).write.parquet(target)
            return [_record(path, "success") for path in paths]
        except Exception as error:  # noqa: BLE001 -- one bad file must not stop the others
            discard(spark, target)
            if len(paths) == 1:
                return [_record(paths[0], "failed", str(error))]
        half = len(paths) // 2
        return take(paths[:half]) + take(paths[half:])

    records = take(files)
    if any(record["status"] == "success" for record in records):
        replace(spark, staged, part)
    else:
        withdraw(spark, part)
    return records


def _record(path: str, status: str, error: str | None = None) -> dict:
    name = path.rsplit("/", 1)[-1]
    return {"source_file": name, "status": status, "path": path, "error": error}
