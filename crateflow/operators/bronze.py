"""Bronze: everything is a string and says where it came from."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.contracts import LINEAGE, PLATFORM


def attach_lineage(
    df: DataFrame,
    source_file: str,
    run_date: str,
    batch_id: str,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Add the five lineage columns; the time is taken once, here, not per task.

    It is UTC text with a marker, whatever the time zone of the session. A given
    time without a zone counts as UTC.
    """
    moment = ingested_at or datetime.now(UTC)
    moment = moment.astimezone(UTC) if moment.tzinfo else moment.replace(tzinfo=UTC)
    stamp = moment.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    values = (source_file, PLATFORM, run_date, stamp, batch_id)
    return df.withColumns({name: F.lit(value) for name, value in zip(LINEAGE, values)})


def cast_to_string(df: DataFrame) -> DataFrame:
    """Every column as string, in the same order."""
    return df.select([F.col(name).cast("string").alias(name) for name in df.columns])
