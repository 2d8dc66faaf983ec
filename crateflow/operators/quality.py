"""Data-quality tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.contracts import UNKNOWN_KEY, SourceSpec
from crateflow.functions.columns import day, is_number, share

# above this share of NULLs a date format is more likely wrong than the data
NULL_RATIO_ALARM = 0.5


def _unpivot(totals: DataFrame, entries: list[str], columns: str) -> DataFrame:
    """Turn one row of aggregates into one row per entry."""
    return totals.selectExpr(f"stack({len(entries)}, {', '.join(entries)}) AS ({columns})")


def date_null_ratio(df: DataFrame, source: SourceSpec) -> DataFrame:
    """Per date column of a string table: NULLs after parsing, how many of them are new."""
    counts = [F.count("*").alias("rows")]
    for i, name in enumerate(source.dates):
        parsed = day(name, source.date_format)
        counts.append(F.count_if(parsed.isNull()).alias(f"n{i}"))
        counts.append(F.count_if(parsed.isNull() & F.col(name).isNotNull()).alias(f"f{i}"))
    entries = [f"'{name}', rows, n{i}, f{i}" for i, name in enumerate(source.dates)]
    table = _unpivot(df.agg(*counts), entries, "column_name, row_count, null_rows, newly_null_rows")
    ratio = share(F.col("null_rows"), F.col("row_count"))
    return table.withColumns(
        {
            "null_ratio": ratio,
            "level": F.when(ratio > NULL_RATIO_ALARM, "warning").otherwise("info"),
        }
    )


def contract_profile(df: DataFrame, source: SourceSpec) -> DataFrame:
    """Per contract column of a string table: is it there, filled, and readable as its type."""
    roles = {name: "text" for name in source.columns}
    roles |= {name: "number" for name in source.numbers}
    roles |= {name: "date" for name in source.dates}
    counts = [F.count("*").alias("rows")]
    entries = []
    for i, (name, role) in enumerate(roles.items()):
        if name not in df.columns:
            entries.append(f"'{name}', '{role}', false, rows, 0L, 0L")
            continue
        readable = {
            "number": is_number(name),
            "date": day(name, source.date_format).isNotNull(),
            "text": F.col(name).isNotNull(),
        }[role]
        counts += [F.count(name).alias(f"f{i}"), F.count_if(readable).alias(f"p{i}")]
        entries.append(f"'{name}', '{role}', true, rows, f{i}, p{i}")
    return _unpivot(
        df.agg(*counts),
        entries,
        "column_name, role, is_present, row_count, filled_rows, parseable_rows",
    )


def grain_violations(fact: DataFrame, business_key: list[str]) -> DataFrame:
    """Business keys that occur more than once."""
    return fact.groupBy(*business_key).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def key_resolution(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Per foreign key: rows that point at the unknown member, and rows without a key."""
    counts = [F.count("*").alias("rows")]
    for key in keys:
        counts.append(F.count_if(F.col(key) == UNKNOWN_KEY).alias(f"{key}_u"))
        counts.append(F.count_if(F.col(key).isNull()).alias(f"{key}_n"))
    entries = [f"'{key}', rows, {key}_u, {key}_n" for key in keys]
    table = _unpivot(fact.agg(*counts), entries, "key_name, row_count, unknown_rows, null_rows")
    return table.withColumn("unknown_ratio", share(F.col("unknown_rows"), F.col("row_count")))


def rows_lost(silver_log: DataFrame) -> DataFrame:
    """Per source: rows that went in, came out, and why the others were dropped."""
    names = ["row_count_in", "row_count_out", "dedup_count", "null_count"]
    lost = F.sum("row_count_in") - F.sum("row_count_out")
    return silver_log.groupBy("source_name").agg(
        *[F.sum(name).alias(name) for name in names], lost.alias("rows_lost")
    )


def run_success(log: DataFrame, by: str = "batch_id") -> DataFrame:
    """Per batch: sources, successes, their share, and the outcome of the run."""
    good = F.count_if(F.col("status") == "success")
    return log.groupBy(by).agg(
        F.count("*").alias("sources"),
        good.alias("succeeded"),
        share(good, F.count("*")).alias("success_rate"),
        F.when(good == F.count("*"), "OK").otherwise("FAILED").alias("outcome"),
    )
