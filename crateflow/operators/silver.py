"""Silver: contract check, typing, text clean-up, deduplication, key check."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateflow.contracts import LINEAGE, ROW_SEQ, SourceSpec
from crateflow.functions.columns import day, number, plain_text
from crateflow.plans.sizing import stored_with_size

_log = logging.getLogger(__name__)
# Bits of a row hash that are counted: unlike rows that share one are compared in vain,
# some 100,000 of 500 million.
_HASH_BITS = 40


class ContractError(ValueError):
    """What a source delivers and what its contract asks for do not fit."""

    @classmethod
    def of(cls, source: SourceSpec, lacking: set[str]) -> ContractError:
        names = ", ".join(sorted(lacking))
        return cls(f"{source.name} came without {len(lacking)} of {len(source.columns)} columns: {names}")


def check_contract(df: DataFrame, source: SourceSpec) -> None:
    """Raise when required columns are missing; extra ones are only reported."""
    lacking = set(source.columns) - set(df.columns)
    extra = sorted(set(df.columns) - {*source.columns, *LINEAGE, ROW_SEQ})
    if extra:
        _log.warning("%s: columns outside the contract: %s", source.file, extra)
    if lacking:
        raise ContractError.of(source, lacking)


def cast_numbers(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Money and quantities to double; text that is no number fails the query."""
    return df.withColumns({name: number(name) for name in columns}) if columns else df


def cast_dates(df: DataFrame, columns: tuple[str, ...], date_format: str) -> DataFrame:
    """Dates by format; bad ones become NULL."""
    return df.withColumns({name: day(name, date_format) for name in columns}) if columns else df


def standardize_text(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Trim and uppercase."""
    return df.withColumns({name: plain_text(name) for name in columns}) if columns else df


def drop_copies(df: DataFrame) -> DataFrame:
    """Keep one of several equal rows, with the lowest row position if there is one.

    Copies meet in the map-side aggregation, so a row repeated any number of
    times reaches the shuffle once per task.
    """
    if ROW_SEQ not in df.columns:
        return df.dropDuplicates()
    rest = [name for name in df.columns if name != ROW_SEQ]
    return df.groupBy(*rest).agg(F.min(ROW_SEQ).alias(ROW_SEQ)).select(*df.columns)


def drop_few_copies(df: DataFrame, by: list[str]) -> DataFrame:
    """``drop_copies`` for a stored table, with whole rows shuffled only if they may have a copy.

    Equal rows have equal hashes of ``by``, whichever columns these are, so hashes are
    counted first, and only rows whose hash occurs several times are compared in full.
    If there are too many such hashes to broadcast, every row is.
    """
    hashed = df.withColumn("_h", F.shiftrightunsigned(F.xxhash64(*by), 64 - _HASH_BITS))
    several = hashed.groupBy("_h").agg(F.count("*").alias("_rows")).where("_rows > 1").select("_h")
    several, fits = stored_with_size(several, "row-hashes")
    if not fits:
        return drop_copies(df)
    if several.isEmpty():
        return df
    known = F.broadcast(several)
    compared = drop_copies(hashed.join(known, "_h", "left_semi").drop("_h"))
    return hashed.join(known, "_h", "left_anti").drop("_h").unionByName(compared)


def any_null(columns: tuple[str, ...]) -> Column:
    """True when at least one of ``columns`` is NULL."""
    return reduce(Column.__or__, [F.col(name).isNull() for name in columns])


def drop_null_keys(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Keep rows whose keys are all filled."""
    return df.na.drop(how="any", subset=list(columns))


def fill_null(df: DataFrame, columns: tuple[str, ...], value: str) -> DataFrame:
    """Put ``value`` where ``columns`` are NULL."""
    return df.fillna(value, subset=list(columns))


def typed(df: DataFrame, source: SourceSpec) -> DataFrame:
    """The column-wise part of the clean-up: types and text, no rows removed."""
    df = cast_numbers(df, source.numbers)
    df = cast_dates(df, source.dates, source.date_format)
    df = standardize_text(df, source.texts)
    if ROW_SEQ in df.columns:
        df = df.withColumn(ROW_SEQ, F.col(ROW_SEQ).cast("long"))
    return df


def transform(df: DataFrame, source: SourceSpec, few_copies: bool = False) -> DataFrame:
    """One source from Bronze to Silver as a single lazy plan.

    With ``few_copies`` a job looks for rows that may have a copy before that; ``df`` is
    then to be a stored table.
    """
    check_contract(df, source)
    df = typed(df, source)
    if few_copies:
        # typing leaves these as they are, so the search reads no other columns
        changed = {*source.numbers, *source.dates, *source.texts}
        df = drop_few_copies(df, [name for name in source.columns if name not in changed])
    else:
        df = drop_copies(df)
    df = drop_null_keys(df, source.keys)
    for column, value in source.fills:
        df = fill_null(df, (column,), value)
    return df


def null_key_rows(df: DataFrame, source: SourceSpec) -> DataFrame:
    """The rows ``transform`` drops for an empty key, each copy group once.

    Keys are not changed by typing, so the filter can go first and reaches the
    Parquet scan; only the few rows it keeps are typed and deduplicated.
    """
    return drop_copies(typed(df.filter(any_null(source.keys)), source))


def transform_stats(df: DataFrame, source: SourceSpec) -> DataFrame:
    """Rows in, rows out, copies and empty keys of ``transform``, as one row.

    Grouping with a count does what the deduplication does and keeps how often
    each row occurred, so one shuffle answers all four.
    """
    check_contract(df, source)
    cleaned = typed(df, source).drop(ROW_SEQ)
    groups = cleaned.groupBy(*cleaned.columns).agg(F.count("*").alias("_copies"))
    empty = F.count_if(any_null(source.keys))
    rows = F.coalesce(F.sum("_copies"), F.lit(0))
    return groups.agg(
        rows.alias("row_count_in"),
        (F.count("*") - empty).alias("row_count_out"),
        (rows - F.count("*")).alias("dedup_count"),
        empty.alias("null_count"),
    )
