"""Size checks in front of every broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crateflow.session import SMALL, footers, scratch_dir

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
_FIXED_WIDTH = 8


def _fixed_width(kind: T.DataType) -> int | None:
    """Bytes of a value whose size does not depend on its content."""
    if isinstance(kind, T.StructType):
        widths = [_fixed_width(field.dataType) for field in kind]
        return None if None in widths else _FIXED_WIDTH + sum(widths)
    loose = (T.StringType, T.BinaryType, T.ArrayType, T.MapType)
    return None if isinstance(kind, loose) else _FIXED_WIDTH


def _width(value: Column, kind: T.DataType) -> Column:
    """Bytes that a value takes, nested ones included."""
    fixed = _fixed_width(kind)
    if fixed is not None:
        return F.lit(fixed).cast("long")
    if isinstance(kind, T.StructType):
        return sum((_width(value[f.name], f.dataType) for f in kind), F.lit(_FIXED_WIDTH).cast("long"))
    if isinstance(kind, T.MapType):
        keys = _width(F.map_keys(value), T.ArrayType(kind.keyType))
        return keys + _width(F.map_values(value), T.ArrayType(kind.valueType))
    if isinstance(kind, T.ArrayType):
        fixed = _fixed_width(kind.elementType)
        if fixed is not None:
            return F.greatest(F.coalesce(F.size(value), F.lit(0)), F.lit(0)) * fixed + _FIXED_WIDTH
        each = F.transform(F.coalesce(value, F.array().cast(kind)), lambda x: _width(x, kind.elementType))
        return F.aggregate(each, F.lit(_FIXED_WIDTH).cast("long"), lambda total, x: total + x)
    return F.coalesce(F.octet_length(value), F.lit(0)).cast("long") + _FIXED_WIDTH


def fits_broadcast(
    df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None
) -> bool:
    """Count ``df`` and say whether it is small enough to copy to every executor.

    The row count comes first because a Parquet table answers it from its
    footers; only a table that passes has the lengths of its strings, arrays and maps added up. The
    check runs ``df``, so it belongs on tables and on what is cheap to derive
    from them; a costly result is stored first.
    """
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = BROADCAST_BYTES if max_bytes is None else max_bytes
    rows = df.count()
    if rows > max_rows or rows * _FIXED_WIDTH * len(df.columns) > max_bytes:
        return False
    if rows == 0 or all(_fixed_width(field.dataType) is not None for field in df.schema):
        return True
    width = sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(0).cast("long"))
    return df.agg(F.sum(width)).first()[0] <= max_bytes


def fits_hashing(spark: SparkSession, size: int) -> bool:
    """Whether a shuffle partition of a table of ``size`` bytes is small enough for a hash table.

    Holds for tables with few rows per key only, whose partitions are alike.
    """
    return size <= int(spark.conf.get("spark.sql.shuffle.partitions")) * BROADCAST_BYTES


def stored_with_size(df: DataFrame, label: str) -> tuple[DataFrame, bool]:
    """``df`` stored, and whether it is small enough to copy to every executor.

    Files written without the lengths of texts are measured by ``fits_broadcast``.
    """
    kept, rows, size = stored_measured(df, label)
    if size is None:
        return kept, fits_broadcast(kept)
    return kept, rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def stored_measured(df: DataFrame, label: str) -> tuple[DataFrame, int, int | None]:
    """``df`` stored, its rows and its bytes, if the files tell them.

    Both come from the footers of its files, so no job is needed.
    A footer says how long the texts of a column are in all before they are
    encoded; every value counts two fixed widths on top.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, label)
    df.write.parquet(path, compression=SMALL)
    kept = spark.read.schema(df.schema).parquet(path)
    rows, size = 0, 0
    for _, footer in footers(spark, path):
        for block in footer.getBlocks():
            rows += block.getRowCount()
            for column in block.getColumns() if size is not None else ():
                size += column.getValueCount() * 2 * _FIXED_WIDTH
                if column.getPrimitiveType().getPrimitiveTypeName().toString() == "BINARY":
                    known = column.getSizeStatistics()
                    length = known.getUnencodedByteArrayDataBytes() if known and known.isValid() else None
                    if length is None or not length.isPresent():
                        size = None
                        break
                    size += length.get()
    return kept, rows, size
