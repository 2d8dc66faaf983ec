"""Compare a Spark result with a DuckDB result, whatever the row and column order."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None when both give the same columns and rows."""
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} / {sorted(names)}"
    theirs = bag(names, result.fetchall())
    ours = bag(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if ours == theirs:
        return None
    return (
        f"rows {sum(ours.values())} / {sum(theirs.values())}; columns {sorted(names)};"
        f" only Spark {list((ours - theirs).items())[:3]};"
        f" only DuckDB {list((theirs - ours).items())[:3]}"
    )
