"""Compare a Spark result with a DuckDB result, in any row order."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter
from typing import Any

import duckdb


def duck_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value: Any) -> Any:
    """A value both engines' clients agree on."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(item) for item in value)
    return value


def counted(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark_df, sql: str, connection) -> str | None:
    """None when equal, else a short description."""
    cursor = connection.execute(sql)
    names = [entry[0] for entry in cursor.description]
    expected = cursor.fetchall()
    found = [tuple(row) for row in spark_df.collect()]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    left, right = counted(spark_df.columns, found), counted(names, expected)
    if left != right:
        return (
            f"{sum(left.values())} rows, expected {sum(right.values())};"
            f" extra {list((left - right).items())[:3]} missing {list((right - left).items())[:3]}"
        )
    return None
