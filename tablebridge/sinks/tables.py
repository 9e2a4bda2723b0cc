"""Target databases and tables of the session catalog."""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablebridge.functions.literals import sql_text
from tablebridge.functions.naming import quoted, ref
from tablebridge.functions.types import spark_type
from tablebridge.session import scratch_path
from tablebridge.sinks.versions import INDEXED, can_switch, load_version

log = logging.getLogger(__name__)

_CALL = re.compile(r"[A-Za-z_][\w.]*\s*\(.*\)", re.S)
_TEXT = re.compile(r"'((?:[^']|'')*)'", re.S)
_NUMBER = re.compile(r"[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?")


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION {sql_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{where}")


def default_literal(text: str | None, dtype: T.DataType) -> str | None:
    """A catalog default as a Spark SQL literal; None when there is none.

    Quoted text, numbers, booleans and NULL are kept, with casts and outer
    parentheses removed. Calls and expressions are dropped.
    """
    value = (text or "").strip()
    while value.startswith("(") and value.endswith(")"):
        value = value[1:-1].strip()
    value = re.sub(r"(::[\w .]+(\([\d, ]+\))?(\[\])?)+$", "", value).strip()
    if not value or _CALL.fullmatch(value):
        return None
    match = _TEXT.fullmatch(value)
    if match:
        kept = sql_text(match.group(1).replace("''", "'"))
    elif _NUMBER.fullmatch(value) or value.upper() in ("TRUE", "FALSE", "NULL"):
        kept = value
    else:
        log.warning("default dropped, it is not a literal: %s", text)
        return None
    if kept == "NULL" or isinstance(dtype, T.StringType) and match:
        return kept
    return f"CAST({kept} AS {dtype.simpleString()})"


def column_definitions(columns: Iterable[Mapping[str, Any]]) -> list[str]:
    """Column definitions from converted metadata rows."""
    found = []
    for column in columns:
        type_name, length = column["type"], column.get("length")
        dtype = spark_type(type_name)
        parts = [quoted(column["name"]), dtype.simpleString()]
        if (column.get("nullable") or "").strip() == "NO":
            parts.append("NOT NULL")
        literal = default_literal(column.get("default"), dtype)
        if literal is not None:
            parts.append(f"DEFAULT {literal}")
        if type_name.upper() in ("VARCHAR", "CHAR") and length:
            type_name = f"{type_name}({length})"
        parts.append(f"COMMENT {sql_text(type_name)}")
        found.append(" ".join(parts))
    return found


def create_table(
    spark: SparkSession,
    table: str,
    columns: Iterable[Mapping[str, Any]],
    location: str | None = None,
    database: str | None = None,
) -> str:
    """Create a parquet table from metadata rows if missing; its full name.

    NOT NULL is recorded but not enforced by parquet tables; ``key_violations``
    checks it. The declared type stays readable as the column's comment. Columns flagged
    ``is_index`` are recorded too, and loads of whole versions lay the files out by them.
    """
    columns = list(columns)
    name = f"{quoted(database)}.{quoted(table)}" if database else quoted(table)
    where = f" LOCATION {sql_text(location)}" if location else ""
    body = ", ".join(column_definitions(columns))
    flagged = [c["name"] for c in columns if str(c.get("is_index") or "").strip().upper() == "YES"]
    noted = f" TBLPROPERTIES ({sql_text(INDEXED)} = {sql_text(json.dumps(flagged))})" if flagged else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING parquet{where}{noted}")
    return name


def insert_rows(df: DataFrame, table: str) -> None:
    """Append rows by column name; missing columns take their defaults."""
    names = ", ".join(quoted(name) for name in df.columns)
    df.sparkSession.sql(f"INSERT INTO {table} ({names}) SELECT {names} FROM {{rows}}", rows=df)


def truncate_table(spark: SparkSession, table: str) -> None:
    """Empty a table and keep its structure.

    Spark truncates only tables whose files it manages; a table with a location of its own gets an empty version,
    and a partitioned one is overwritten with no rows.
    """
    if spark.catalog.getTable(table).tableType == "MANAGED":
        spark.sql(f"TRUNCATE TABLE {table}")
        return
    nothing = spark.createDataFrame([], spark.table(table).schema)
    if can_switch(spark, table):
        load_version(nothing, table)
    else:
        spark.sql(f"INSERT OVERWRITE TABLE {table} SELECT * FROM {{rows}}", rows=nothing)


def _staged(df: DataFrame) -> DataFrame:
    """The rows, computed once and written to the shared folder."""
    path = scratch_path(df.sparkSession, "load")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reload_files(df: DataFrame, path: str) -> DataFrame:
    """Replace everything under a path with the rows, and read them back.

    The rows are computed in full before the old files go, so a load that fails
    on its input leaves them.
    """
    _staged(df).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reload_table(df: DataFrame, table: str) -> None:
    """Replace all rows of a table and keep its structure.

    A table with a location of its own gets a new version (``versions``): readers see the old rows until all new ones
    are in place. For managed and partitioned tables the rows are computed, converted to the table's types and
    written beside it before the overwrite, so a load that fails on its input or its values leaves the
    old rows; only the copy of finished files is not undone there.
    """
    types = {f.name: f.dataType for f in df.sparkSession.table(table).schema.fields}
    unknown = set(df.columns) - set(types)
    if unknown:
        raise ValueError(f"no such columns in {table}: {sorted(unknown)}")
    if can_switch(df.sparkSession, table):
        load_version(df, table)
        return
    rows = _staged(df.select([ref(name).cast(types[name]).alias(name) for name in df.columns]))
    names = ", ".join(quoted(name) for name in df.columns)
    df.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {table} ({names}) SELECT {names} FROM {{rows}}", rows=rows
    )


def analyze_table(spark: SparkSession, table: str) -> bool:
    """Refresh planner statistics; a failure is logged, not raised."""
    try:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    except Exception as error:  # statistics must not break a finished load
        log.warning("statistics of %s not refreshed: %s", table, error)
        return False
    return True
