"""Partitioned targets: by range of dates, by list of values, by hash."""

from __future__ import annotations

import datetime as dt
import re
import zlib
from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.literals import typed_literal
from tablebridge.functions.naming import quoted, ref, unused

# Partition methods, and where unmatched rows and nulls go.
METHODS = ("RANGE", "LIST", "HASH")
DEFAULT_LABEL = "default"
LABEL = "part"


def partition_method(name: str | None) -> str:
    method = (name or "RANGE").upper()
    if method not in METHODS:
        raise ValueError(f"unsupported partition method: {name!r}")
    return method


def safe_label(text: Any) -> str:
    """A label usable as an identifier."""
    return re.sub(r"[^A-Za-z0-9_]", "_", str(text))


def date_ranges(strategy: str, ranges: Sequence[str]) -> dict[str, tuple[dt.date, dt.date]]:
    """Labels with their half-open date ranges."""
    kind = (strategy or "").strip().lower()
    if kind not in ("year", "month"):
        raise ValueError(f"unsupported partition strategy: {strategy!r}")
    if not ranges:
        raise ValueError("the list of ranges is empty")
    found = {}
    for entry in ranges:
        if kind == "year":
            start = dt.datetime.strptime(str(entry), "%Y").date()
            end = start.replace(year=start.year + 1)
        else:
            start = dt.datetime.strptime(str(entry), "%Y-%m").date()
            end = (start + dt.timedelta(days=31)).replace(day=1)
        found[safe_label(entry)] = (start, end)
    return found


def range_label(column: Column, strategy: str, ranges: Sequence[str]) -> Column:
    """The label of a date's range, or the default label.

    Labels come from one lookup of the date's year or month, however many
    ranges there are.
    """
    pairs = []
    for label, (start, _) in date_ranges(strategy, ranges).items():
        pairs += [F.lit(_ordinal(strategy, start)), F.lit(label)]
    ordinal = F.year(column)
    if strategy.strip().lower() == "month":
        ordinal = ordinal * 12 + F.month(column)
    return F.coalesce(F.try_element_at(F.create_map(*pairs), ordinal), F.lit(DEFAULT_LABEL))


def list_labels(values: Iterable[Any]) -> dict[str, Any]:
    """Labels of listed values. A label that is taken, or is the default's, gets a checksum."""
    found: dict[str, Any] = {}
    for value in dict.fromkeys(values):
        label = safe_label(value)
        if label in found or label == DEFAULT_LABEL:
            label = f"{label}_{zlib.crc32(str(value).encode()):08x}"
        if label in found:
            raise ValueError(f"two listed values share the label {label!r}")
        found[label] = value
    return found


def list_label(column: Column, dtype: T.DataType, values: Iterable[Any]) -> Column:
    """The listed value's label, or the default label, by one lookup."""
    pairs = [
        item
        for label, value in list_labels(values).items()
        for item in (typed_literal(value, dtype).cast(dtype), F.lit(label))
    ]
    if not pairs:
        return F.lit(DEFAULT_LABEL)
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), F.lit(DEFAULT_LABEL))


def with_range_label(
    df: DataFrame, column: str, strategy: str, ranges: Sequence[str], name: str = LABEL
) -> DataFrame:
    return df.withColumn(unused(df, name), range_label(ref(column), strategy, ranges))


def with_list_label(
    df: DataFrame, column: str, values: Iterable[Any], name: str = LABEL
) -> DataFrame:
    dtype = df.select(ref(column)).schema[0].dataType
    return df.withColumn(unused(df, name), list_label(ref(column), dtype, values))


def write_partitioned(
    df: DataFrame, path: str, label: str = LABEL, mode: str = "overwrite"
) -> None:
    """Write one folder per label.

    Rebalancing by label gives few files per folder, and AQE cuts a label with
    many rows into several tasks.
    """
    df.hint("rebalance", quoted(label)).write.mode(mode).partitionBy(label).parquet(path)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read it back; the schema keeps labels such as ``1996`` text."""
    return spark.read.schema(schema).parquet(path)


def in_dates(
    df: DataFrame,
    column: str,
    strategy: str,
    ranges: Sequence[str],
    start: dt.date | str,
    end: dt.date | str,
    label: str = LABEL,
) -> DataFrame:
    """Rows dated in ``[start, end)``, reading only folders that can hold them.

    A filter on the date alone prunes nothing, because the folder is a label.
    """
    low, high = (dt.date.fromisoformat(str(day)) for day in (start, end))
    known = date_ranges(strategy, ranges)
    wanted = [name for name, (first, last) in known.items() if first < high and last > low]
    day, uncovered = low, False
    for first, last in sorted(known.values()):
        if first > day and day < high:
            uncovered = True
        day = max(day, last) if first <= day else day
    if uncovered or day < high:
        wanted.append(DEFAULT_LABEL)
    dtype = df.select(ref(column)).schema[0].dataType
    dated = (ref(column) >= typed_literal(str(low), dtype)) & (
        ref(column) < typed_literal(str(high), dtype)
    )
    return df.where(ref(label).isin(wanted) & dated)


def write_hashed(
    df: DataFrame, table: str, column: str, buckets: int, path: str, sort_by: str | None = None
) -> None:
    """A bucketed table; joins and groups on the column need no shuffle.

    Rows are rebalanced into the same hash classes first, so each bucket gets
    few files, and AQE cuts a crowded bucket into several.
    """
    writer = (
        df.hint("rebalance", buckets, quoted(column))
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, column)
    )
    if sort_by:
        writer = writer.sortBy(sort_by)
    writer.option("path", path).saveAsTable(table)


def write_target(
    df: DataFrame,
    path: str,
    column: str,
    method: str | None = "RANGE",
    strategy: str = "year",
    ranges: Sequence[str] = (),
    values: Sequence[Any] = (),
    table: str | None = None,
    buckets: int = 0,
    label: str = LABEL,
) -> T.StructType | None:
    """A partitioned target by RANGE, LIST or HASH.

    Returns the schema to read RANGE and LIST targets back with; a HASH target
    is a table of the catalog.
    """
    method = partition_method(method)
    if method == "HASH":
        if not table or buckets < 1:
            raise ValueError("HASH needs a table name and a number of buckets")
        write_hashed(df, table, column, buckets, path)
        return None
    if method == "RANGE":
        labelled = with_range_label(df, column, strategy, ranges, label)
    else:
        labelled = with_list_label(df, column, values, label)
    write_partitioned(labelled, path, label)
    return labelled.schema


def _ordinal(strategy: str, start: dt.date) -> int:
    return start.year if strategy.strip().lower() == "year" else start.year * 12 + start.month
