"""Pages of a table: offset and limit over a stated order.

A shallow page is a top-k, which Spark runs without a full sort. A deep page
would pull everything before it through one task, so it is read from a numbered
copy instead: one distributed sort gives every row its number, and any page is
then a range of numbers. Both order rows by the key columns, nulls first, and then
by a hash of the row, so pages fit together whichever way each was read.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablebridge.functions.hashing import range_partitioned, row_hash
from tablebridge.functions.naming import name_list, ref
from tablebridge.functions.text import stringify
from tablebridge.operators.filters import checked_conditions, filter_rows
from tablebridge.session import scratch_path

# A page that ends past this row is read from a numbered copy.
TOP_K_ROWS = 100_000
_ROW_BITS = (1 << 33) - 1


def page(
    df: DataFrame,
    order_by: str | Sequence[str],
    offset: int = 0,
    limit: int = 100,
    filters: Any = None,
    strict: bool = False,
    top_k_rows: int = TOP_K_ROWS,
    copy: str | None = None,
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in the order of the key columns.

    Past ``top_k_rows`` it needs ``copy``, the path that ``number_rows`` returned for
    the same rows, order and filters: sorting them all again for every page would not do. A copy of
    another order or of other filters is refused, wherever the page ends.
    """
    if offset < 0 or limit < 0:
        raise ValueError("offset and limit must not be negative")
    if copy is not None:
        _check_copy(df.sparkSession, copy, order_by, filters, strict)
    if offset + limit <= top_k_rows:
        rows = filter_rows(df, filters, strict)
        order = [ref(name) for name in name_list(order_by)]
        return rows.orderBy(*order, row_hash(rows)).offset(offset).limit(limit)
    if copy is None:
        raise ValueError(
            f"a page that ends past row {top_k_rows} is read from a numbered copy: "
            "pass copy=number_rows(rows, order_by, filters=filters)"
        )
    return read_page(df.sparkSession, copy, offset, limit)


def page_text(
    df: DataFrame, order_by: str | Sequence[str], *args: Any, **options: Any
) -> DataFrame:
    """A page whose values are all text."""
    return stringify(page(df, order_by, *args, **options))


def next_page(
    df: DataFrame, order_by: str | Sequence[str], after: Sequence[Any] | None, limit: int = 100
) -> DataFrame:
    """The page that follows the key values of the last row seen.

    Unlike an offset this skips nothing it has to read first: the key bound is
    pushed down to the scan and the limit is a plain top-k. Nulls come first, in
    the bound as in the order. The columns together must be a key: rows that share
    all their values with the last one seen would not follow it.
    """
    names = name_list(order_by)
    if after is not None:
        if len(after) != len(names):
            raise ValueError("one value per key column is required")
        bound, equal = F.lit(False), F.lit(True)
        for name, value in zip(names, after):
            beyond = ref(name).isNotNull() if value is None else ref(name) > F.lit(value)
            bound = bound | (equal & beyond)
            equal = equal & ref(name).eqNullSafe(F.lit(value))
        if after[0] is not None:
            bound = (ref(names[0]) >= F.lit(after[0])) & bound
        df = df.where(bound)
    return df.orderBy(*[ref(name) for name in names]).limit(limit)


def number_rows(
    df: DataFrame,
    order_by: str | Sequence[str],
    path: str | None = None,
    filters: Any = None,
    strict: bool = False,
) -> str:
    """Store a copy of ``df``, or of its rows that pass ``filters``, in order, for ``page`` and ``read_page``; returns its path.

    Rows are range-partitioned and sorted, and written with their place inside
    the partition. Partition sizes, one row each, are summed up to starting
    numbers beside it. The copy is written before the sizes are read, so both
    see the same partitions even if executors are lost.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "numbered")
    rows = filter_rows(df, filters, strict)
    ranged, order = range_partitioned(rows, [ref(name) for name in name_list(order_by)])
    ranged.sortWithinPartitions(*order).select(
        *[ref(name) for name in df.columns],
        F.spark_partition_id().alias("__part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("__place"),
    ).write.mode("overwrite").parquet(f"{path}/rows")

    sizes = (
        spark.read.parquet(f"{path}/rows").groupBy("__part").agg(F.count(F.lit(1)).alias("size"))
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(before), F.lit(0))
    sizes.withColumn("start", start).write.mode("overwrite").parquet(f"{path}/starts")
    named = spark.createDataFrame([(_described(order_by, filters, strict),)], "made_of string")
    named.coalesce(1).write.mode("overwrite").parquet(f"{path}/made_of")
    return path


def _described(order_by: str | Sequence[str], filters: Any, strict: bool) -> str:
    """Order and usable filters of a copy, as one text; the filters' own order does not matter."""
    conditions = sorted(json.dumps(c, default=str) for c in checked_conditions(filters, strict))
    return json.dumps([name_list(order_by), conditions])


def _check_copy(spark: SparkSession, copy: str, order_by: str | Sequence[str], filters: Any, strict: bool) -> None:
    made_of = spark.read.schema("made_of string").parquet(f"{copy}/made_of").first()
    if made_of is None or made_of["made_of"] != _described(order_by, filters, strict):
        raise ValueError("the numbered copy has another order or other filters; number_rows takes both")


def read_page(spark: SparkSession, path: str, offset: int, limit: int) -> DataFrame:
    """Rows by number from a stored copy, in order; numbers start at zero.

    The partitions that hold the page are looked up first, so the scan skips
    every other file and row group by its statistics.
    """
    rows = spark.read.parquet(f"{path}/rows")
    starts = spark.read.parquet(f"{path}/starts")
    end = offset + limit
    holders = starts.where(
        (F.col("start") < end) & (F.col("start") + F.col("size") > offset)
    ).collect()
    wanted = F.lit(False)
    for part in holders:
        low, high = max(offset - part["start"], 0), min(end - part["start"], part["size"])
        inside = F.col("__place").between(low, high - 1)
        wanted = wanted | ((F.col("__part") == part["__part"]) & inside)
    return rows.where(wanted).orderBy("__part", "__place").drop("__part", "__place")
