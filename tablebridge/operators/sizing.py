"""Probes of size that choose how a join runs.

They never change a result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.naming import ref

MAX_BROADCAST_ROWS = 10_000
MAX_BROADCAST_BYTES = 32 * 1024 * 1024


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Whether all of ``df`` is within the row and byte bounds.

    ``take`` reads partitions only until the row bound is passed, and brings
    back one number per row, so the probe costs the same on any table.
    """
    size = reduce(lambda a, b: a + b, [_bytes(f) for f in df.schema.fields], F.lit(8))
    sizes = df.select(size.alias("bytes")).take(max_rows + 1)
    return len(sizes) <= max_rows and sum(row["bytes"] for row in sizes) <= max_bytes


def _bytes(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.AtomicType) and not isinstance(
        field.dataType, (T.StringType, T.BinaryType)
    ):
        return F.lit(16)
    value = ref(field.name)
    if not isinstance(field.dataType, (T.StringType, T.BinaryType)):
        value = F.to_json(F.struct(value))
    return F.coalesce(F.octet_length(value), F.lit(0)) + 16


def planned_broadcast(df: DataFrame) -> bool:
    """Whether Spark itself takes ``df`` for small enough to broadcast, by its statistics; runs nothing."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= conf.autoBroadcastJoinThreshold()
