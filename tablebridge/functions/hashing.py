"""A hash of a whole row, and range partitions that cut runs of equal keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.naming import ref


HELPERS = ("__hash", "__copy")


def row_hash(df: DataFrame) -> Column:
    """A number that depends on the row's values only; maps are left out."""
    return F.xxhash64(*[ref(f.name) for f in df.schema.fields if _hashable(f.dataType)])


def range_partitioned(df: DataFrame, order: Sequence[Column]) -> tuple[DataFrame, list[Column]]:
    """Rows in ranges of an order, and the full order to sort them by.

    After the order itself come a hash of the row, which cuts a run of equal
    keys, and a number that tells copies of a row apart. Rows are sorted by hash
    before they are numbered, so a task that runs again gives the same numbers
    even if its input arrives in another order. The helper columns stay in the
    result: ``HELPERS``.
    """
    numbered = (
        df.withColumn("__hash", row_hash(df))
        .sortWithinPartitions("__hash")
        .withColumn("__copy", F.monotonically_increasing_id())
    )
    full = [*order, *[F.col(name) for name in HELPERS]]
    return numbered.repartitionByRange(*full), full


def _hashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))
