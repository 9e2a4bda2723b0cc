"""Key checks and column statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.naming import name_list, ref
from tablebridge.functions.text import value_text


def key_violations(
    df: DataFrame, columns: str | Sequence[str], nulls_allowed: bool = False
) -> DataFrame:
    """Key values that break a primary key, with their row counts.

    A value breaks it by occurring twice or by holding a null. A unique index
    allows nulls, and null values never equal each other there. The count is
    named ``n``, or ``row_count`` where a key column is called ``n``.
    """
    names = name_list(columns)
    count = "row_count" if "n" in names else "n"
    any_null = reduce(lambda a, b: a | b, [ref(name).isNull() for name in names])
    rows = df.where(~any_null) if nulls_allowed else df
    counts = rows.groupBy(*[ref(name) for name in names]).agg(
        F.count(F.lit(1)).alias(count)
    )
    broken = F.col(count) > 1
    return counts.where(broken if nulls_allowed else broken | any_null)


# A filter of a load's keys has 2**FILTER_BITS bits at most, in rows of 64: 16 MB to broadcast.
LEAST_FILTER_BITS, FILTER_BITS = 16, 26


def load_violations(batch: DataFrame, target: DataFrame, columns: str | Sequence[str], nulls_allowed: bool = False) -> DataFrame:
    """Keys of a load that would break a target's key: key columns, ``in_batch`` and ``in_target``, the rows that have them.

    A key breaks it by occurring twice in the load, by being in the target already, or by holding a null (a unique index allows
    those). The target is not regrouped or shuffled: a filter of the load's keys, of a bounded size, goes to its scan, and only rows that
    pass it are counted and meet the load's keys. False hits cost time only.
    """
    names = name_list(columns)
    any_null = reduce(lambda a, b: a | b, [ref(name).isNull() for name in names])
    own = batch.select([ref(name) for name in names]).groupBy(*[ref(name) for name in names]).agg(F.count(F.lit(1)).alias("in_batch"))
    typed = target.select([ref(name).cast(batch.schema[name].dataType).alias(name) for name in names])
    keys = own.where(~any_null).select([ref(name) for name in names])
    # Rows that pass by chance are counted too; their keys meet none of the load's.
    hits = _passing(typed.where(~any_null), keys, names).groupBy(*[ref(name) for name in names]).agg(F.count(F.lit(1)).alias("in_target"))
    found = own.where(~any_null) if nulls_allowed else own
    joined = found.join(hits, names, "left").withColumn("in_target", F.coalesce("in_target", F.lit(0).cast("long")))
    broken = (F.col("in_batch") > 1) | (F.col("in_target") > 0)
    return joined.where(broken if nulls_allowed else broken | any_null)


def _passing(rows: DataFrame, keys: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows whose key may be among ``keys``: all that are, and few others."""
    n = keys.count()
    bits = min(FILTER_BITS, max(LEAST_FILTER_BITS, (16 * n).bit_length()))
    if 2 * n > 1 << FILTER_BITS:
        return rows  # a filter of this size would let through most rows

    def spot(frame: DataFrame) -> DataFrame:
        # Minus zero equals zero, but its hash does not.
        values = [ref(f.name) + F.lit(0.0).cast(f.dataType) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else ref(f.name) for f in frame.select([ref(n) for n in names]).schema.fields]
        place = F.xxhash64(*values).bitwiseAND(F.lit((1 << bits) - 1))
        return frame.withColumn("__word", F.shiftright(place, 6)).withColumn("__bit", place.bitwiseAND(F.lit(63)).cast("int"))

    one = F.expr("shiftleft(1L, __bit)")
    words = spot(keys).groupBy("__word").agg(F.bit_or(one).alias("__held"))
    passed = spot(rows).join(F.broadcast(words), "__word").where(F.col("__held").bitwiseAND(one) != 0)
    return passed.select([ref(name) for name in names])


# Columns whose distinct values one pass counts; each adds a row per input row before the map side combines.
COLUMNS_AT_ONCE = 16


def column_stats(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Nulls, distinct values, smallest and largest value of each column, in one scan for ``COLUMNS_AT_ONCE`` columns.

    Exact counts group by column and value first, so hot values collapse before the shuffle. ``approximate``
    takes a distinct-count sketch instead, which shuffles nothing but sketches. ``stats.ColumnSketches`` keeps such
    numbers from load to load.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    names = list(columns or fields)
    parts = [names[i : i + COLUMNS_AT_ONCE] for i in range(0, len(names), COLUMNS_AT_ONCE)]
    count = F.approx_count_distinct if approximate else F.count_distinct
    return reduce(lambda a, b: a.unionByName(b), [_measured(df, part, fields, count) for part in parts])


def _measured(df: DataFrame, names: list[str], fields: dict, count: Callable[[Column], Column]) -> DataFrame:
    measures = []
    for i, name in enumerate(names):
        column = ref(name)
        measures += [
            (F.count(F.lit(1)) - F.count(column)).alias(f"nulls{i}"),
            count(column).alias(f"distincts{i}"),
            F.min(column).alias(f"lo{i}"),
            F.max(column).alias(f"hi{i}"),
        ]
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"nulls{i}").alias("nulls"),
            F.col(f"distincts{i}").alias("distincts"),
            value_text(F.col(f"lo{i}"), fields[name]).alias("lo"),
            value_text(F.col(f"hi{i}"), fields[name]).alias("hi"),
        )
        for i, name in enumerate(names)
    ]
    return df.agg(*measures).select(F.inline(F.array(*entries)))
