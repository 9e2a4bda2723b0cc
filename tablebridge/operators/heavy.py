"""Keys that hold much of a table, from frequent-items sketches.

A sketch tracks a fixed number of keys in each task and merges without loss of its bound: every key
with more rows than a small share is in it. It is made in one pass over the key columns that moves nothing but
sketches. ``hot_keys`` makes it once per table and key in a session; ``KeySketches`` keeps sketches in a
folder, one for each load of a table, so that a load adds its own and the table is never read for them again.

Keys are known by a hash of their values. What is found chooses how a join runs, never what it returns.
"""

from __future__ import annotations

from collections.abc import Sequence
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.naming import ref

HOT_SHARE = 0.005
# Keys a sketch tracks. It errs by less than the rows over this number, well below the share asked for.
TRACKED = 4096

_KEPT: WeakKeyDictionary[SparkSession, dict[tuple, list[int]]] = WeakKeyDictionary()


def key_hash(keys: Sequence[str]) -> Column:
    """A number for the values of a key; null if any of them is."""
    known = F.lit(True)
    for name in keys:
        known = known & ref(name).isNotNull()
    return F.when(known, F.xxhash64(*[ref(name) for name in keys]))


def hashes_alike(dtype: T.DataType) -> bool:
    """Whether equal values of a type have equal hashes; the zeros of floating numbers do not."""
    return isinstance(dtype, T.AtomicType) and not isinstance(dtype, (T.FloatType, T.DoubleType))


def key_sketch(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: the ``sketch`` of a key's values and the number of ``rows`` that have them."""
    hashed = df.select(key_hash(keys).alias("key")).where("key is not null")
    return hashed.agg(F.expr(f"approx_top_k_accumulate(key, {TRACKED})").alias("sketch"), F.count("key").alias("rows"))


def _over(merged: DataFrame, share: float) -> list[int]:
    """Hashes of the keys with more than ``share`` of the rows; at most ``1 / share`` of them."""
    most = int(1 / share) + 1
    found = merged.select(F.expr(f"approx_top_k_estimate(sketch, {most})").alias("top"), "rows").first()
    if found is None or not found["rows"]:
        return []
    return sorted(item["item"] for item in found["top"] if item["count"] > share * found["rows"])


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of key values that hold more than ``share`` of a table's rows; a session asks once per table and key."""
    kept = _KEPT.setdefault(df.sparkSession, {})
    name = (df.select([ref(key) for key in keys]).semanticHash(), share)
    if name not in kept:
        kept[name] = _over(key_sketch(df, keys), share)
    return kept[name]


class KeySketches:
    """Sketches of tables' keys in a folder, a row for each load."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, table: str, rows: DataFrame, keys: Sequence[str]) -> None:
        """Take the rows of a load into account."""
        named = key_sketch(rows, keys).select(F.lit(table).alias("table"), F.array(*map(F.lit, keys)).alias("keys"), "*")
        named.write.mode("append").parquet(self.path)

    def hot(self, table: str, keys: Sequence[str], share: float = HOT_SHARE) -> list[int]:
        """Hashes of the table's hot keys over all loads."""
        own = self.spark.read.parquet(self.path).where((F.col("table") == table) & (F.col("keys") == F.array(*map(F.lit, keys))))
        # Grouped, since a task without sketches has none to merge.
        return _over(own.groupBy("table").agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"), F.sum("rows").alias("rows")), share)
