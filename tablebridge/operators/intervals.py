"""Joins of values with intervals, by a tree of ranges over the ranks of all values.

All values of both sides are sorted once and numbered, so a value is a rank and a pair of bounds is
an interval of ranks. The ranks are the leaves of a tree with ``FANOUT`` children a node. A value is sent
to its node on each level, an interval to the few nodes that cover it exactly, and both meet on equal
nodes: every pair that meets is a match, and no pair meets twice. So the work follows the
rows and the output, not the product of the sides. Nodes stop growing at about ``NODE_ROWS`` values; wider
intervals take several of the largest nodes, which keeps any one node from gathering much of the output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.session import scratch_path

FANOUT = 8
NODE_ROWS = 4096
# A node's number carries its level in the last bits.
_LEVEL_BITS = 4
_ROW_BITS = (1 << 33) - 1


@dataclass
class Ranks:
    """Distinct values in order: columns ``value`` and ``rank``, from zero."""

    table: DataFrame
    distinct: int
    levels: int

    def levels_up(self) -> list[int]:
        return list(range(self.levels + 1))


def rank_values(values: DataFrame) -> Ranks:
    """Ranks of the distinct values of ``value``, nulls left out; ``n`` says how many rows of the sent side have each.

    One range partitioning; the outcome is written, so all that read it see the same ranks.
    """
    spark = values.sparkSession
    path = scratch_path(spark, "ranks")
    distinct = values.where("value is not null").groupBy("value").agg(F.sum("n").alias("n"))
    distinct.repartitionByRange("value").sortWithinPartitions("value").select(
        "value",
        "n",
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("place"),
    ).write.parquet(path)
    stored = spark.read.parquet(path)
    # One row per partition of the written table.
    parts = stored.groupBy("part").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("rows"))
    sizes = sorted(tuple(row) for row in parts.collect())
    starts, total, rows = [], 0, 0
    for part, size, held in sizes:
        starts.append((part, total))
        total, rows = total + size, rows + held
    at = spark.createDataFrame(starts, "part int, start long")
    table = stored.join(F.broadcast(at), "part").select("value", (F.col("start") + F.col("place")).alias("rank"))
    levels = 0
    while FANOUT ** (levels + 1) * rows <= NODE_ROWS * total and FANOUT**levels < total:
        levels += 1
    return Ranks(table, total, levels)


def value_nodes(rank: Column, ranks: Ranks) -> Column:
    """The node of a rank on each level."""
    return F.array(*[_node(F.floor(rank / F.lit(FANOUT**level)), level) for level in ranks.levels_up()])


def interval_nodes(first: str, last: str, ranks: Ranks) -> Column:
    """The fewest nodes that cover the ranks from column ``first`` to column ``last``, both included.

    On each level these are the nodes that a node of the next level would reach beyond an end with; on the last all others.
    """
    pieces: list[str] = []
    for level in ranks.levels_up():
        size, above = FANOUT**level, FANOUT ** (level + 1)
        low, high = _up(first, size), _down(last, size)
        if level == ranks.levels:
            ends = [(low, high)]
        else:
            up, down = _up(first, above), _down(last, above)
            ends = [(low, f"if({up} <= {down}, {up}, {high})"), (f"if({up} <= {down}, {down}, {high})", high)]
        pieces += [
            f"if({a} < {b}, transform(sequence({a} div {size}, {b} div {size} - 1), x -> x * {1 << _LEVEL_BITS} + {level}), array())"
            for a, b in ends
        ]
    return F.expr(f"concat({', '.join(pieces)})")


def _node(number: Column, level: int) -> Column:
    return number * F.lit(1 << _LEVEL_BITS) + F.lit(level)


def _up(first: str, size: int) -> str:
    return f"(({first} + {size - 1}) div {size} * {size})"


def _down(last: str, size: int) -> str:
    return f"(({last} + 1) div {size} * {size})"
