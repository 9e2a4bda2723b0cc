"""Joins on AND/OR chains of column comparisons.

Frames carry distinct column names, so a condition is a triple ``(base column,
operator, target column)`` and a chain is a list of AND groups, ORed.

* One group with an equality is a plain Spark join: Catalyst picks the strategy
  and AQE splits skewed partitions. AQE cannot split the optional side of an
  outer join, so keys that a sketch finds hot there are joined apart: as an
  inner join plus the rows without a match. All other keys are joined once.
* Several groups would be one nested-loop join. They become one equi-join per
  group, each leaving out the pairs of the groups before it, so every pair comes
  out once.
* A group without equality joins values of one side with intervals of the other on
  the nodes of a tree (``intervals``), so that only rows meet that match in the compared
  column. A nested loop is used only against a side that a size probe found small.

Columns of different types are compared in one type, which the conditions name
in every plan, so the choice of a plan never changes what matches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.naming import ref
from tablebridge.operators.comparisons import ordered
from tablebridge.operators.heavy import hashes_alike, hot_keys, key_hash
from tablebridge.operators.intervals import Ranks, interval_nodes, rank_values, value_nodes
from tablebridge.operators.sizing import fits_broadcast, planned_broadcast

Condition = tuple[str, str, str]
Group = Sequence[Condition]

_MIRROR = {"=": "=", "!=": "!=", "<>": "<>", "<": ">", ">": "<", "<=": ">=", ">=": "<="}
_RANGES = ("<", "<=", ">", ">=")


def join_frames(
    base: DataFrame,
    target: DataFrame,
    how: str,
    groups: Sequence[Group],
    base_is_table: bool = True,
) -> DataFrame:
    """``base`` joined to ``target``; ``how`` is inner, left or right.

    ``target`` is a table. ``base`` may be the outcome of other joins; it is then
    never probed, which would run them.
    """
    if how not in ("inner", "left", "right"):
        raise ValueError(f"unsupported join: {how!r}")
    if len(groups) == 1 and _has_equality(groups[0]):
        return _equal_join(base, target, how, groups[0], base_is_table)

    compare = _Compare(base, target)
    ranks = _Ranks(compare)
    if how == "right":
        mirrored = [[(t, _MIRROR[op], b) for b, op, t in group] for group in groups]
        loops = base_is_table and _loops(base, groups)
        joined = _outer(target, base, mirrored, ranks, compare, loops)
    elif how == "left":
        joined = _outer(base, target, groups, ranks, compare, _loops(target, groups))
    elif _loops(target, groups):
        joined = base.join(F.broadcast(target), compare.any(groups), "inner")
    else:
        joined = _pairs(base, target, groups, ranks, compare)
    return joined.select([ref(name) for name in base.columns + target.columns])


def _equal_join(
    base: DataFrame, target: DataFrame, how: str, group: Group, base_is_table: bool
) -> DataFrame:
    """A join with an equality. Only a table that Spark would not broadcast is asked for hot keys."""
    compare = _Compare(base, target)
    plain = base.join(target, compare.all(group), how)
    if how == "inner":
        return plain
    own = [(b, t) for b, operator, t in group if operator == "="]
    optional, at = (target, 1) if how == "left" else (base, 0)
    if (how == "right" and not base_is_table) or planned_broadcast(optional):
        return plain
    if any(compare.types[b] != compare.types[t] or not hashes_alike(compare.types[b]) for b, t in own):
        return plain
    hot = hot_keys(optional, [pair[at] for pair in own])
    if not hot:
        return plain

    def is_hot(side: int) -> Column:
        return F.coalesce(key_hash([pair[side] for pair in own]).isin(hot), F.lit(False))

    kept, other = (base, target) if how == "left" else (target, base)
    mine, theirs = (0, 1) if how == "left" else (1, 0)
    chain = group if how == "left" else [(t, _MIRROR[op], b) for b, op, t in group]
    usual = kept.where(~is_hot(mine)).join(other.where(~is_hot(theirs)), compare.all(chain), "left")
    apart = _outer(kept.where(is_hot(mine)), other.where(is_hot(theirs)), [chain], _Ranks(compare), compare, False)
    names = [ref(name) for name in base.columns + target.columns]
    return usual.select(names).unionByName(apart.select(names))


def _loops(side: DataFrame, groups: Sequence[Group]) -> bool:
    """Whether a nested loop over ``side`` is due: some group has no equality,
    and the side is small."""
    return not all(_has_equality(group) for group in groups) and fits_broadcast(side)


def _outer(
    kept: DataFrame,
    other: DataFrame,
    groups: Sequence[Group],
    ranks: _Ranks,
    compare: _Compare,
    loops: bool,
) -> DataFrame:
    """All matching pairs, plus the rows of ``kept`` without one."""
    if loops:
        return kept.join(F.broadcast(other), compare.any(groups), "left")
    pairs = _pairs(kept, other, groups, ranks, compare)
    lonely = reduce(
        lambda rows, group: _without_match(rows, other, group, ranks, compare), groups, kept
    )
    padded = lonely.select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema.fields]
    )
    return pairs.select([ref(name) for name in kept.columns + other.columns]).unionByName(padded)


def _pairs(
    left: DataFrame,
    right: DataFrame,
    groups: Sequence[Group],
    ranks: _Ranks,
    compare: _Compare,
) -> DataFrame:
    """Every pair that some group accepts, from the first group that does."""
    branches = []
    for index, group in enumerate(groups):
        pairs = _group_pairs(left, right, group, ranks, compare)
        if index:
            earlier = F.coalesce(compare.any(groups[:index]), F.lit(False))
            pairs = pairs.where(~earlier)
        branches.append(pairs)
    return reduce(lambda a, b: a.unionByName(b), branches)


def _group_pairs(
    left: DataFrame, right: DataFrame, group: Group, ranks: _Ranks, compare: _Compare
) -> DataFrame:
    if _has_equality(group):
        return left.join(right, compare.all(group), "inner")
    if not any(operator in _RANGES for _, operator, _ in group):
        # Two disjoint ranges instead of everything but one value.
        (name, _, other), *rest = group
        below = _group_pairs(left, right, [(name, "<", other), *rest], ranks, compare)
        above = _group_pairs(left, right, [(name, ">", other), *rest], ranks, compare)
        return below.unionByName(above)
    return _interval_pairs(left, right, group, ranks, compare)


class _Compare:
    """Conditions between columns of two frames, each in the one type both sides are cast to."""

    def __init__(self, base: DataFrame, target: DataFrame):
        self._base, self._target = base, target
        self.types = {f.name: f.dataType for f in base.schema.fields + target.schema.fields}
        self._common: dict[frozenset[str], T.DataType] = {}

    def type_of(self, *names: str) -> T.DataType:
        """The type that columns are compared in: text gives way to numbers, times and truth values."""
        key = frozenset(names)
        if key not in self._common:
            kinds = [self.types[name] for name in names]
            values = [F.lit(None).cast(kind) for kind in kinds if not isinstance(kind, T.StringType)]
            if len(values) < len(kinds) and values:
                only = self._base.sparkSession.range(0).select(F.coalesce(*values)).schema[0].dataType
                if isinstance(only, T.IntegralType):
                    only = T.LongType()
                elif isinstance(only, T.NumericType):
                    only = T.DoubleType()
            else:
                only = self._base.sparkSession.range(0).select(F.coalesce(*values)).schema[0].dataType if values else T.StringType()
            self._common[key] = only
        return self._common[key]

    def value(self, name: str, kind: T.DataType) -> Column:
        return ref(name) if self.types[name] == kind else ref(name).cast(kind)

    def one(self, condition: Condition) -> Column:
        name, operator, other = condition
        kind = self.type_of(name, other)
        return ordered(self.value(name, kind), operator, self.value(other, kind))

    def all(self, group: Group) -> Column:
        return reduce(lambda a, b: a & b, [self.one(condition) for condition in group])

    def any(self, groups: Sequence[Group]) -> Column:
        return reduce(lambda a, b: a | b, [self.all(group) for group in groups])


@dataclass
class _Band:
    """One column's values, and the columns of the other side that bound them, each with its operator."""

    point: str
    point_is_right: bool
    low: str | None
    high: str | None
    strict_low: bool = False
    strict_high: bool = False

    def decides(self, condition: Condition) -> bool:
        """Whether the interval of ranks stands for the condition."""
        name, operator, other = condition
        point, bound = (other, name) if self.point_is_right else (name, other)
        if point != self.point or operator not in _RANGES:
            return False
        below = (operator in ("<", "<=")) == self.point_is_right  # the bound is below the value
        own, strict = (self.low, self.strict_low) if below else (self.high, self.strict_high)
        return bound == own and strict == (operator in ("<", ">"))


def _band(group: Group, compare: _Compare) -> _Band:
    """The column of either side that is bounded on both ends if there is one, else on one end."""
    found: list[_Band] = []
    for right in (True, False):
        lows: dict[str, tuple[str, bool]] = {}
        highs: dict[str, tuple[str, bool]] = {}
        for name, operator, other in group:
            if operator in _RANGES:
                point, bound = (other, name) if right else (name, other)
                below = operator in ("<", "<=")  # the base value is below the target's
                (lows if below == right else highs).setdefault(point, (bound, operator in ("<", ">")))
        for point in {**lows, **highs}:
            low, strict_low = lows.get(point, (None, False))
            high, strict_high = highs.get(point, (None, False))
            if low and high and compare.type_of(point, low) != compare.type_of(point, high):
                high, strict_high = None, False
            found.append(_Band(point, right, low, high, strict_low, strict_high))
    return max(found, key=lambda band: (band.low is not None) + (band.high is not None))


class _Ranks:
    """Ranks of the values that bands compare, made once for each set of columns."""

    def __init__(self, compare: _Compare):
        self._compare = compare
        self._made: dict[tuple, Ranks] = {}

    def of(self, kind: T.DataType, points: DataFrame, seekers: DataFrame, band: _Band) -> Ranks:
        bounds = [name for name in (band.low, band.high) if name]
        key = (kind.simpleString(), band.point, frozenset(bounds))
        if key not in self._made:
            sent = points.select(self._compare.value(band.point, kind).alias("value"), F.lit(1).alias("n"))
            for name in bounds:
                sent = sent.union(seekers.select(self._compare.value(name, kind), F.lit(0)))
            self._made[key] = rank_values(sent)
        return self._made[key]


def _interval_pairs(
    left: DataFrame, right: DataFrame, group: Group, ranks: _Ranks, compare: _Compare
) -> DataFrame:
    """A join of one side's values with the intervals of the other; what the interval does not decide is
    compared for the pairs that meet, in values that each side has cast beforehand."""
    band = _band(group, compare)
    kind = compare.type_of(*[name for name in (band.point, band.low, band.high) if name][:2])
    rest = [condition for condition in group if not band.decides(condition)]
    columns = [ref(name) for name in left.columns + right.columns]
    checks = []
    for i, (name, operator, other) in enumerate(rest):
        common = compare.type_of(name, other)
        left = left.withColumn(f"__l{i}", compare.value(name, common))
        right = right.withColumn(f"__r{i}", compare.value(other, common))
        checks.append(ordered(F.col(f"__l{i}"), operator, F.col(f"__r{i}")))
    points, seekers = (right, left) if band.point_is_right else (left, right)
    found = ranks.of(kind, points, seekers, band)
    held = _ranked(points, compare.value(band.point, kind), found, "__rank")
    held = held.select("*", F.explode(value_nodes(F.col("__rank"), found)).alias("__node"))
    visiting = seekers.withColumns({"__first": F.lit(0).cast("long"), "__last": F.lit(found.distinct - 1).cast("long")})
    if band.low:
        visiting = _ranked(visiting.drop("__first"), compare.value(band.low, kind), found, "__first", int(band.strict_low))
    if band.high:
        visiting = _ranked(visiting.drop("__last"), compare.value(band.high, kind), found, "__last", -int(band.strict_high))
    visiting = visiting.where("__first <= __last").select("*", F.explode(interval_nodes("__first", "__last", found)).alias("__visit"))
    joined = visiting.join(held, F.col("__visit") == F.col("__node"), "inner")
    if checks:
        joined = joined.where(reduce(lambda a, b: a & b, checks))
    return joined.select(columns)


def _ranked(rows: DataFrame, value: Column, ranks: Ranks, name: str, shift: int = 0) -> DataFrame:
    """The rows whose ``value`` is known, with its rank, moved by ``shift``."""
    table = ranks.table.select(F.col("value").alias("__value"), (F.col("rank") + shift).alias(name))
    return rows.withColumn("__own", value).join(table, F.col("__own") == F.col("__value"), "inner").drop("__own", "__value")


def _without_match(
    rows: DataFrame, other: DataFrame, group: Group, ranks: _Ranks, compare: _Compare
) -> DataFrame:
    """Rows of ``rows`` that the group matches with no row of ``other``."""
    if len(group) == 1 and not _has_equality(group):
        # Some value lies beyond another if the greatest or the least does: one row decides.
        name, operator, target = group[0]
        value = compare.value(target, compare.type_of(name, target))
        ends = other.agg(F.min(value).alias("__least"), F.max(value).alias("__most"))
        own = compare.value(name, compare.type_of(name, target))
        least, most = F.col("__least"), F.col("__most")
        hit = ordered(own, operator, most if operator in ("<", "<=") else least)
        if operator in ("!=", "<>"):
            hit = (own != least) | (own != most)
        return rows.join(F.broadcast(ends), hit, "left_anti")  # one row
    wanted = other.select([ref(name) for name in sorted({o for _, _, o in group})]).distinct()
    if _has_equality(group):
        return rows.join(wanted, compare.all(group), "left_anti")
    # Only the compared columns decide whether a row has a match.
    compared = sorted({name for name, _, _ in group})
    asked = rows.select([ref(name) for name in compared]).distinct()
    matched = _group_pairs(asked, wanted, group, ranks, compare).select(
        [ref(name).alias(f"__m{i}") for i, name in enumerate(compared)]
    ).distinct()
    same = reduce(
        lambda a, b: a & b,
        [ref(name).eqNullSafe(F.col(f"__m{i}")) for i, name in enumerate(compared)],
    )
    return rows.join(matched, same, "left_anti")


def _has_equality(group: Group) -> bool:
    return any(operator == "=" for _, operator, _ in group)
