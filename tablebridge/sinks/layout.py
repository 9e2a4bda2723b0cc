"""Index definitions as write layout.

Files have no indexes. Sorting by the first index's columns lets a scan skip
files and row groups by their value ranges; bloom filters do it for equality on
the columns of the others; unique indexes become key checks.

With ``curve`` the rows follow a space-filling curve over the first columns of all indexes instead: each
value is placed among quantiles of its column, and the bits of the places are interleaved to one
key. Rows close in any of the columns stay close in the files, so each column's filter skips files.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.functions.hashing import row_hash
from tablebridge.functions.naming import ref
from tablebridge.operators.checks import key_violations


# Quantiles of a column of the curve, and rows they are taken from. More columns than this would part each too coarsely.
CURVE_BITS = 6
SAMPLE_ROWS = 20_000
MOST_CURVE_COLUMNS = 4


@dataclass
class Layout:
    sort_columns: list[str] = field(default_factory=list)
    curve_columns: list[str] = field(default_factory=list)
    bloom_columns: list[str] = field(default_factory=list)
    unique_keys: list[list[str]] = field(default_factory=list)


def plan_layout(definitions: Iterable[Mapping[str, Any]] | None, curve: bool = False) -> Layout:
    """Primary and empty definitions are skipped. ``curve`` gives the first columns of all indexes equal weight."""
    layout = Layout()
    for definition in definitions or []:
        names = [
            name.strip()
            for name in definition.get("columns") or []
            if isinstance(name, str) and name.strip()
        ]
        if definition.get("primary") or not names:
            continue
        if definition.get("unique"):
            layout.unique_keys.append(names)
        if curve and names[0] not in layout.curve_columns and len(layout.curve_columns) < MOST_CURVE_COLUMNS:
            layout.curve_columns.append(names[0])
        if not layout.sort_columns:
            layout.sort_columns = names
        else:
            layout.bloom_columns += [
                name
                for name in names
                if name not in layout.bloom_columns and name != layout.sort_columns[0]
            ]
    return layout


def per_column(columns: Sequence[str]) -> list[dict[str, Any]]:
    """One index definition for each column."""
    return [{"columns": [name], "unique": False, "primary": False} for name in columns]


def indexed_layout(columns: Iterable[Mapping[str, Any]]) -> Layout:
    """The layout that converted column metadata asks for: a curve over the columns flagged ``is_index``."""
    flagged = [c["name"] for c in columns if str(c.get("is_index") or "").strip().upper() == "YES"]
    return plan_layout(per_column(flagged), curve=True)


def unique_violations(df: DataFrame, layout: Layout) -> list[DataFrame]:
    """One frame of offending values for each unique index."""
    return [key_violations(df, key, nulls_allowed=True) for key in layout.unique_keys]


def quantile_bounds(df: DataFrame, names: Sequence[str], parts: int) -> dict[str, list]:
    """Values that part each column into runs of about as many rows, from one sample of all columns."""
    wanted = df.select([ref(name) for name in names])
    share = min(1.0, SAMPLE_ROWS / max(1, wanted.count()))
    rows = (wanted if share == 1.0 else wanted.sample(share, seed=11)).limit(2 * SAMPLE_ROWS).collect()
    bounds = {}
    for i, name in enumerate(names):
        values = sorted(row[i] for row in rows if row[i] is not None and row[i] == row[i])
        picked = [values[len(values) * k // parts] for k in range(1, parts)] if values else []
        bounds[name] = sorted(set(picked))
    return bounds


def _place(value: Column, bounds: list) -> Column:
    """How many bounds are at most ``value``, by a search tree; nulls before all."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(bounds[middle]), tree(low, middle)).otherwise(tree(middle + 1, high))

    return F.when(value.isNull(), F.lit(0)).otherwise(tree(0, len(bounds)))


def curve_key(df: DataFrame, names: Sequence[str], bits: int = CURVE_BITS) -> Column:
    """The place of a row on a Z-order curve over the columns' quantiles."""
    bounds = quantile_bounds(df, names, 1 << bits)
    key = F.lit(0).cast("long")
    for j, name in enumerate(names):
        place = _place(ref(name), bounds[name]).cast("long")
        for bit in range(bits):
            own = F.shiftright(place, bit).bitwiseAND(F.lit(1))
            key = key + F.shiftleft(own, bit * len(names) + len(names) - 1 - j)
    return key


def arranged(df: DataFrame, layout: Layout) -> DataFrame:
    """The rows in the layout's order: ranges of it in partitions, sorted inside each.

    A hash of the row cuts runs of equal values; the order among equal rows is free.
    """
    if len(layout.curve_columns) > 1:
        keyed = df.withColumn("__key", curve_key(df, layout.curve_columns))
        order = [F.col("__key")]
    elif layout.sort_columns:
        keyed, order = df, [ref(name) for name in layout.sort_columns]
    else:
        return df
    ranged = keyed.withColumn("__hash", row_hash(df)).repartitionByRange(*order, F.col("__hash"))
    return ranged.sortWithinPartitions(*order).drop("__key", "__hash")


def write_layout(df: DataFrame, path: str, layout: Layout, rows_per_file: int = 0) -> None:
    """Write parquet in the layout, in files of ``rows_per_file`` rows at most if given.

    Ranges may cut a run of equal values; rows are sorted inside each file.
    """
    writer = arranged(df, layout).write.mode("overwrite").options(**layout_options(layout))
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def layout_options(layout: Layout) -> dict[str, str]:
    return {f"parquet.bloom.filter.enabled#{name}": "true" for name in layout.bloom_columns}
