"""Change data capture: the newest change of every key since a time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablebridge.functions.hashing import row_hash
from tablebridge.functions.literals import typed_literal
from tablebridge.functions.naming import name_list, ref
from tablebridge.operators.paging import number_rows, page

# Fixed value: the column that dates a change in a log table.
CHANGE_TIME = "Date_operation"


def changes_since(
    log: DataFrame, since: str | dt.date | dt.datetime | None, ts: str = CHANGE_TIME
) -> DataFrame:
    """Log rows strictly after ``since``; all dated rows when it is None."""
    column, dtype = ref(ts), log.select(ref(ts)).schema[0].dataType
    return log.where(column.isNotNull() if since is None else column > typed_literal(since, dtype))


def latest_changes(
    log: DataFrame,
    keys: str | Sequence[str],
    since: str | dt.date | dt.datetime | None,
    ts: str = CHANGE_TIME,
    ties: str = "one",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The newest change of each key, strictly after ``since``.

    ``ties="one"`` keeps one row per key and counts a null key as a key. Rows of
    equal time are decided by ``tie_break`` columns, highest first, then by a
    hash of the row, so the answer does not depend on the run. Spark keeps one
    row per key in every map task before it shuffles, so a hot key sends no more
    rows than there are tasks.

    ``ties="all"`` keeps every row of the newest time and drops null keys. The
    newest times come from a pre-aggregated group and meet the log in a join on
    key and time; rows of a hot key are spread by time and AQE splits the rest.
    """
    names = name_list(keys)
    changes = changes_since(log, since, ts)
    if ties == "one":
        order = [ref(ts).desc(), *[ref(name).desc() for name in tie_break], row_hash(log).desc()]
        newest = Window.partitionBy(*[ref(name) for name in names]).orderBy(*order)
        return (
            changes.withColumn("__rank", F.row_number().over(newest))
            .where(F.col("__rank") == 1)
            .drop("__rank")
        )
    if ties == "all":
        known = reduce(lambda a, b: a & b, [ref(name).isNotNull() for name in names])
        changes = changes.where(known)
        newest = changes.groupBy(*[ref(name) for name in names]).agg(F.max(ref(ts)).alias("__ts"))
        newest = newest.select(
            *[ref(name).alias(f"__k{i}") for i, name in enumerate(names)], "__ts"
        )
        same = reduce(
            lambda a, b: a & b,
            [ref(name) == F.col(f"__k{i}") for i, name in enumerate(names)],
            ref(ts) == F.col("__ts"),
        )
        return changes.join(newest, same, "left_semi")
    raise ValueError(f"ties must be 'one' or 'all', got {ties!r}")


def delta_snapshot(
    log: DataFrame,
    keys: str | Sequence[str],
    since: str | dt.date | dt.datetime | None,
    path: str | None = None,
    **options,
) -> str:
    """Store the newest changes in key order; ``read_page`` serves the pages.

    All pages come from one state of the log, and the changes are worked out
    once instead of once per page.
    """
    return number_rows(latest_changes(log, keys, since, **options), keys, path)


def delta_page(
    log: DataFrame,
    keys: str | Sequence[str],
    since: str | dt.date | dt.datetime | None,
    offset: int = 0,
    limit: int = 10_000,
    **options,
) -> DataFrame:
    """One key-ordered page of the newest changes."""
    return page(latest_changes(log, keys, since, **options), keys, offset, limit)
