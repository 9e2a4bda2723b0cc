"""What every source offers, whatever it reads from."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablebridge.functions.naming import ref
from tablebridge.operators.deltas import latest_changes
from tablebridge.operators.filters import filter_rows
from tablebridge.operators.paging import page, page_text
from tablebridge.operators.schemas import describe_columns
from tablebridge.plans.spec import run_spec


class Source:
    """Named tables as DataFrames, and the operators that start at a table."""

    # What a key is called, and how ties of the newest change are settled,
    # differs by database; see ``latest_changes``.
    ties = "one"

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def table(self, name: str) -> DataFrame:
        raise NotImplementedError

    def table_names(self) -> DataFrame:
        """One row per table: ``table_name``."""
        raise NotImplementedError

    def scan(self, name: str, split_column: str | None = None, splits: int = 0) -> DataFrame:
        """The whole table, in parallel where the source allows it."""
        return self.table(name)

    def page(
        self,
        name: str,
        order_by: str | Sequence[str],
        offset: int = 0,
        limit: int = 100,
        filters: Any = None,
        strict: bool = False,
    ) -> DataFrame:
        """A page of typed rows."""
        return page(self.table(name), order_by, offset, limit, filters, strict)

    def page_text(
        self,
        name: str,
        order_by: str | Sequence[str],
        offset: int = 0,
        limit: int = 100,
        filters: Any = None,
        strict: bool = False,
    ) -> DataFrame:
        """A page of rows whose values are all text."""
        return page_text(self.table(name), order_by, offset, limit, filters, strict)

    def count_rows(self, name: str, filters: Any = None, strict: bool = False) -> DataFrame:
        """One row: ``n``."""
        rows = filter_rows(self.table(name), filters, strict)
        return rows.agg(F.count(F.lit(1)).alias("n"))

    def min_max(self, name: str, column: str) -> DataFrame:
        """One row: ``min_val`` and ``max_val``, nulls left out."""
        return self.table(name).agg(
            F.min(ref(column)).alias("min_val"), F.max(ref(column)).alias("max_val")
        )

    def preview(self, query: str, rows: int = 100) -> DataFrame:
        """The first rows of a query in Spark SQL over this source's tables.

        Tables are named in the query as ``{name}`` and bound one by one, so
        nothing is registered in the session.
        """
        names = [row["table_name"] for row in self.table_names().collect()]
        used = {name: self.table(name) for name in names if "{" + name + "}" in query}
        return self.spark.sql(query.rstrip().rstrip(";"), **used).limit(rows)

    def columns(self, *names: str) -> DataFrame:
        """Columns of the tables with their API types; all tables by default."""
        if not names:
            names = tuple(row["table_name"] for row in self.table_names().collect())
        return describe_columns(self.spark, {name: self.table(name) for name in names})

    def changes(
        self, log_table: str, keys: str | Sequence[str], since: Any, **options: Any
    ) -> DataFrame:
        """The newest change of each key since a time; see ``latest_changes``."""
        options.setdefault("ties", self.ties)
        return latest_changes(self.table(log_table), keys, since, **options)

    def query(self, spec: Any, invert_where: bool = False) -> DataFrame:
        """The result of a query spec over this source's tables."""
        return run_spec(spec, self.table, invert_where)
