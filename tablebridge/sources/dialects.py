"""Statements in each database's own SQL: filters, pages, counts, split points.

A filter payload is checked first (``operators.filters``) and then written as a WHERE clause with escaped
literals, so that pages and counts with filters run inside the database. What a dialect cannot say,
such as a regular expression, it refuses with ``NotInDialect``; the caller then filters in Spark.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import types as T

from tablebridge.functions.literals import as_boolean
from tablebridge.functions.naming import checked_name
from tablebridge.operators.comparisons import LIKE_FORMS
from tablebridge.operators.filters import Condition


class NotInDialect(ValueError):
    """Something that a database's SQL has no form for."""


@dataclass(frozen=True)
class Dialect:
    """How one database writes names, literals and pages."""

    name: str
    quote: str
    booleans: tuple[str, str]  # false, true
    regex: tuple[str, str] | None  # operators for a match and for none
    nulls_first: str  # what puts nulls first in an ascending order, if they are not anyway
    page: str
    # The first column of the primary key and the estimated rows of a table.
    key_column: str
    estimated_rows: str

    def column(self, name: str) -> str:
        return self.quote.format(checked_name(name))

    def literal(self, value: Any, dtype: T.DataType | None = None) -> str:
        """A value as the type of the column it is compared with.

        Quoted values take the column's type in every database; numbers stay bare unless the column is text.
        """
        if isinstance(value, bool) or isinstance(dtype, T.BooleanType):
            if isinstance(dtype, T.StringType):
                return self.text(str(value).lower())
            return self.booleans[as_boolean(value)]
        if isinstance(value, (int, float, Decimal)):
            if isinstance(value, (float, Decimal)) and not math.isfinite(value):
                raise NotInDialect(f"no literal for {value!r}")
            return self.text(str(value)) if isinstance(dtype, T.StringType) else str(value)
        if isinstance(value, dt.datetime):
            return self.timestamp(value)
        if isinstance(value, dt.date):
            return self.date(value)
        return self.text(str(value))

    def text(self, value: str) -> str:
        if "\x00" in value:
            raise NotInDialect("a text with a zero byte")
        return "'" + value.replace("'", "''") + "'"

    def timestamp(self, value: dt.datetime) -> str:
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        if self.name == "informix":
            return f"DATETIME ({value:%Y-%m-%d %H:%M:%S}.{value.microsecond // 10:05d}) YEAR TO FRACTION(5)"
        return self.text(value.isoformat(sep="T" if self.name == "sqlserver" else " "))

    def date(self, value: dt.date) -> str:
        if self.name == "informix":
            return f"MDY({value.month}, {value.day}, {value.year})"
        return self.text(value.isoformat())

    def like(self, kind: str, value: str) -> str:
        """A LIKE pattern: ``%`` and ``_`` in the value stay wildcards, a backslash takes the next character as it is."""
        pattern = LIKE_FORMS[kind].format(value)
        if self.name == "sqlserver":  # brackets are wildcards there, and nothing escapes unless named
            return self.text(pattern.replace("[", "\\[")) + " ESCAPE '\\'"
        return self.text(pattern)

    def condition(self, condition: Condition, dtype: T.DataType) -> str:
        name, operator, value, second = condition
        column = self.column(name)
        negated = "NOT " if operator.startswith("not_") else ""
        kind = operator.removeprefix("not_")
        if operator in ("is_null", "is_not_null"):
            return f"{column} IS {'NOT ' if operator == 'is_not_null' else ''}NULL"
        if kind in LIKE_FORMS or operator in LIKE_FORMS:
            if not isinstance(dtype, T.StringType):
                raise NotInDialect(f"LIKE on {name}, which is no text column")
            return f"{column} {negated}LIKE {self.like(kind, str(value))}"
        if kind == "matches":
            if self.regex is None or not isinstance(dtype, T.StringType):
                raise NotInDialect(f"a regular expression on {name}")
            return f"{column} {self.regex[bool(negated)]} {self.text(str(value))}"
        if kind == "between":
            return f"{column} {negated}BETWEEN {self.literal(value, dtype)} AND {self.literal(second, dtype)}"
        if kind == "in":
            return f"{column} {negated}IN ({', '.join(self.literal(item, dtype) for item in value)})"
        if operator in ("=", "!=", "<", "<=", ">", ">="):
            return f"{column} {'<>' if operator == '!=' else operator} {self.literal(value, dtype)}"
        raise NotInDialect(f"the operator {operator!r}")

    def where(self, conditions: Sequence[Condition], types: Mapping[str, T.DataType]) -> str:
        """`` WHERE ...``, or nothing without conditions."""
        known = {name.lower(): name for name in types}
        terms = []
        for name, *rest in conditions:
            own = name if name in types else known.get(name.lower())
            if own is None:
                raise ValueError(f"unknown column: {name!r}")
            terms.append(self.condition((own, *rest), types[own]))
        return f" WHERE {' AND '.join(terms)}" if terms else ""

    def order(self, names: Sequence[str]) -> str:
        return ", ".join(self.column(name) + self.nulls_first for name in names)

    def page_statement(self, table: str, order: Sequence[str], offset: int, limit: int, where: str = "") -> str:
        if offset < 0 or limit < 0:
            raise ValueError("offset and limit must not be negative")
        return self.page.format(table=checked_name(table) + where, order=self.order(order), offset=int(offset), limit=int(limit))

    def count_statement(self, table: str, where: str = "") -> str:
        return f"SELECT COUNT(*) AS n FROM {checked_name(table)}{where}"

    def quantile_statement(self, table: str, column: str, tiles: int) -> str:
        """Least and greatest value of runs of equally many rows, in order; nulls left out."""
        own = self.column(column)
        tiled = f"SELECT {own} AS v, NTILE({int(tiles)}) OVER (ORDER BY {own}) AS tile FROM {checked_name(table)} WHERE {own} IS NOT NULL"
        return f"SELECT tile, MIN(v) AS low, MAX(v) AS high FROM ({tiled}) tiled GROUP BY tile"

    def swap_statements(self, table: str, staged: str, columns: Sequence[str]) -> list[str]:
        """Replace all rows of a table by those of another, inside one transaction.

        Deleting keeps the table's structure, keys and rights, and can be undone in every database.
        """
        names = ", ".join(self.column(name) for name in columns)
        return [
            f"DELETE FROM {checked_name(table)}",
            f"INSERT INTO {checked_name(table)} ({names}) SELECT {names} FROM {checked_name(staged)}",
        ]

    def split_predicates(self, column: str, tiles: Sequence[tuple[Any, Any]]) -> list[str]:
        """Conditions that part all rows of a table, from the least and greatest values of its tiles in order.

        A value that fills a tile gets a condition of its own. Nulls join the first range, and the outer ranges are open, so that no row is lost
        that came after the tiles were counted.
        """
        own = self.column(column)
        hot = sorted({low for low, high in tiles if low == high})
        cuts = sorted({low for low, _ in tiles} | set(hot))
        if not cuts:
            return []
        first = f"{own} < {self.literal(cuts[0])} OR {own} IS NULL"
        out = [first]
        for low, high in zip(cuts, [*cuts[1:], None], strict=True):
            end = f" AND {own} < {self.literal(high)}" if high is not None else ""
            if low in hot:
                out.append(f"{own} = {self.literal(low)}")
            out.append(f"{own} {'>' if low in hot else '>='} {self.literal(low)}{end}")
        return out


# Each database's operators, forms of a page, and catalog queries.
DIALECTS = {
    "postgres": Dialect(
        name="postgres",
        quote='"{}"',
        booleans=("FALSE", "TRUE"),
        regex=("~", "!~"),
        nulls_first=" NULLS FIRST",
        page="SELECT * FROM {table} ORDER BY {order} LIMIT {limit} OFFSET {offset}",
        key_column=(
            "SELECT k.column_name FROM information_schema.table_constraints c"
            " JOIN information_schema.key_column_usage k ON k.constraint_name = c.constraint_name"
            " AND k.table_schema = c.table_schema AND k.table_name = c.table_name"
            " WHERE c.constraint_type = 'PRIMARY KEY' AND c.table_schema = '{schema}'"
            " AND c.table_name = '{table}' AND k.ordinal_position = 1"
        ),
        estimated_rows=(
            "SELECT CAST(c.reltuples AS BIGINT) AS n FROM pg_class c JOIN pg_namespace s ON s.oid = c.relnamespace"
            " WHERE s.nspname = '{schema}' AND c.relname = '{table}'"
        ),
    ),
    "sqlserver": Dialect(
        name="sqlserver",
        quote="[{}]",
        booleans=("0", "1"),
        regex=None,
        nulls_first="",
        page="SELECT * FROM {table} ORDER BY {order} OFFSET {offset} ROWS FETCH NEXT {limit} ROWS ONLY",
        key_column=(
            "SELECT c.name FROM sys.indexes i JOIN sys.index_columns k ON k.object_id = i.object_id"
            " AND k.index_id = i.index_id JOIN sys.columns c ON c.object_id = k.object_id"
            " AND c.column_id = k.column_id WHERE i.is_primary_key = 1 AND k.key_ordinal = 1"
            " AND i.object_id = OBJECT_ID('{name}')"
        ),
        estimated_rows=(
            "SELECT SUM(row_count) AS n FROM sys.dm_db_partition_stats"
            " WHERE object_id = OBJECT_ID('{name}') AND index_id < 2"
        ),
    ),
    "informix": Dialect(
        name="informix",
        quote="{}",
        booleans=("'f'", "'t'"),
        regex=None,
        nulls_first="",
        page="SELECT SKIP {offset} FIRST {limit} * FROM {table} ORDER BY {order}",
        key_column=(
            "SELECT c.colname FROM systables t JOIN sysconstraints p ON p.tabid = t.tabid AND p.constrtype = 'P'"
            " JOIN sysindexes i ON i.idxname = p.idxname JOIN syscolumns c ON c.tabid = t.tabid"
            " AND c.colno = ABS(i.part1) WHERE t.tabname = '{table}'"
        ),
        estimated_rows="SELECT nrows AS n FROM systables WHERE tabname = '{table}'",
    ),
}
