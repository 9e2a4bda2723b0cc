"""One comparison table for filter payloads and query specs."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.patterns import java_pattern, required_literals

Literal = Callable[[Any], Column]

# Operator names of the two payload forms, by canonical name.
FILTER_OPERATORS = {
    "CONTAINS": "contains",
    "NOT_CONTAINS": "not_contains",
    "NOT_CONTAIN": "not_contains",
    "STARTS_WITH": "starts_with",
    "ENDS_WITH": "ends_with",
    "MATCHES": "matches",
    "NOT_MATCHES": "not_matches",
    "=": "=",
    "EQUALS": "=",
    "!=": "!=",
    "NOT_EQUALS": "!=",
    ">": ">",
    "GREATER_THAN": ">",
    "<": "<",
    "LESS_THAN": "<",
    ">=": ">=",
    "GREATER_THAN_OR_EQUAL": ">=",
    "<=": "<=",
    "LESS_THAN_OR_EQUAL": "<=",
    "BETWEEN": "between",
    "NOT_BETWEEN": "not_between",
    "IN": "in",
    "NOT_IN": "not_in",
    "IS_NULL": "is_null",
    "IS_NOT_NULL": "is_not_null",
}
SPEC_OPERATORS = {
    "=": "=",
    "!=": "!=",
    "<>": "!=",
    ">": ">",
    "<": "<",
    ">=": ">=",
    "<=": "<=",
    "IS NULL": "is_null",
    "IS NOT NULL": "is_not_null",
    "CONTAINS": "contains",
    "NOT CONTAIN": "not_contains",
    "STARTS WITH": "starts_with",
    "ENDS WITH": "ends_with",
    "MATCHES": "matches",
    "NOT MATCHES": "not_matches",
    "BETWEEN": "between",
    "NOT BETWEEN": "not_between",
    "IN": "in",
    "NOT IN": "not_in",
    "LIST CONTAINS": "list_contains",
    "LIST NOT CONTAINS": "list_not_contains",
}

LIKE_FORMS = {
    "contains": "%{}%",
    "not_contains": "%{}%",
    "starts_with": "{}%",
    "ends_with": "%{}",
}
_ORDERED: dict[str, Callable[[Column, Column], Column]] = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    ">": lambda a, b: a > b,
    "<": lambda a, b: a < b,
    ">=": lambda a, b: a >= b,
    "<=": lambda a, b: a <= b,
}
ORDERED_OPERATORS = tuple(_ORDERED)


def ordered(left: Column, operator: str, right: Column) -> Column:
    """``left operator right`` for the six ordering operators."""
    symbol = "!=" if operator == "<>" else operator
    if symbol not in _ORDERED:
        raise ValueError(f"unsupported comparison: {operator!r}")
    return _ORDERED[symbol](left, right)


def like_pattern(kind: str, value: Any) -> str:
    """The LIKE pattern of a text operator.

    ``%`` and ``_`` inside the value stay wildcards. A backslash before any
    other character means that character itself, which Spark rejects, so the
    backslash goes.
    """
    pattern = LIKE_FORMS[kind].format(value)
    escape = re.compile(r"\\([^%_\\])|(\\[%_\\])", re.S)
    return escape.sub(lambda match: match.group(1) or match.group(2), pattern)


def compare(
    column: Column,
    dtype: T.DataType,
    operator: str,
    value: Any,
    second: Any,
    literal: Literal,
) -> Column:
    """A predicate for one canonical operator.

    ``literal`` turns one payload value into a typed literal; ``value`` is a
    list for the IN forms. Nulls follow SQL: a null column never matches, not
    even a negated operator.
    """
    if operator == "is_null":
        return column.isNull()
    if operator == "is_not_null":
        return column.isNotNull()
    if value is None:
        raise ValueError(f"operator {operator!r} needs a value")
    if operator in LIKE_FORMS:
        hit = _text(column, dtype).like(like_pattern(operator, value))
        return ~hit if operator == "not_contains" else hit
    if operator in ("matches", "not_matches"):
        hit = _text(column, dtype).rlike(java_pattern(str(value)))
        return _with_literals(hit, column, dtype, str(value)) if operator == "matches" else ~hit
    if operator in ("between", "not_between"):
        if second is None:
            raise ValueError(f"operator {operator!r} needs two bounds")
        hit = column.between(literal(value), literal(second))
        return hit if operator == "between" else ~hit
    if operator in ("in", "not_in"):
        if not value:
            raise ValueError(f"operator {operator!r} needs at least one value")
        hit = column.isin([literal(item) for item in value])
        return hit if operator == "in" else ~hit
    if operator in ("list_contains", "list_not_contains"):
        hit = F.array_contains(column, literal(value))
        return hit if operator == "list_contains" else ~hit
    return ordered(column, operator, literal(value))


def _with_literals(hit: Column, column: Column, dtype: T.DataType, pattern: str) -> Column:
    """A match, together with the texts it cannot do without, which a scan or a database can look for itself."""
    if not isinstance(dtype, T.StringType):
        return hit
    prefix, pieces = required_literals(pattern)
    # One character is in most texts.
    held = [column.contains(piece) for piece in dict.fromkeys(pieces) if len(piece) > 1]
    if prefix:
        held.insert(0, column.startswith(prefix))
    return reduce(lambda a, b: a & b, [*held, hit])


def chain(terms: list[tuple[str, Column]]) -> Column:
    """Fold ``(connector before the term, term)`` pairs; AND binds tighter."""
    groups: list[list[Column]] = []
    for connector, term in terms:
        if groups and connector == "AND":
            groups[-1].append(term)
        else:
            groups.append([term])
    return reduce(
        lambda a, b: a | b, [reduce(lambda a, b: a & b, group) for group in groups]
    )


def connector_of(entry: dict[str, Any]) -> str:
    """The connector an entry puts between itself and the next one."""
    word = str(entry.get("connector") or "AND").strip().upper()
    if word not in ("AND", "OR"):
        raise ValueError(f"unsupported connector: {entry.get('connector')!r}")
    return word


def _text(column: Column, dtype: T.DataType) -> Column:
    return column if isinstance(dtype, T.StringType) else column.cast("string")
