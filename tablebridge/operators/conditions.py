"""WHERE and HAVING conditions of a query spec."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.literals import (
    as_boolean,
    as_list,
    as_number,
    number_literal,
    typed_literal,
)
from tablebridge.operators.comparisons import (
    ORDERED_OPERATORS,
    SPEC_OPERATORS,
    chain,
    compare,
    connector_of,
    ordered,
)

Resolve = Callable[[str | None, str], tuple[Column, T.DataType]]

# Value types whose value is a list.
LIST_TYPES = ("list", "set", "multiset")


def where_predicate(
    conditions: list[dict[str, Any]] | None, resolve: Resolve, invert: bool = False
) -> Column | None:
    """The conditions as one predicate; None when there are none.

    Each connector is read from the condition before it. ``invert`` negates the
    whole chain, so rows for which it is unknown stay out either way.
    """
    if not conditions:
        return None
    terms = []
    for index, condition in enumerate(conditions):
        connector = connector_of(conditions[index - 1]) if index else "AND"
        terms.append((connector, where_term(condition, resolve)))
    predicate = chain(terms)
    return ~predicate if invert else predicate


def where_term(condition: dict[str, Any], resolve: Resolve) -> Column:
    if condition.get("comparisonType") == "COLUMN":
        return column_term(condition, resolve)
    column, dtype = resolve(condition.get("table"), condition.get("field"))
    return value_term(
        column,
        dtype,
        condition.get("operator", "="),
        condition.get("value"),
        condition.get("secondValue"),
        condition.get("valueType", "string"),
    )


def value_term(
    column: Column,
    dtype: T.DataType,
    operator: str,
    value: Any,
    second: Any,
    value_type: str | None,
) -> Column:
    """A column or aggregate against literals, typed by ``valueType``."""
    kind = SPEC_OPERATORS.get(operator)
    if kind is None:
        raise ValueError(f"unsupported operator: {operator!r}")
    target = dtype
    if kind in ("list_contains", "list_not_contains"):
        if not isinstance(dtype, T.ArrayType):
            raise ValueError(f"{operator} needs an array column, got {dtype.simpleString()}")
        target = dtype.elementType
    if kind in ("in", "not_in") and value is not None:
        splits = value_type == "number" or value_type in LIST_TYPES
        value = as_list(value) if splits or not isinstance(value, str) else [value]

    def literal(item: Any) -> Column:
        if value_type == "number":
            return number_literal(as_number(item), target)
        if value_type == "boolean":
            return F.lit(as_boolean(item))
        return typed_literal(item, target)

    return compare(column, dtype, kind, value, second, literal)


def column_term(condition: dict[str, Any], resolve: Resolve) -> Column:
    """Column against column, column arithmetic, or a difference of dates."""
    left, left_type = resolve(condition.get("table"), condition.get("field"))
    right, right_type = resolve(condition.get("targetTable"), condition.get("targetField"))
    operator, value = condition.get("operator"), condition.get("value")

    if condition.get("valueType", "string") == "Date":
        if not operator:
            raise ValueError("a date difference needs an operator and a value")
        difference = date_difference(left, right, condition.get("dateUnit"))
        return ordered(difference, operator, number_literal(as_number(value)))

    symbol = condition.get("compareOperator", "=")
    if not operator:
        return ordered(left, symbol, right)
    result = arithmetic(left, left_type, symbol, right, right_type)
    return ordered(result, operator, number_literal(as_number(value)))


def date_difference(left: Column, right: Column, unit: str | None) -> Column:
    """Calendar years, calendar months, or days between two dates."""
    if unit == "YEAR":
        return F.year(left) - F.year(right)
    if unit == "MONTH":
        return (F.year(left) - F.year(right)) * 12 + (F.month(left) - F.month(right))
    return F.datediff(left, right)


def arithmetic(
    left: Column, left_type: T.DataType, symbol: str, right: Column, right_type: T.DataType
) -> Column:
    """``left symbol right``; integer division truncates as in the database."""
    if symbol == "+":
        return left + right
    if symbol == "-":
        return left - right
    if symbol == "*":
        return left * right
    if symbol == "%":
        return left % right
    if symbol == "/":
        whole = isinstance(left_type, T.IntegralType) and isinstance(right_type, T.IntegralType)
        return F.call_function("div", left, right) if whole else left / right
    if symbol in ORDERED_OPERATORS:
        raise ValueError(f"comparing the outcome of {symbol!r} with a value is not supported")
    raise ValueError(f"unsupported compare operator: {symbol!r}")


def having_predicate(
    entries: list[dict[str, Any]] | None,
    measure: Callable[[dict[str, Any]], tuple[Column, T.DataType]],
) -> Column | None:
    """HAVING entries as one predicate; entries without operator are ignored.

    The connector belongs to the entry right before, ignored or not.
    """
    terms = []
    for index, entry in enumerate(entries or []):
        operator = entry.get("operator")
        if not operator:
            continue
        connector = connector_of(entries[index - 1]) if index else "AND"
        column, dtype = measure(entry)
        term = value_term(
            column,
            dtype,
            operator,
            entry.get("value"),
            entry.get("secondValue"),
            entry.get("valueType"),
        )
        terms.append((connector, term))
    return chain(terms) if terms else None
