"""Filter payloads: a JSON list of conditions, always ANDed."""

from __future__ import annotations

import json
import logging
import re
from functools import partial, reduce
from typing import Any

from pyspark.sql import Column, DataFrame

from tablebridge.functions.literals import as_list, typed_literal
from tablebridge.functions.naming import ref
from tablebridge.operators.comparisons import FILTER_OPERATORS, compare

log = logging.getLogger(__name__)

# Fixed value: the column names a payload may use.
COLUMN_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


#: Column, canonical operator, value (a list for the IN forms), second value.
Condition = tuple[str, str, Any, Any]


class FilterError(ValueError):
    """A payload entry that strict mode refuses to skip."""


def parse_payload(filters: Any, strict: bool = False) -> list[Any]:
    """The payload's conditions; JSON text or a list."""
    if filters is None:
        return []
    if isinstance(filters, list):
        return filters
    if not isinstance(filters, str):
        return _skip("filters must be JSON text or a list", strict) or []
    if not filters.strip():
        return _skip("the filter text is empty", strict) or []
    try:
        parsed = json.loads(filters)
    except json.JSONDecodeError as error:
        return _skip(f"the filter text is not JSON: {error}", strict) or []
    if not isinstance(parsed, list):
        return _skip("the filter text is not a JSON list", strict) or []
    return parsed


def checked_conditions(filters: Any, strict: bool = False) -> list[Condition]:
    """The payload's usable conditions.

    By default an entry that cannot be used is logged and left out, which
    widens the result; ``strict`` raises instead.
    """
    found = (_condition(entry, strict) for entry in parse_payload(filters, strict))
    return [condition for condition in found if condition is not None]


def filter_predicate(df: DataFrame, filters: Any, strict: bool = False) -> Column | None:
    """The payload as one predicate on ``df``, or None when nothing filters."""
    terms = []
    for name, operator, value, second in checked_conditions(filters, strict):
        dtype = df.select(ref(name)).schema[0].dataType
        terms.append(compare(ref(name), dtype, operator, value, second, partial(typed_literal, dtype=dtype)))
    return reduce(lambda a, b: a & b, terms) if terms else None


def filter_rows(df: DataFrame, filters: Any, strict: bool = False) -> DataFrame:
    """Rows of ``df`` that pass the payload."""
    predicate = filter_predicate(df, filters, strict)
    return df if predicate is None else df.where(predicate)


def _condition(entry: Any, strict: bool) -> Condition | None:
    if not isinstance(entry, dict):
        return _skip(f"not a condition: {entry!r}", strict)
    column_info = entry.get("column")
    name = column_info.get("name") if isinstance(column_info, dict) else None
    if not isinstance(name, str) or not COLUMN_NAME.match(name):
        return _skip(f"not a column name: {name!r}", strict)
    raw = entry.get("operator")
    operator = FILTER_OPERATORS.get(str(raw or "").strip().upper().replace(" ", "_"))
    if operator is None:
        return _skip(f"unsupported operator {raw!r} on {name}", strict)

    value, second = entry.get("value"), entry.get("valueTo")
    if operator in ("in", "not_in"):
        value = as_list(value) if isinstance(value, (str, list)) else []
        if not value:
            return _skip(f"no values for {raw!r} on {name}", strict)
    elif operator in ("between", "not_between"):
        if value is None or second is None:
            return _skip(f"a bound is missing for {raw!r} on {name}", strict)
    elif operator not in ("is_null", "is_not_null") and value is None:
        return _skip(f"no value for {raw!r} on {name}", strict)
    return name, operator, value, second


def _skip(reason: str, strict: bool) -> None:
    if strict:
        raise FilterError(reason)
    log.warning("filter ignored: %s", reason)
    return None
