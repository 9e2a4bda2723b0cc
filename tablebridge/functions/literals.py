"""Payload values as typed literals.

A database reads a quoted literal as the type of the column it meets. Spark
would widen both sides instead, so the literal gets the column's type here. A
bare number keeps its own type: ``size > 5.5`` on an integer column must not
become ``size > 5``.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal, InvalidOperation
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The words the target database reads as booleans.
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")

_LONG_MIN, _LONG_MAX = -(2**63), 2**63 - 1


def as_number(value: Any) -> int | float | Decimal:
    """A payload number, given as number or as text."""
    if isinstance(value, bool):
        raise ValueError(f"expected a number, got {value!r}")
    if isinstance(value, (int, float, Decimal)):
        return value
    text = str(value).strip()
    try:
        return int(text)
    except ValueError:
        pass
    try:
        return Decimal(text)
    except InvalidOperation:
        raise ValueError(f"expected a number, got {value!r}") from None


def as_boolean(value: Any) -> bool:
    if isinstance(value, bool):
        return value
    word = str(value).strip().lower()
    if word in TRUE_WORDS:
        return True
    if word in FALSE_WORDS:
        return False
    raise ValueError(f"expected a boolean, got {value!r}")


def number_literal(value: int | float | Decimal, dtype: T.DataType | None = None) -> Column:
    """A number compared as a number, whatever the column's own width."""
    if isinstance(dtype, T.StringType):
        return F.lit(str(value))
    if isinstance(value, float) and isinstance(dtype, T.DecimalType):
        value = Decimal(repr(value))
    if isinstance(value, int) and not _LONG_MIN <= value <= _LONG_MAX:
        value = Decimal(value)
    return F.lit(value)


def typed_literal(value: Any, dtype: T.DataType | None) -> Column:
    """A payload value as the column's type."""
    if value is None:
        raise ValueError("a value is required")
    if isinstance(value, bool):
        if isinstance(dtype, T.StringType):
            return F.lit(str(value).lower())
        return F.lit(value)
    if isinstance(value, (int, float, Decimal)):
        return number_literal(value, dtype)
    if isinstance(value, (dt.datetime, dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
        return F.lit(value) if dtype is None else F.lit(value).cast(dtype)
    if not isinstance(value, str):
        value = str(value)
    if dtype is None or isinstance(dtype, T.StringType):
        return F.lit(value)
    if isinstance(dtype, T.IntegralType):
        return number_literal(int(value.strip()))
    if isinstance(dtype, T.FractionalType):
        number = as_number(value)
        return number_literal(number) if isinstance(dtype, T.DecimalType) else F.lit(float(number))
    if isinstance(dtype, T.BooleanType):
        return F.lit(as_boolean(value))
    return F.lit(value).cast(dtype)


def as_list(value: Any) -> list[Any]:
    """A list, or comma text split and trimmed with empty parts dropped."""
    if isinstance(value, str):
        return [part.strip() for part in value.split(",") if part.strip()]
    if isinstance(value, (list, tuple, set, frozenset)):
        return list(value)
    if value is None:
        return []
    return [value]


def sql_text(text: str) -> str:
    """Text as a Spark SQL literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
