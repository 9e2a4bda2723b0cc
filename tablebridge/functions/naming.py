"""Column references that survive any name."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PLAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*(\.[A-Za-z_][A-Za-z0-9_$]*){0,2}")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col(quoted(name))


def unused(df: DataFrame, name: str) -> str:
    """A name for a new column; raises when the table has it already."""
    if name.lower() in (column.lower() for column in df.columns):
        raise ValueError(f"the table has a column {name!r} already; choose another name")
    return name


def name_list(names: str | Sequence[str]) -> list[str]:
    """Key columns as a list; comma text is accepted."""
    if isinstance(names, str):
        names = [part.strip() for part in names.split(",")]
    found = [name for name in names if name]
    if not found:
        raise ValueError("at least one column name is required")
    return found


def checked_name(name: str) -> str:
    """A plain, optionally qualified name; anything else could be a statement."""
    if not _PLAIN.fullmatch(name):
        raise ValueError(f"not a plain table or column name: {name!r}")
    return name
