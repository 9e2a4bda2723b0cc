"""Query specs: a JSON description of one SELECT, run as a DataFrame.

Every table is read with its columns renamed to ``table.field``. Names then stay
unique and qualified through any number of joins and unions; Catalyst pushes
filters and pruning through the renames down to the scan.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.naming import ref
from tablebridge.functions.text import array_text, value_text
from tablebridge.operators.comparisons import ORDERED_OPERATORS, connector_of
from tablebridge.operators.conditions import LIST_TYPES, having_predicate, where_predicate
from tablebridge.operators.joins import join_frames

Tables = Mapping[str, DataFrame] | Callable[[str], DataFrame]

# Aggregate names of a spec, and the result names they get when
# a field has no alias.
AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "COUNT": F.count,
    "COUNT(DISTINCT)": F.count_distinct,
    "SUM": F.sum,
    "AVG": F.avg,
    "MIN": F.min,
    "MAX": F.max,
}
RESULT_NAMES = {
    "COUNT": "count",
    "COUNT(*)": "count",
    "COUNT(DISTINCT)": "count",
    "SUM": "sum",
    "AVG": "avg",
    "MIN": "min",
    "MAX": "max",
}
JOIN_TYPES = {"INNER": "inner", "LEFT": "left", "RIGHT": "right"}


class SpecError(ValueError):
    """A spec that describes no valid query."""


def run_spec(
    spec: Mapping[str, Any] | str, tables: Tables, invert_where: bool = False
) -> DataFrame:
    """The result of a spec; ``tables`` gives a DataFrame for a table name."""
    if isinstance(spec, str):
        spec = json.loads(spec)
    base_table = spec.get("baseTable")
    if not base_table:
        raise SpecError("baseTable is required")

    frame = _Frame(base_table, tables, _mentioned(spec))
    for join in spec.get("joins") or []:
        frame.add_join(join)

    predicate = where_predicate(spec.get("whereConditions"), frame.resolve, invert_where)
    rows = frame.rows if predicate is None else frame.rows.where(predicate)

    fields = spec.get("selectedFields") or []
    groups = [g for g in spec.get("groupByFields") or [] if g.get("field")]
    having = spec.get("having") or []
    distinct = any(_aggregate(field) == "DISTINCT" for field in fields)

    measured = any(_aggregate(field) not in (None, "DISTINCT") for field in fields)
    if measured or groups or any(entry.get("operator") for entry in having):
        result = _aggregated(frame, rows, fields, groups, having)
    elif fields:
        result = rows.select([_plain(frame, field) for field in fields])
    else:
        result = rows.select([ref(_flat(t, name)).alias(name) for t, name in frame.columns])
    return result.distinct() if distinct else result


class _Frame:
    """The joined rows so far and the tables behind their columns."""

    def __init__(self, base_table: str, tables: Tables, mentioned: set[str] | None):
        self._tables = tables
        self._mentioned = mentioned
        self.base_table = base_table
        self._fields: dict[str, dict[str, T.DataType]] = {}
        self.rows = self._load(base_table)

    @property
    def columns(self) -> list[tuple[str, str]]:
        return [(table, field) for table, fields in self._fields.items() for field in fields]

    def _load(self, table: str) -> DataFrame:
        if table in self._fields:
            raise SpecError(f"table {table!r} appears twice")
        df = self._tables(table) if callable(self._tables) else self._tables.get(table)
        if df is None:
            raise SpecError(f"unknown table: {table!r}")
        fields = df.schema.fields
        if self._mentioned is not None:
            used = [f for f in fields if f.name.lower() in self._mentioned]
            fields = used or fields[:1]
        self._fields[table] = {f.name: f.dataType for f in fields}
        return df.select([ref(f.name).alias(_flat(table, f.name)) for f in fields])

    def add_join(self, join: Mapping[str, Any]) -> None:
        """Join one more table to the base table; entries without target or
        conditions are ignored."""
        target, conditions = join.get("targetTable"), join.get("conditions") or []
        if not target or not conditions:
            return
        how = JOIN_TYPES.get(str(join.get("joinType") or "INNER").upper(), "inner")
        frame = self._load(target)
        groups: list[list[tuple[str, str, str]]] = []
        for index, condition in enumerate(conditions):
            source, field = condition.get("sourceField"), condition.get("targetField")
            if not source or not field:
                continue
            operator = condition.get("operator") or "="
            if operator not in ORDERED_OPERATORS and operator != "<>":
                raise SpecError(f"unsupported join operator: {operator!r}")
            triple = (
                _flat(self.base_table, self._field(self.base_table, source)),
                operator,
                _flat(target, self._field(target, field)),
            )
            connector = connector_of(conditions[index - 1]) if index else "AND"
            if groups and connector == "AND":
                groups[-1].append(triple)
            else:
                groups.append([triple])
        if not groups:
            raise SpecError(f"no usable join condition for {target!r}")
        alone = len(self._fields) == 2
        self.rows = join_frames(self.rows, frame, how, groups, base_is_table=alone)

    def resolve(self, table: str | None, field: str | None) -> tuple[Column, T.DataType]:
        """A column and its type; a bare field must be unambiguous."""
        if not field:
            raise SpecError("a field name is required")
        if table:
            if table not in self._fields:
                raise SpecError(f"table {table!r} is not part of the query")
            name = self._field(table, field)
            return ref(_flat(table, name)), self._fields[table][name]
        owners = [t for t in self._fields if self._find(t, field)]
        if len(owners) != 1:
            state = "ambiguous" if owners else "unknown"
            raise SpecError(f"{state} field: {field!r}")
        return self.resolve(owners[0], field)

    def key(self, table: str | None, field: str | None) -> str:
        """The flat name of a column."""
        if not table:
            table = next((t for t in self._fields if field and self._find(t, field)), None)
        self.resolve(table, field)
        return _flat(table, self._field(table, field))

    def _find(self, table: str, field: str) -> str | None:
        fields = self._fields[table]
        if field in fields:
            return field
        return next((name for name in fields if name.lower() == field.lower()), None)

    def _field(self, table: str, field: str) -> str:
        found = self._find(table, field)
        if found is None:
            raise SpecError(f"unknown field: {table}.{field}")
        return found


def _mentioned(spec: Mapping[str, Any]) -> set[str] | None:
    """All field names in a spec, in lower case; None when it selects all.

    Tables are cut down to these before they are joined, so that size probes and
    joins see no column the result does not need.
    """
    if not spec.get("selectedFields"):
        return None
    entries = [
        entry
        for part in ("selectedFields", "whereConditions", "groupByFields", "having")
        for entry in spec.get(part) or []
    ]
    entries += [c for join in spec.get("joins") or [] for c in join.get("conditions") or []]
    names = ("field", "targetField", "sourceField")
    return {str(entry[n]).lower() for entry in entries for n in names if entry.get(n)}


def _flat(table: str, field: str) -> str:
    return f"{table}.{field}"


def _aggregate(field: Mapping[str, Any]) -> str | None:
    """The aggregate a selected field asks for, if any."""
    name = str(field.get("aggregate") or "").upper()
    if field.get("selectType") != "AGGREGATE" or not name:
        return None
    return _count_all(name, field)


def _count_all(name: str, entry: Mapping[str, Any]) -> str:
    """COUNT(*) wins over any aggregate but the two DISTINCT forms."""
    if name in ("COUNT(DISTINCT)", "DISTINCT"):
        return name
    return "COUNT(*)" if entry.get("isCountAll") else name


def _alias(field: Mapping[str, Any]) -> str:
    return (field.get("alias") or "").strip().replace(" ", "_")


def _plain(frame: _Frame, field: Mapping[str, Any], column: Column | None = None) -> Column:
    """A selected field that is not aggregated."""
    found, dtype = frame.resolve(field.get("table"), field.get("field"))
    column = found if column is None else column
    if field.get("type") in LIST_TYPES and field.get("selectType") == "NORMAL":
        if isinstance(dtype, T.ArrayType):
            column = array_text(column, dtype.elementType)
        else:
            column = value_text(column, dtype)
    return column.alias(_alias(field) or field["field"])


def _measure(frame: _Frame, name: str, entry: Mapping[str, Any]) -> Column:
    if name == "COUNT(*)":
        return F.count(F.lit(1))
    if name not in AGGREGATES:
        raise SpecError(f"unsupported aggregate: {name!r}")
    column, _ = frame.resolve(entry.get("table"), entry.get("field"))
    return AGGREGATES[name](column)


def _aggregated(
    frame: _Frame,
    rows: DataFrame,
    fields: list[dict[str, Any]],
    groups: list[dict[str, Any]],
    having: list[dict[str, Any]],
) -> DataFrame:
    """Group once with the selected and the HAVING measures side by side."""
    if not fields:
        raise SpecError("a grouped query must select its fields")
    keys = list(dict.fromkeys(frame.key(g.get("table"), g["field"]) for g in groups))
    measures: dict[tuple[str, str | None], Column] = {}
    slots: dict[tuple[str, str | None], str] = {}

    def slot(name: str, entry: Mapping[str, Any]) -> str:
        """The hidden column of a measure; equal measures share one."""
        target = None if name == "COUNT(*)" else frame.key(entry.get("table"), entry.get("field"))
        if (name, target) not in slots:
            measures[name, target] = _measure(frame, name, entry)
            slots[name, target] = f"__m{len(slots)}"
        return slots[name, target]

    outputs = []
    for field in fields:
        name = _aggregate(field)
        if name in (None, "DISTINCT"):
            if frame.key(field.get("table"), field.get("field")) not in keys:
                raise SpecError(f"{field.get('field')!r} must be grouped or aggregated")
            outputs.append(_plain(frame, field))
        else:
            outputs.append(F.col(slot(name, field)).alias(_alias(field) or RESULT_NAMES[name]))

    tested: list[tuple[dict[str, Any], str | None]] = []
    for entry in having:
        if entry.get("operator"):
            name = str(entry.get("aggregate") or "").upper()
            grouped = not (entry.get("isAggregation") and name)
            tested.append((entry, None if grouped else slot(_count_all(name, entry), entry)))

    columns = [measure.alias(slots[key]) for key, measure in measures.items()]
    if columns:
        result = rows.groupBy([ref(key) for key in keys]).agg(*columns)
    elif keys:
        result = rows.select([ref(key) for key in keys]).distinct()
    else:
        raise SpecError("HAVING without groups needs an aggregate")

    types = {f.name: f.dataType for f in result.schema.fields}
    hidden = {id(entry): column for entry, column in tested}

    def tested_column(entry: dict[str, Any]) -> tuple[Column, T.DataType]:
        column = hidden[id(entry)]
        if column is not None:
            return F.col(column), types[column]
        key = frame.key(entry.get("table"), entry.get("field"))
        if key not in keys:
            raise SpecError(f"{entry.get('field')!r} must be grouped or aggregated")
        return ref(key), types[key]

    predicate = having_predicate(having, tested_column)
    if predicate is not None:
        result = result.where(predicate)
    return result.select(outputs)
