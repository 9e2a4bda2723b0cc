"""Type names of the source dialects, the target database and the API.

The tables below are fixed values: each dialect's names or codes and what they
mean on the other side. Lookups are literal maps of a few dozen entries inside
the expression, so converting a catalog needs no join.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Informix type codes (low byte) to target types.
INFORMIX_TARGET = {
    0: "CHAR",
    1: "SMALLINT",
    2: "INTEGER",
    3: "DOUBLE PRECISION",
    4: "REAL",
    5: "DECIMAL",
    6: "SERIAL",
    7: "DATE",
    8: "NUMERIC",
    9: "TEXT",
    10: "TIMESTAMP",
    11: "BYTEA",
    12: "TEXT",
    13: "VARCHAR",
    14: "INTERVAL",
    15: "CHAR",
    16: "VARCHAR",
    17: "BIGINT",
    18: "BIGSERIAL",
    19: "TEXT[]",
    20: "TEXT[]",
    21: "TEXT[]",
    22: "JSONB",
    23: "JSONB",
    24: "JSONB",
    25: "INTEGER",
    26: "BIGINT",
    27: "VARCHAR",
    28: "BOOLEAN",
    31: "BYTEA",
    32: "BOOLEAN",
    35: "TEXT",
    36: "BYTEA",
    37: "TEXT",
    40: "VARCHAR",
    41: "BOOLEAN",
    42: "TEXT",
    43: "VARCHAR",
    45: "BOOLEAN",
    52: "BIGINT",
    53: "BIGSERIAL",
}

# Informix type codes (whole code) to API types.
INFORMIX_API = {
    0: "string",
    1: "number",
    2: "number",
    3: "number",
    4: "number",
    5: "number",
    6: "number",
    7: "Date",
    8: "number",
    9: "null",
    10: "Date",
    11: "binary",
    12: "string",
    13: "string",
    14: "string",
    15: "string",
    16: "string",
    17: "number",
    18: "number",
    19: "string[]",
    20: "string[]",
    21: "string[]",
    22: "Record<string, any>",
    23: "any[]",
    24: "Record<string, any>",
    25: "number",
    26: "number",
    27: "string",
    28: "boolean",
    31: "binary",
    32: "boolean",
    35: "string",
    36: "binary",
    37: "string",
    40: "string",
    41: "boolean",
    42: "string",
    43: "string",
    45: "boolean",
    52: "number",
    53: "number",
    256: "string",
    258: "string",
    262: "number",
    263: "Date",
    269: "string",
    2061: "string",
    4117: "Record<string, any>",
    4118: "Record<string, any>",
}

# PostgreSQL type names to API types.
POSTGRES_API = {
    "smallint": "number",
    "integer": "number",
    "bigint": "number",
    "numeric": "number",
    "decimal": "number",
    "real": "number",
    "double precision": "number",
    "smallserial": "number",
    "serial": "number",
    "bigserial": "number",
    "money": "string",
    "character varying": "string",
    "varchar": "string",
    "character": "string",
    "char": "string",
    "text": "string",
    "citext": "string",
    "uuid": "string",
    "boolean": "boolean",
    "bool": "boolean",
    "date": "Date",
    "time": "string",
    "time without time zone": "string",
    "time with time zone": "string",
    "timestamp": "Datetime",
    "timestamp without time zone": "Datetime",
    "timestamp with time zone": "Datetime",
    "interval": "string",
    "json": "any",
    "jsonb": "any",
    "USER-DEFINED": "string",
}

# SQL Server type names to API types.
SQLSERVER_API = {
    "tinyint": "number",
    "smallint": "number",
    "int": "number",
    "bigint": "number",
    "decimal": "number",
    "numeric": "number",
    "float": "number",
    "real": "number",
    "smallmoney": "number",
    "money": "number",
    "bit": "boolean",
    "char": "string",
    "nchar": "string",
    "varchar": "string",
    "nvarchar": "string",
    "text": "string",
    "ntext": "string",
    "xml": "string",
    "sysname": "string",
    "uniqueidentifier": "string",
    "binary": "string",
    "varbinary": "string",
    "image": "string",
    "rowversion": "string",
    "timestamp": "string",
    "date": "Date",
    "time": "string",
    "datetime": "Datetime",
    "smalldatetime": "Datetime",
    "datetime2": "string",
    "datetimeoffset": "string",
    "geometry": "any",
    "geography": "any",
    "hierarchyid": "any",
    "sql_variant": "any",
}

# SQL Server type names to target types.
SQLSERVER_TARGET = {
    "tinyint": "SMALLINT",
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "integer": "INTEGER",
    "bigint": "BIGINT",
    "decimal": "NUMERIC",
    "numeric": "NUMERIC",
    "float": "DOUBLE PRECISION",
    "real": "REAL",
    "smallmoney": "MONEY",
    "money": "MONEY",
    "bit": "BOOLEAN",
    "char": "CHAR",
    "nchar": "CHAR",
    "varchar": "VARCHAR",
    "nvarchar": "VARCHAR",
    "text": "TEXT",
    "ntext": "TEXT",
    "xml": "XML",
    "sysname": "TEXT",
    "uniqueidentifier": "UUID",
    "binary": "BYTEA",
    "varbinary": "BYTEA",
    "image": "BYTEA",
    "rowversion": "BYTEA",
    "timestamp": "BYTEA",
    "date": "DATE",
    "time": "TIME",
    "datetime": "TIMESTAMP",
    "smalldatetime": "TIMESTAMP",
    "datetime2": "TIMESTAMP",
    "datetimeoffset": "TIMESTAMPTZ",
    "geometry": "GEOMETRY",
    "geography": "GEOGRAPHY",
    "hierarchyid": "LTREE",
    "sql_variant": "JSONB",
}

# SQL Server types whose unbounded form (length -1) keeps a type
# of its own; every other unbounded type is TEXT.
SQLSERVER_UNBOUNDED = {"VARBINARY": "BYTEA", "IMAGE": "BYTEA", "XML": "XML"}

# The types unknown names and codes get.
API_DEFAULT = {"informix": "unknown", "postgres": "any", "sqlserver": "any"}
TARGET_DEFAULT = "TEXT"

_API = {"informix": INFORMIX_API, "postgres": POSTGRES_API, "sqlserver": SQLSERVER_API}
DIALECTS = tuple(_API)

_SPARK_TYPES = {
    "SMALLINT": T.ShortType(),
    "INTEGER": T.IntegerType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "SMALLSERIAL": T.ShortType(),
    "SERIAL": T.IntegerType(),
    "BIGSERIAL": T.LongType(),
    "REAL": T.FloatType(),
    "DOUBLE PRECISION": T.DoubleType(),
    "DECIMAL": T.DecimalType(38, 18),
    "NUMERIC": T.DecimalType(38, 18),
    "MONEY": T.DecimalType(19, 4),
    "BYTEA": T.BinaryType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "TIMESTAMP WITHOUT TIME ZONE": T.TimestampNTZType(),
    "TIMESTAMPTZ": T.TimestampType(),
    "TIMESTAMP WITH TIME ZONE": T.TimestampType(),
}


def lookup(table: Mapping, key: Column, default: str) -> Column:
    """The table's entry for a key column."""
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def api_type(dialect: str, native: Column) -> Column:
    """The API type of a native type name, or of a whole Informix code."""
    if dialect not in _API:
        raise ValueError(f"unknown dialect: {dialect!r}")
    key = native.try_cast("int") if dialect == "informix" else native
    return lookup(_API[dialect], key, API_DEFAULT[dialect])


def api_type_by_dialect(dialect: Column, native: Column) -> Column:
    """``api_type`` where the dialect is a column too; null for other dialects."""
    chosen = F.lit(None).cast("string")
    for name in DIALECTS:
        chosen = F.when(dialect == name, api_type(name, native)).otherwise(chosen)
    return chosen


def informix_target_type(code: Column) -> Column:
    """The low byte of a code names the type; higher bits are flags."""
    return lookup(INFORMIX_TARGET, (code % 256).cast("int"), TARGET_DEFAULT)


def sqlserver_target_type(name: Column, max_length: Column) -> Column:
    """Names match in lower case, except for unbounded types."""
    unbounded = lookup(SQLSERVER_UNBOUNDED, F.upper(name), TARGET_DEFAULT)
    return F.when(max_length == -1, unbounded).otherwise(
        lookup(SQLSERVER_TARGET, name, TARGET_DEFAULT)
    )


def declared_api_type(dtype: T.DataType) -> str:
    """The API type of a Spark column type."""
    if isinstance(dtype, T.NumericType):
        return "number"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "Date"
    if isinstance(dtype, T.ArrayType):
        return declared_api_type(dtype.elementType) + "[]"
    return "string"


def spark_type(name: str) -> T.DataType:
    """The Spark type of a target type name; lengths are metadata only."""
    text = re.sub(r"\s+", " ", name.strip().upper())
    if text.endswith("[]"):
        return T.ArrayType(spark_type(text[:-2]))
    match = re.fullmatch(r"([A-Z ]+?) ?\(([\d ,]+)\)( .*)?", text)
    base = match.group(1) + (match.group(3) or "") if match else text
    if match and base in ("DECIMAL", "NUMERIC"):
        numbers = [int(part) for part in match.group(2).split(",")]
        return T.DecimalType(numbers[0], numbers[1] if len(numbers) > 1 else 0)
    return _SPARK_TYPES.get(base, T.StringType())
