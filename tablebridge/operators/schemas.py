"""Table and column metadata: described, and converted between dialects."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.naming import ref
from tablebridge.functions.types import (
    POSTGRES_API,
    api_type,
    declared_api_type,
    informix_target_type,
    lookup,
    sqlserver_target_type,
)

# The columns of converted metadata, in order.
CONVERTED = (
    "position",
    "name",
    "type",
    "length",
    "nullable",
    "default",
    "primary_key",
    "foreign_key",
    "is_index",
)
_DESCRIBED = "table_name string, position int, name string, type string, alias string"


def describe_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of each table, with its API type; reads no data."""
    rows = [
        (table, position, field.name, declared_api_type(field.dataType), field.name)
        for table, df in tables.items()
        for position, field in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, _DESCRIBED)


def measured_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``describe_columns`` with the longest value of each text column.

    Files declare no lengths, so they are measured: one aggregate per table,
    which reads its text columns only.
    """
    parts = []
    for table, df in tables.items():
        fields = df.schema.fields
        texts = [i for i, f in enumerate(fields) if isinstance(f.dataType, T.StringType)]
        longest = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.max(F.length(ref(fields[i].name))).alias(f"n{i}") for i in texts],
        )
        entries = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("name"),
                F.lit(declared_api_type(f.dataType)).alias("type"),
                (F.col(f"n{i}") if i in texts else F.lit(None).cast("int")).alias("length"),
            )
            for i, f in enumerate(fields)
        ]
        parts.append(longest.select(F.inline(F.array(*entries))))
    return reduce(lambda a, b: a.unionByName(b), parts)


def convert_catalog(rows: DataFrame, dialect: str) -> DataFrame:
    """Catalog rows of a source dialect as metadata of the target.

    ``rows`` may hold any number of tables when it has a ``table_name`` column.
    """
    if dialect == "sqlserver":
        return _converted(
            drop_repeated_names(rows, "name", "column_id"),
            position=F.col("column_id"),
            name=F.col("name"),
            type=sqlserver_target_type(F.col("data_type"), F.col("max_length")),
            length=F.col("max_length"),
            nullable=F.col("is_nullable"),
            default=F.col("default_value"),
            is_index=F.col("is_indexed"),
        )
    if dialect == "informix":
        required = F.col("coltype").bitwiseAND(F.lit(256)) == 256
        return _converted(
            rows,
            position=F.col("ordinal_position"),
            name=F.col("colname"),
            type=informix_target_type(F.col("coltype")),
            length=F.col("collength"),
            nullable=F.when(required, F.lit("NO")).otherwise(F.lit("YES")),
            default=F.col("default_value"),
            is_index=F.col("is_index"),
        )
    if dialect == "postgres":
        return _converted(
            rows,
            position=F.col("position"),
            name=F.col("name"),
            type=F.upper(F.col("data_type")),
            length=F.col("max_length"),
            nullable=F.col("is_nullable"),
            default=F.coalesce(F.col("default_value"), F.lit("")),
            is_index=F.col("is_index"),
        )
    raise ValueError(f"unknown dialect: {dialect!r}")


def _converted(rows: DataFrame, **columns: Column) -> DataFrame:
    columns["primary_key"] = F.col("is_primary_key")
    columns["foreign_key"] = F.col("is_foreign_key")
    table = [F.col("table_name")] if "table_name" in rows.columns else []
    return rows.select(*table, *[columns[name].alias(name) for name in CONVERTED])


def drop_repeated_names(rows: DataFrame, name: str, position: str) -> DataFrame:
    """Catalog rows without the later of two names equal but for case."""
    within = ["table_name"] if "table_name" in rows.columns else []
    first = Window.partitionBy(*within, F.lower(ref(name))).orderBy(ref(position))
    return (
        rows.withColumn("__seen", F.row_number().over(first))
        .where(F.col("__seen") == 1)
        .drop("__seen")
    )


def dedupe_columns(df: DataFrame) -> DataFrame:
    """A frame without the later of two columns equal but for case."""
    unique = df.toDF(*[f"__c{i}" for i in range(len(df.columns))])
    kept: dict[str, Column] = {}
    for i, name in enumerate(df.columns):
        kept.setdefault(name.lower(), F.col(f"__c{i}").alias(name))
    return unique.select(list(kept.values()))


def view_columns(rows: DataFrame) -> DataFrame:
    """View columns with their base type, lengths cut off, and API type.

    ``rows`` holds ``name`` and ``data_type`` as the target database prints it.
    """
    base = F.trim(F.split_part(F.col("data_type"), F.lit("("), F.lit(1)))
    return rows.select(
        "name", base.alias("base_type"), lookup(POSTGRES_API, base, "any").alias("type")
    )


def source_columns(rows: DataFrame, dialect: str, name: str, native: str) -> DataFrame:
    """Columns of a source dialect with their API type."""
    return rows.select(
        ref(name).alias("name"), api_type(dialect, ref(native)).alias("type")
    )
