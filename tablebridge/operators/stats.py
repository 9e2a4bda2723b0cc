"""Statistics of columns kept as sketches, one set for each load of a table.

A load measures only its own rows, all columns in one pass, and appends a line for each column. Lines merge: counts add
up, least and greatest values compare, distinct-count and quantile sketches unite. So the statistics
of a growing table are read from a few lines, and no load reads what others brought.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.naming import ref
from tablebridge.functions.text import value_text

LINES = "`table` string, `load` string, column_name string, rows long, nulls long, lo string, hi string, distinct binary, quantiles binary"
#: log2 of a distinct-count sketch's size; it errs by about two percent.
DISTINCT_BITS = 12


def _number(column: Column, dtype: T.DataType) -> Column | None:
    """A value whose order quantiles are taken of: numbers, and days or seconds of times."""
    if isinstance(dtype, T.NumericType):
        return column.cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")) / 1e6
    return None


def sketch_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One line per column of the rows, in one pass: counts, ends and sketches."""
    fields = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)}
    names = [name for name in (columns or fields) if name in fields]
    measures, lines = [F.count(F.lit(1)).alias("rows")], []
    for i, name in enumerate(names):
        column, dtype = ref(name), fields[name]
        number = _number(column, dtype)
        item = column if isinstance(dtype, (T.IntegerType, T.LongType, T.StringType)) else column.cast("string")
        measures += [
            F.count(column).alias(f"n{i}"),
            F.min(column).alias(f"lo{i}"),
            F.max(column).alias(f"hi{i}"),
            F.hll_sketch_agg(item, F.lit(DISTINCT_BITS)).alias(f"d{i}"),
        ]
        if number is not None:
            measures.append(F.kll_sketch_agg_double(number).alias(f"q{i}"))
        lines.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("rows"),
                (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
                F.col(f"lo{i}").cast("string").alias("lo"),
                F.col(f"hi{i}").cast("string").alias("hi"),
                F.col(f"d{i}").alias("distinct"),
                (F.lit(None).cast("binary") if number is None else F.col(f"q{i}")).alias("quantiles"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*lines)))


class ColumnSketches:
    """The lines of many tables and loads, in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, table: str, load: str, rows: DataFrame, columns: Sequence[str] | None = None) -> None:
        """Measure the rows of a load."""
        lines = sketch_columns(rows, columns)
        lines.select(F.lit(table).alias("table"), F.lit(load).alias("load"), "*").write.mode("append").parquet(self.path)

    def lines(self, table: str, without: Sequence[str] = ()) -> DataFrame:
        """The table's lines, but for loads that were taken back."""
        own = self.spark.read.schema(LINES).parquet(self.path).where(F.col("table") == table)
        return own.where(~F.col("load").isin(list(without))) if without else own

    def stats(self, table: str, schema: T.StructType, without: Sequence[str] = (), ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
        """Per column rows, nulls, lo and hi as exact as of the whole table; about how many distinct values; quantiles of numbers and times."""
        lines = self.lines(table, without)
        types = {f.name: f.dataType for f in schema.fields}
        names = [row["column_name"] for row in lines.select("column_name").distinct().collect() if row["column_name"] in types]
        entries, measures = [], []
        for i, name in enumerate(sorted(names)):
            own, dtype = F.col("column_name") == name, types[name]
            measures += [
                F.sum(F.when(own, F.col("rows"))).alias(f"rows{i}"),
                F.sum(F.when(own, F.col("nulls"))).alias(f"nulls{i}"),
                F.min(F.when(own, F.col("lo").cast(dtype))).alias(f"lo{i}"),
                F.max(F.when(own, F.col("hi").cast(dtype))).alias(f"hi{i}"),
                F.hll_sketch_estimate(F.hll_union_agg(F.when(own, F.col("distinct")))).alias(f"d{i}"),
            ]
            numeric = _number(F.lit(None).cast(dtype), dtype) is not None
            at = F.array(*[F.lit(float(rank)) for rank in ranks])
            quantiles = F.lit(None).cast("array<double>")
            if numeric:
                measures.append(F.kll_merge_agg_double(F.when(own, F.col("quantiles"))).alias(f"q{i}"))
                quantiles = F.when(F.kll_sketch_get_n_double(F.col(f"q{i}")) > 0, F.kll_sketch_get_quantile_double(F.col(f"q{i}"), at))
            entries.append(
                F.struct(
                    F.lit(name).alias("column_name"),
                    F.col(f"rows{i}").alias("rows"),
                    F.col(f"nulls{i}").alias("nulls"),
                    F.col(f"d{i}").alias("distincts"),
                    value_text(F.col(f"lo{i}"), dtype).alias("lo"),
                    value_text(F.col(f"hi{i}"), dtype).alias("hi"),
                    quantiles.alias("quantiles"),
                )
            )
        if not entries:
            return self.spark.createDataFrame([], "column_name string, rows long, nulls long, distincts long, lo string, hi string, quantiles array<double>")
        return lines.agg(*measures).select(F.inline(F.array(*entries)))
