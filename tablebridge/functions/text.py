"""Values as text, inside JVM expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.naming import ref


def _plain_decimal(text: Column) -> Column:
    """Fixed-point text of a double, trailing zeros dropped, one digit kept."""
    digits = text.cast(T.DecimalType(38, 18)).cast("string")
    return F.regexp_replace(digits, r"(\.\d+?)0+$", "$1")


def _scientific(text: Column) -> Column:
    """``1.0E-7`` as ``1e-07``: signed exponent of two digits, no ``.0``."""
    lower = F.regexp_replace(text, r"(\.0)?E", "e")
    signed = F.regexp_replace(lower, r"e(\d)", "e+$1")
    return F.regexp_replace(signed, r"(?<=e[+-])(\d)$", "0$1")


def float_text(number: Column) -> Column:
    """A double the way the paged row API prints it.

    Plain from 1e-4 up to 1e16, scientific outside. Spark's own cast turns
    scientific at 1e-3 and 1e7 already.
    """
    size, text = F.abs(number), number.cast("string")
    return (
        F.when((size == 0) | ((size >= 1e-3) & (size < 1e7)), text)
        .when((size >= 1e-4) & (size < 1e16), _plain_decimal(text))
        .when(F.isnan(number), F.lit("nan"))
        .when(size == float("inf"), F.regexp_replace(text, "Infinity", "inf"))
        .otherwise(_scientific(text))
    )


def _timestamp_text(stamp: Column, zoned: bool) -> Column:
    """Seconds, then either no fraction or all six digits of it."""
    text = stamp.cast("string")
    padded = F.when(text.contains("."), F.rpad(text, 26, "0")).otherwise(text)
    return F.concat(padded, F.date_format(stamp, "xxx")) if zoned else padded


def value_text(column: Column, dtype: T.DataType) -> Column:
    """Any value as text; null stays null, bad UTF-8 bytes are replaced."""
    if isinstance(dtype, T.StringType):
        return column
    if isinstance(dtype, T.BinaryType):
        return F.make_valid_utf8(column.cast("string"))
    if isinstance(dtype, T.BooleanType):
        return F.initcap(column.cast("string"))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return float_text(column)
    if isinstance(dtype, T.TimestampNTZType):
        return _timestamp_text(column, zoned=False)
    if isinstance(dtype, T.TimestampType):
        return _timestamp_text(column, zoned=True)
    if isinstance(dtype, T.ArrayType):
        return _list_text(column, dtype.elementType)
    return column.cast("string")


def _list_text(column: Column, element: T.DataType) -> Column:
    """A list with its texts quoted: ``['a', "it's", None, 1.5]``."""

    def one(item: Column) -> Column:
        text = value_text(item, element)
        if isinstance(element, T.StringType):
            escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
            for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
                escaped = F.replace(escaped, F.lit(raw), F.lit(shown))
            single = F.concat(
                F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'")
            )
            double = F.concat(F.lit('"'), escaped, F.lit('"'))
            text = F.when(text.contains("'") & ~text.contains('"'), double).otherwise(single)
        return F.when(item.isNull(), F.lit("None")).otherwise(text)

    return F.concat(F.lit("["), F.array_join(F.transform(column, one), ", "), F.lit("]"))


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text, same names and order."""
    return df.select(
        [value_text(ref(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def array_text(column: Column, element: T.DataType) -> Column:
    """An array in the target database's text form: ``{a,"b c",NULL}``.

    Elements that are empty, spell NULL, or hold a brace, comma, quote,
    backslash or whitespace are quoted, with quotes and backslashes escaped.
    """

    def one(item: Column) -> Column:
        if isinstance(element, T.BooleanType):
            text = F.when(item, F.lit("t")).otherwise(F.lit("f"))
        elif isinstance(element, T.ArrayType):
            text = array_text(item, element.elementType)
        else:
            text = item.cast("string")
        if isinstance(element, T.NumericType):
            return F.coalesce(text, F.lit("NULL"))
        if isinstance(element, (T.ArrayType, T.BooleanType)):
            return F.when(item.isNull(), F.lit("NULL")).otherwise(text)
        special = (text == "") | (F.upper(text) == "NULL") | text.rlike(r'[{},"\\\s]')
        quoted = F.concat(F.lit('"'), F.regexp_replace(text, r'(["\\])', r"\\$1"), F.lit('"'))
        return (
            F.when(item.isNull(), F.lit("NULL")).when(special, quoted).otherwise(text)
        )

    return F.concat(F.lit("{"), F.array_join(F.transform(column, one), ","), F.lit("}"))
