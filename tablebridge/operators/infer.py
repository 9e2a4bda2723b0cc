"""Column types from text values, and text to typed columns."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.literals import FALSE_WORDS, TRUE_WORDS
from tablebridge.functions.naming import ref
from tablebridge.functions.text import value_text
from tablebridge.functions.types import spark_type

_log = logging.getLogger(__name__)

# What a column must hold, throughout, to be of a type. The types
# are tried in the order boolean, integer, decimal, date, timestamp, text. Digits
# are those of any script, which Java writes as \p{Nd}: its \d is ASCII only.
BOOLEAN_WORDS = ("true", "false", "1", "0", "yes", "no", "y", "n")
INTEGER = r"^-?\p{Nd}+$"
DECIMAL = r"^-?\p{Nd}+\.\p{Nd}+$"
DATE_FORMS = (
    r"^\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}$",
    r"^\p{Nd}{2}/\p{Nd}{2}/\p{Nd}{4}$",
    r"^\p{Nd}{1,2}/\p{Nd}{1,2}/\p{Nd}{4}$",
    r"^\p{Nd}{4}/\p{Nd}{2}/\p{Nd}{2}$",
)
TIMESTAMP_FORMS = (
    r"^\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2} \p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2}",
    r"^\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}T\p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2}",
)
TEXT_LENGTHS = (50, 100, 255, 500)
INT32 = (-2147483648, 2147483647)

# One bit per question; a column passes a question when all its values do.
_BOOLEAN, _INTEGER, _INT32, _NUMBER = 1, 2, 4, 8
_DATES = tuple(1 << (4 + i) for i in range(len(DATE_FORMS)))
_STAMPS = tuple(1 << (8 + i) for i in range(len(TIMESTAMP_FORMS)))

# Fixed value: the characters that count as blank around a value.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def stripped(text: Column) -> Column:
    """Text without surrounding blanks; empty when nothing is left."""
    return F.btrim(text, F.lit(BLANKS))


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: ``column_name`` and the ``inferred`` target type.

    Nulls and blank values say nothing. ``type_lines`` of several loads of a table, united, give
    the types of all their rows through ``types_of``, without reading old rows again.
    """
    lines = type_lines(df, columns)
    return lines.select("column_name", _verdict(F.col("bits"), F.col("longest")).alias("inferred"))


def types_of(lines: DataFrame) -> DataFrame:
    """``column_name`` and ``inferred`` of the united ``type_lines`` of any parts of a table."""
    merged = lines.groupBy("column_name").agg(F.bit_and("bits").alias("bits"), F.max("longest").alias("longest"))
    return merged.select("column_name", _verdict(F.col("bits"), F.col("longest")).alias("inferred"))


def type_lines(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: ``column_name``, ``bits`` and ``longest``.

    A map task reduces each column to these two numbers before the shuffle: the questions every value passes, and the
    longest value. Values of all columns go through one expression, which keeps its code small however wide the table is.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    names = list(columns or fields)
    entries = [F.struct(F.lit(name).alias("column_name"), _text(ref(name), fields[name]).alias("v")) for name in names]
    texts = df.select(F.inline(F.array(*entries)))
    bare = texts.select("column_name", stripped(F.col("v")).alias("v"))
    known = bare.select("column_name", F.when(F.col("v") != "", F.col("v")).alias("v"))
    measured = known.select("column_name", _answers(F.col("v")).alias("bits"), F.length("v").alias("longest"))
    lines = measured.groupBy("column_name").agg(F.bit_and("bits").alias("bits"), F.max("longest").alias("longest"))
    # A table without rows has columns too.
    every = df.sparkSession.createDataFrame([(name,) for name in names], "column_name string")
    return every.join(F.broadcast(lines), "column_name", "left")  # a row per column


def _text(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        column = F.when(~F.isnan(column), column)
    return value_text(column, dtype)


def _answers(value: Column) -> Column:
    """The questions a value passes; null for a null.

    The forms exclude each other, so cheap looks at the value decide which
    patterns it has to meet.
    """

    def bits(forms: Sequence[str], flags: Sequence[int]) -> Column:
        hits = [
            F.when(value.rlike(form), F.lit(flag)).otherwise(F.lit(0))
            for form, flag in zip(forms, flags)
        ]
        return reduce(lambda a, b: a + b, hits)

    length = F.length(value)
    stamp = F.substring(value, 14, 1) == ":"
    date = length.between(8, 10) & (value.contains("/") | (F.substring(value, 5, 1) == "-"))
    fits = (length <= 9) | value.try_cast("bigint").between(*INT32)
    shape = (
        F.when(stamp, bits(TIMESTAMP_FORMS, _STAMPS))
        .when(date, bits(DATE_FORMS, _DATES))
        .when(~value.rlike(r"^[-\p{Nd}]"), F.lit(0))
        .when(
            value.rlike(INTEGER),
            F.when(fits, F.lit(_INTEGER | _NUMBER | _INT32)).otherwise(F.lit(_INTEGER | _NUMBER)),
        )
        .when(value.rlike(DECIMAL), F.lit(_NUMBER))
        .otherwise(F.lit(0))
    )
    word = (length <= 5) & F.lower(value).isin(*BOOLEAN_WORDS)
    return F.when(
        value.isNotNull(), shape + F.when(word, F.lit(_BOOLEAN)).otherwise(F.lit(0))
    )


def _verdict(bits: Column, length: Column) -> Column:
    def passed(*flags: int) -> Column:
        return reduce(lambda a, b: a | b, [bits.bitwiseAND(F.lit(flag)) != 0 for flag in flags])

    chosen = (
        F.when(bits.isNull(), F.lit("TEXT"))
        .when(passed(_BOOLEAN), F.lit("BOOLEAN"))
        .when(passed(_INTEGER) & passed(_INT32), F.lit("INTEGER"))
        .when(passed(_INTEGER), F.lit("BIGINT"))
        .when(passed(_NUMBER), F.lit("DECIMAL"))
        .when(passed(*_DATES), F.lit("DATE"))
        .when(passed(*_STAMPS), F.lit("TIMESTAMP"))
    )
    for limit in TEXT_LENGTHS:
        chosen = chosen.when(length <= limit, F.lit(f"VARCHAR({limit})"))
    return chosen.otherwise(F.lit("TEXT"))


# What the text of a number, or of a number out of the ordinary, looks like. A
# cast that fails costs far more than a pattern, so only such text is cast.
_WHOLE = r"^[-+]?\d+$"
_REAL = r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"
_REAL_WORDS = ("nan", "inf", "-inf", "+inf", "infinity", "-infinity", "+infinity")


def _keeps_blanks(type_name: str) -> bool:
    return isinstance(spark_type(type_name), (T.StringType, T.BinaryType))


def _stripped_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The frame with values to convert stripped, as a step of its own so that
    each value is stripped once however often its conversion looks at it."""
    unknown = set(types) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    changed = [name for name in df.columns if name in types and not _keeps_blanks(types[name])]
    bare = df.select(
        [stripped(ref(name)).alias(name) if name in changed else ref(name) for name in df.columns]
    )
    return bare.select(
        [
            F.when(ref(name) != "", ref(name)).alias(name) if name in changed else ref(name)
            for name in df.columns
        ]
    )


def converts(value: Column, type_name: str) -> Column:
    """Whether stripped text is a value of the target type, with nothing of it lost."""
    whole = typed_value(value, type_name).isNotNull()
    dtype = spark_type(type_name)
    if isinstance(dtype, T.DecimalType):
        fraction = F.rtrim(F.regexp_extract(value, r"\.(\d*)$", 1), F.lit("0"))
        return whole & ~value.rlike("[eE]") & (F.length(fraction) <= dtype.scale)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        fraction = F.rtrim(F.regexp_extract(value, r":\d\d\.(\d+)", 1), F.lit("0"))
        return whole & (F.length(fraction) <= 6)
    return whole


def typed_value(value: Column, type_name: str) -> Column:
    """Text as a value of a target type; null where it is not one.

    Expects stripped text for all types that are not text themselves.
    """
    dtype = spark_type(type_name)
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, T.BinaryType):
        return value.cast("binary")
    if isinstance(dtype, T.ArrayType):
        inner = F.nullif(F.regexp_replace(value, r"^\{|\}$", ""), F.lit(""))
        return F.when(value.isNotNull(), F.coalesce(F.split(inner, ","), F.array().cast(dtype)))
    if isinstance(dtype, T.DateType):
        # One of the accepted forms, turned into the form a cast reads.
        ordered = F.regexp_replace(value, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2")
        iso = F.translate(ordered, "/", "-")
        return F.when(value.rlike("|".join(DATE_FORMS)), iso.try_cast("date"))
    if isinstance(dtype, T.BooleanType):
        word = F.lower(value)
        return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(
            word.isin(*FALSE_WORDS), F.lit(False)
        )
    if isinstance(dtype, T.IntegralType):
        wide = F.when(value.rlike(_WHOLE), value.try_cast("bigint"))
        if isinstance(dtype, T.LongType):
            return wide
        limit = 2**15 if isinstance(dtype, T.ShortType) else 2**31
        return F.when(wide.between(-limit, limit - 1), wide.cast(dtype))
    if isinstance(dtype, T.DecimalType):
        return F.when(value.rlike(_REAL), value.try_cast(dtype))
    if isinstance(dtype, T.FractionalType):
        known = value.rlike(_REAL) | F.lower(value).isin(*_REAL_WORDS)
        return F.when(known, value.try_cast(dtype))
    return F.when(value.rlike(r"^\d{4}-\d{1,2}"), value.try_cast(dtype))


def apply_types(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Text columns converted to the named target types; others unchanged.

    What does not convert becomes null, as ``rejected_values`` counts; with
    ``strict`` it raises, before anything is converted.
    """
    if strict:
        lost = {
            row["column_name"]: row["rejected"]
            for row in rejected_values(df, types).collect()
            if row["rejected"]
        }
        if lost:
            raise ValueError(f"values that do not convert whole, by column: {lost}")
    return _stripped_columns(df, types).select(
        [
            typed_value(ref(name), types[name]).alias(name) if name in types else ref(name)
            for name in df.columns
        ]
    )


def apply_inferred(
    df: DataFrame, columns: Sequence[str] | None = None, strict: bool = False
) -> DataFrame:
    """Text columns converted to the types their values have.

    The types, one name per column, and the number of values that would be lost are
    worked out first. A column that does not convert whole stays text, which is
    logged; with ``strict`` it raises instead.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    wanted = [name for name in texts if columns is None or name in columns]
    if not wanted:
        return df
    found = {row["column_name"]: row["inferred"] for row in infer_types(df, wanted).collect()}
    lost = {
        row["column_name"]: row["rejected"]
        for row in rejected_values(df, found).collect()
        if row["rejected"]
    }
    if lost and strict:
        raise ValueError(f"values that do not convert whole, by column: {lost}")
    if lost:
        _log.warning("columns left as text, by values that do not convert whole: %s", lost)
    return apply_types(df, {name: kind for name, kind in found.items() if name not in lost})


def rejected_values(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """How many non-blank values of each column do not convert, or not without loss."""
    counts = [
        F.count_if(ref(name).isNotNull() & ~converts(ref(name), type_name)).alias(f"n{i}")
        for i, (name, type_name) in enumerate(types.items())
    ]
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(type_name).alias("type"),
            F.col(f"n{i}").alias("rejected"),
        )
        for i, (name, type_name) in enumerate(types.items())
    ]
    measured = _stripped_columns(df, types).agg(*counts)
    return measured.select(F.inline(F.array(*entries)))
