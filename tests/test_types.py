"""Text forms, inference, conversion and catalogs."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions import types as names
from tablebridge.functions.text import stringify
from tablebridge.operators.infer import apply_inferred, apply_types, infer_types, rejected_values
from tablebridge.operators.schemas import (
    convert_catalog,
    dedupe_columns,
    describe_columns,
    source_columns,
    view_columns,
)


def test_numbers_as_text(spark):
    values = [0.0, -0.0, 0.1, 1e7, 12345678.9, 1e15, 1e16, 1.5e17, 1e-3, 1e-4, 1e-5, -2e-100,
              1e300, float("inf"), float("-inf"), float("nan"), 9999999.999]
    rows = stringify(spark.createDataFrame([(v,) for v in values], "v double")).collect()
    assert [row.v for row in rows] == [str(v) for v in values]


def test_values_as_text(spark):
    row = (True, b"a\xffb", dt.datetime(2024, 1, 1, 0, 0, 0, 500000), dt.datetime(2024, 1, 1),
           dt.date(2024, 1, 2), Decimal("1.50"), None)
    schema = "b boolean, y binary, t timestamp_ntz, z timestamp, d date, m decimal(9,2), n string"
    found = stringify(spark.createDataFrame([row], schema)).first()
    assert tuple(found) == (
        "True",
        b"a\xffb".decode("utf-8", "replace"),
        "2024-01-01 00:00:00.500000",
        "2024-01-01 00:00:00+00:00",
        "2024-01-02",
        "1.50",
        None,
    )


def test_lists_as_text(spark):
    texts = ["a", "it's", 'say "x"', "it's \"x\"", "a\\b\nc", None, ""]
    numbers = [[1.5, None], [], [1e16]]
    row = spark.createDataFrame([(texts, numbers, [True])], "t array<string>, n array<array<double>>, b array<boolean>")
    found = stringify(row).first()
    assert tuple(found) == (str(texts), str(numbers), str([True]))


INFERRED = {
    "all_null": ([None, None], "TEXT"),
    "blank": ([" ", "\t \n"], "TEXT"),
    "yes_no": (["Yes", "n", None], "BOOLEAN"),
    "zero_one": (["0", " 1 "], "BOOLEAN"),
    "int": (["-2147483648", "2147483647"], "INTEGER"),
    "big": (["2147483648", "1"], "BIGINT"),
    "huge": (["99999999999999999999999", "1"], "BIGINT"),
    "decimal": (["1.5", "2"], "DECIMAL"),
    "open_decimal": (["1.", "2"], "VARCHAR(50)"),
    "signed": (["+1", "2"], "VARCHAR(50)"),
    "iso": (["2024-01-01", "2024-13-45"], "DATE"),
    "us": (["01/31/2024", "02/01/2024"], "DATE"),
    "us_short": (["1/31/2024", "02/1/2024"], "DATE"),
    "slashes": (["2024/01/31", "2024/02/01"], "DATE"),
    "mixed_dates": (["2024-01-31", "2024/02/01"], "VARCHAR(50)"),
    "stamp": (["2024-01-31 10:00:00", "2024-01-31 10:00:00+02"], "TIMESTAMP"),
    "iso_stamp": (["2024-01-31T10:00:00", "2024-01-31T10:00:00Z"], "TIMESTAMP"),
    "mixed_stamps": (["2024-01-31T10:00:00", "2024-01-31 10:00:00"], "VARCHAR(50)"),
    "v50": (["x" * 50, "y"], "VARCHAR(50)"),
    "v51": (["x" * 51, "y"], "VARCHAR(100)"),
    "v101": (["x" * 101, "y"], "VARCHAR(255)"),
    "v256": (["x" * 256, "y"], "VARCHAR(500)"),
    "v501": (["x" * 501, "y"], "TEXT"),
    "wide_chars": (["é" * 50, "y"], "VARCHAR(50)"),
}


def test_infer(spark):
    columns = list(INFERRED)
    height = max(len(values) for values, _ in INFERRED.values())
    rows = [
        tuple((INFERRED[name][0] + [None] * height)[i] for name in columns) for i in range(height)
    ]
    table = spark.createDataFrame(rows, ", ".join(f"{name} string" for name in columns))
    found = {row.column_name: row.inferred for row in infer_types(table).collect()}
    assert found == {name: expected for name, (_, expected) in INFERRED.items()}


def test_infer_other_types_and_no_rows(spark):
    table = spark.createDataFrame(
        [(1, 0.5, True, dt.date(2024, 1, 1), 1e17), (2, float("nan"), None, None, 2.0)],
        "i int, f double, b boolean, d date, e double",
    )
    found = {row.column_name: row.inferred for row in infer_types(table).collect()}
    assert found == {"i": "INTEGER", "f": "DECIMAL", "b": "BOOLEAN", "d": "DATE", "e": "VARCHAR(50)"}
    empty = {row.column_name: row.inferred for row in infer_types(table.limit(0)).collect()}
    assert set(empty.values()) == {"TEXT"} and len(empty) == 5


def test_apply_types(spark):
    table = spark.createDataFrame(
        [(" 7 ", "1/31/2024", "yes", "1.5", "{a,b}", "keep "), ("x", "31/1/2024", "maybe", "", None, None)],
        "i string, d string, b string, n string, l string, t string",
    )
    types = {"i": "INTEGER", "d": "DATE", "b": "BOOLEAN", "n": "NUMERIC(5,1)", "l": "TEXT[]",
             "t": "VARCHAR(9)"}
    first, second = apply_types(table, types).collect()
    assert tuple(first) == (7, dt.date(2024, 1, 31), True, Decimal("1.5"), ["a", "b"], "keep ")
    assert tuple(second) == (None,) * 6
    lost = {row.column_name: row.rejected for row in rejected_values(table, types).collect()}
    assert lost == {"i": 1, "d": 1, "b": 1, "n": 0, "l": 0, "t": 0}
    with pytest.raises(ValueError):
        apply_types(table, {"zzz": "TEXT"})


def test_inferred_dates_apply(spark):
    """Every date form that inference accepts converts."""
    table = spark.createDataFrame(
        [("2024-02-03", "02/03/2024", "2/3/2024", "2024/02/03")], "a string, b string, c string, d string"
    )
    types = {row.column_name: row.inferred for row in infer_types(table).collect()}
    assert set(types.values()) == {"DATE"}
    assert tuple(apply_types(table, types).first()) == (dt.date(2024, 2, 3),) * 4


def test_apply_inferred(spark):
    table = spark.createDataFrame(
        [("1", "2.5", "yes", "x", 9), ("2", "3", "no", "y", 8)],
        "i string, d string, b string, t string, n int",
    )
    typed = apply_inferred(table)
    assert dict(typed.dtypes) == {
        "i": "int", "d": "decimal(38,18)", "b": "boolean", "t": "string", "n": "int"
    }
    assert [r.i for r in typed.collect()] == [1, 2]
    assert dict(apply_inferred(table, ["i"]).dtypes)["d"] == "string"
    assert apply_inferred(table.select("n")).dtypes == [("n", "int")]


def test_spark_types():
    assert names.spark_type("serial") == T.IntegerType()
    assert names.spark_type("numeric(10, 2)") == T.DecimalType(10, 2)
    assert names.spark_type("NUMERIC(10)") == T.DecimalType(10, 0)
    assert names.spark_type("DECIMAL") == T.DecimalType(38, 18)
    assert names.spark_type("character varying(50)") == T.StringType()
    assert names.spark_type("timestamp(3) without time zone") == T.TimestampNTZType()
    assert names.spark_type("TIMESTAMPTZ") == T.TimestampType()
    assert names.spark_type("double  precision") == T.DoubleType()
    assert names.spark_type("TEXT[]") == T.ArrayType(T.StringType())
    assert names.spark_type("JSONB") == T.StringType()


def test_declared_api_types():
    assert names.declared_api_type(T.ArrayType(T.ArrayType(T.IntegerType()))) == "number[][]"
    assert names.declared_api_type(T.TimestampNTZType()) == "Date"
    assert names.declared_api_type(T.BinaryType()) == "string"


def test_sqlserver_catalog(spark):
    rows = spark.createDataFrame(
        [
            (1, "Id", "int", 4, "NO", None, "YES", "NO", "YES"),
            (2, "Note", "nvarchar", -1, "YES", None, "NO", "NO", "NO"),
            (3, "Blob", "varbinary", -1, "YES", None, "NO", "NO", "NO"),
            (4, "Tag", "nvarchar", 100, "YES", None, "NO", "NO", "NO"),
            (5, "Odd", "geography", -1, "YES", None, "NO", "NO", "NO"),
            (6, "Doc", "xml", -1, "YES", None, "NO", "NO", "NO"),
            (7, "ID", "int", 4, "YES", None, "NO", "NO", "NO"),
            (8, "Up", "INT", 4, "YES", "((0))", "NO", "YES", "NO"),
        ],
        "column_id int, name string, data_type string, max_length int, is_nullable string,"
        "default_value string, is_primary_key string, is_foreign_key string, is_indexed string",
    )
    found = convert_catalog(rows, "sqlserver").orderBy("position").collect()
    assert [(r.name, r.type) for r in found] == [
        ("Id", "INTEGER"), ("Note", "TEXT"), ("Blob", "BYTEA"), ("Tag", "VARCHAR"),
        ("Odd", "TEXT"), ("Doc", "XML"), ("Up", "TEXT"),
    ]
    assert found[0].asDict() == {
        "position": 1, "name": "Id", "type": "INTEGER", "length": 4, "nullable": "NO",
        "default": None, "primary_key": "YES", "foreign_key": "NO", "is_index": "YES",
    }


def test_informix_codes(spark):
    codes = {2: "INTEGER", 258: "INTEGER", 13: "VARCHAR", 269: "VARCHAR", 262: "SERIAL",
             2061: "VARCHAR", 4117: "TEXT[]", 4118: "JSONB", 99: "TEXT", 10: "TIMESTAMP"}
    rows = spark.createDataFrame([(c, i) for i, c in enumerate(codes)], "coltype int, i int")
    rows = rows.selectExpr(
        "i AS ordinal_position", "'c' AS colname", "coltype", "4 AS collength",
        "CAST(NULL AS STRING) AS default_value", "'NO' AS is_primary_key",
        "'NO' AS is_foreign_key", "'NO' AS is_index",
    )
    found = convert_catalog(rows, "informix").orderBy("position").collect()
    assert [r.type for r in found] == list(codes.values())
    assert [r.nullable for r in found] == ["NO" if c & 256 else "YES" for c in codes]


def test_api_types(spark):
    pairs = {
        ("informix", "10"): "Date", ("informix", "257"): "unknown", ("informix", "269"): "string",
        ("informix", "19"): "string[]", ("postgres", "money"): "string",
        ("postgres", "timestamp without time zone"): "Datetime", ("postgres", "point"): "any",
        ("postgres", "USER-DEFINED"): "string", ("sqlserver", "datetime2"): "string",
        ("sqlserver", "money"): "number", ("sqlserver", "bit"): "boolean",
        ("sqlserver", "zzz"): "any",
    }
    rows = spark.createDataFrame(list(pairs), "dialect string, type string")
    typed = rows.withColumn("api", names.api_type_by_dialect(F.col("dialect"), F.col("type")))
    assert {(r.dialect, r.type): r.api for r in typed.collect()} == pairs
    columns = source_columns(rows.where("dialect = 'sqlserver'"), "sqlserver", "type", "type")
    assert {r.name: r.type for r in columns.collect()}["bit"] == "boolean"
    with pytest.raises(ValueError):
        names.api_type("oracle", F.lit("x"))


def test_view_columns(spark):
    rows = spark.createDataFrame(
        [("a", "numeric(10,2)"), ("b", "timestamp(3) without time zone"), ("c", "jsonb"), ("d", "bit(3)")],
        "name string, data_type string",
    )
    assert [tuple(r) for r in view_columns(rows).orderBy("name").collect()] == [
        ("a", "numeric", "number"), ("b", "timestamp", "Datetime"), ("c", "jsonb", "any"),
        ("d", "bit", "any"),
    ]


def test_columns(spark):
    table = spark.createDataFrame([(1, "a", 2.0)], "id int, Name string, NAME double")
    assert dedupe_columns(table).columns == ["id", "Name"]
    assert dedupe_columns(table).collect() == [(1, "a")]
    described = describe_columns(spark, {"t": table}).orderBy("position").collect()
    assert [(r.name, r.type) for r in described] == [("id", "number"), ("Name", "string"), ("NAME", "number")]


def test_nothing_is_lost_in_silence(spark):
    """Columns that do not convert whole stay text, or raise."""
    rows = [
        ("13/02/2024", "12345678901234567890", "2024-01-01 00:00:00 UTC+x", "1.1234567890123456789012", "\u0661\u0662", "7"),
        ("2024-02-13", "1", "2024-01-01 00:00:00", "1.5", "3", " 8 "),
    ]
    table = spark.createDataFrame(rows, "d string, b string, t string, n string, a string, i string")
    kept = apply_inferred(table)
    types = dict(kept.dtypes)
    assert {types[c] for c in "btna"} == {"string"} and types["i"] == "int"
    for name in "btna":
        assert [r[name] for r in kept.collect()] == [r[name] for r in table.collect()]
    with pytest.raises(ValueError, match="'b': 1"):
        apply_inferred(table, strict=True)
    with pytest.raises(ValueError, match="'b': 1"):
        apply_types(table, {"b": "BIGINT"}, strict=True)
    assert apply_inferred(table, ["i"], strict=True).schema["i"].dataType.simpleString() == "int"


def test_long_blanks_are_quick(spark):
    import time

    table = spark.createDataFrame([(" " * 100_000 + "7" + "\t" * 100_000,), (" " * 100_000,)], "v string")
    infer_types(table).collect()
    start = time.perf_counter()
    assert infer_types(table).collect()[0].inferred == "INTEGER"
    assert time.perf_counter() - start < 1.0


def test_wide_tables_are_measured_in_parts(spark):
    table = spark.range(3).select(*[(F.col("id") * i).cast("string").alias(f"c{i}") for i in range(95)])
    found = infer_types(table).collect()
    assert {r.column_name: r.inferred for r in found} == {name: "BOOLEAN" if name == "c0" else "INTEGER" for name in table.columns} | {"c1": "INTEGER"}


def test_lines_of_loads_merge(spark):
    from tablebridge.operators.infer import type_lines, types_of

    first = spark.createDataFrame([("1", "2024-01-02", "x"), ("2", None, "")], "a string, b string, c string")
    second = spark.createDataFrame([("3000000000", "2024-02-30", "y" * 60)], "a string, b string, c string")
    third = spark.createDataFrame([("1.5", None, None)], "a string, b string, c string")

    def found(lines):
        return {r.column_name: r.inferred for r in types_of(lines).collect()}

    lines = type_lines(first)
    assert found(lines) == {"a": "INTEGER", "b": "DATE", "c": "VARCHAR(50)"}
    lines = lines.union(type_lines(second))
    assert found(lines) == {"a": "BIGINT", "b": "DATE", "c": "VARCHAR(100)"}
    assert found(lines.union(type_lines(third)))["a"] == "DECIMAL"
    whole = first.union(second).union(third)
    assert found(lines.union(type_lines(third))) == {r.column_name: r.inferred for r in infer_types(whole).collect()}
