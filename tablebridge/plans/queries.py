"""One query per operator, over the given tables.

Each takes a session and a folder of parquet tables. Where an operator needs
input the tables lack (nulls, arrays, catalog rows), Spark derives it from whole
tables first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablebridge.functions import types as names
from tablebridge.functions.text import stringify
from tablebridge.operators.checks import column_stats, key_violations, load_violations
from tablebridge.operators.deltas import delta_page, delta_snapshot, latest_changes
from tablebridge.operators.filters import filter_rows
from tablebridge.operators.infer import (
    apply_inferred,
    apply_types,
    infer_types,
    rejected_values,
)
from tablebridge.operators.joins import join_frames
from tablebridge.operators.paging import next_page, number_rows, page, read_page
from tablebridge.operators.schemas import (
    convert_catalog,
    dedupe_columns,
    measured_columns,
    view_columns,
)
from tablebridge.operators.stats import ColumnSketches
from tablebridge.plans.spec import run_spec
from tablebridge.session import scratch_path
from tablebridge.sinks.layout import per_column, plan_layout, unique_violations, write_layout
from tablebridge.sinks.partitions import (
    in_dates,
    read_partitioned,
    write_target,
)
from tablebridge.sinks.tables import (
    create_table,
    insert_rows,
    reload_files,
    reload_table,
    truncate_table,
)
from tablebridge.sinks.versions import location, manifest, restore_version
from tablebridge.sources.factory import open_source
from tablebridge.sources.splits import map_batches, with_splits
from tablebridge.streaming.deltas import stored_deltas, stream_deltas
from tablebridge.streaming.merged import MergedTarget, merge_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def named(name: str) -> Callable[[Query], Query]:
    """Register under a name that an operator already has here."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def source(spark: SparkSession, folder: str):
    return open_source(spark, "parquet", {"folder": folder})


# ---- payload helpers ------------------------------------------------------


def condition(column: str, operator: str, value: Any = None, value_to: Any = None) -> dict:
    return {"column": {"name": column}, "operator": operator, "value": value, "valueTo": value_to}


def field(table: str, name: str, alias: str = "", kind: str = "string") -> dict:
    return {"table": table, "field": name, "alias": alias, "selectType": "NORMAL", "type": kind}


def measure(aggregate: str, alias: str, table: str = "", name: str = "") -> dict:
    return {
        "table": table,
        "field": name,
        "alias": alias,
        "selectType": "AGGREGATE",
        "aggregate": aggregate,
        "isCountAll": aggregate == "COUNT(*)",
    }


def join(target: str, *conditions: tuple, kind: str = "INNER") -> dict:
    entries = []
    for source_field, operator, target_field, *connector in conditions:
        entry = {"sourceField": source_field, "operator": operator, "targetField": target_field}
        if connector:
            entry["connector"] = connector[0]
        entries.append(entry)
    return {"joinType": kind, "targetTable": target, "conditions": entries}


def where(table: str, name: str, operator: str, value: Any, kind: str, **more: Any) -> dict:
    return {
        "table": table,
        "field": name,
        "operator": operator,
        "value": value,
        "valueType": kind,
        **more,
    }


def having(aggregate: str, operator: str, value: Any, table="", name="", **more: Any) -> dict:
    return {
        "table": table,
        "field": name,
        "isAggregation": True,
        "aggregate": aggregate,
        "isCountAll": aggregate == "COUNT(*)",
        "operator": operator,
        "value": value,
        "valueType": "number",
        **more,
    }


def filtered(name: str, table: str, columns: list[str], *conditions: dict) -> None:
    """Register a query that applies a filter payload to a table."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = filter_rows(source(spark, folder).table(table), list(conditions))
        return rows.select(columns)

    QUERIES[name] = run


def specified(name: str, spec: dict, tables: Callable | None = None, invert: bool = False) -> None:
    """Register a query that runs a spec."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        origin = source(spark, folder)
        if tables is None:
            return origin.query(spec, invert)
        return run_spec(spec, {**tables(origin)}, invert)

    QUERIES[name] = run


# ---- derived inputs -------------------------------------------------------


def balances(origin) -> dict[str, DataFrame]:
    """Customers whose negative balance is null."""
    customer = origin.table("customer")
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    return {"customer": customer.withColumn("bal", balance)}


def document_lists(origin) -> dict[str, DataFrame]:
    """Documents with two arrays: pieces of the source, and the text's lines."""
    documents = origin.table("documents")
    return {
        "documents": documents.withColumn("parts", F.split("source", "c")).withColumn(
            "lines", F.split("text", "\n")
        )
    }


def pick(values: tuple[str, ...], number) -> Any:
    """The entry of a fixed list that a number points at."""
    place = (number % len(values) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(value) for value in values]), place)


# ---- sources and paging ---------------------------------------------------


@query
def scan_full(spark, folder):
    return source(spark, folder).scan("supplier")


@query
def scan_split_counts(spark, folder):
    rows = with_splits(source(spark, folder).table("orders"), "o_orderkey", 4)
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query
def scan_batches(spark, folder):
    """Rows and keys seen by batch consumers inside the tasks."""
    rows = source(spark, folder).table("lineitem").select("l_orderkey")

    def summary(batch):
        return batch.agg({"l_orderkey": ["count", "sum"]}).T.rename(
            columns={"count": "n", "sum": "keys"}
        )

    seen = map_batches(rows, summary, "n bigint, keys bigint")
    return seen.agg(F.sum("n").alias("n"), F.sum("keys").alias("keys"))


@query
def page_filtered_text(spark, folder):
    filters = '[{"column": {"name": "o_orderstatus"}, "operator": "equals", "value": "F"}]'
    return source(spark, folder).page_text("orders", "o_orderkey", 100, 50, filters)


@query
def page_raw(spark, folder):
    return source(spark, folder).page("orders", "o_orderkey", 100, 50)


@query
def page_deep(spark, folder):
    """A page from a numbered copy of the table."""
    copy = number_rows(source(spark, folder).table("orders"), "o_orderkey")
    return read_page(spark, copy, 12_000, 50)


@query
def page_next(spark, folder):
    """The page after a key, without an offset."""
    orders = source(spark, folder).table("orders")
    return next_page(orders, ["o_custkey", "o_orderkey"], [700, 0], 50)


@query
def page_walk(spark, folder):
    """All pages of a nullable order, after the last key and by offset across the switch."""
    customer = source(spark, folder).table("customer")
    rows = customer.select(F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("nation"), "c_custkey")
    names, size = ["nation", "c_custkey"], rows.count() // 8 + 1
    copy = number_rows(rows, names)
    pages, after = [], None
    for number in range(8):
        pages.append(page(rows, names, number * size, size, top_k_rows=4 * size, copy=copy).withColumn("how", F.lit("offset")))
        found = next_page(rows, names, after, size)
        last = found.orderBy(*[F.col(name).desc() for name in names]).first()
        if last is not None:
            after = list(last)
            pages.append(found.withColumn("how", F.lit("after")))
    return reduce(lambda a, b: a.unionByName(b), pages)


@query
def page_walk_filtered(spark, folder):
    """All pages of the rows that pass a filter, by offset across the switch to a copy of them."""
    orders = source(spark, folder).table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    filters = [{"column": {"name": "o_orderstatus"}, "operator": "IN", "value": "F, P"}]
    size = filter_rows(orders, filters).count() // 6 + 1
    copy = number_rows(orders, ["o_custkey", "o_orderkey"], filters=filters)
    pages = [
        page(orders, ["o_custkey", "o_orderkey"], number * size, size, filters, top_k_rows=3 * size, copy=copy).withColumn("page", F.lit(number))
        for number in range(6)
    ]
    return reduce(lambda a, b: a.unionByName(b), pages)


@query
def reload_versions(spark, folder):
    """Three loads of one table: what it held after each, after going back to the first, and what was left to expire."""
    orders = source(spark, folder).table("orders").select("o_orderkey", "o_orderstatus")
    path = scratch_path(spark, "versions")
    columns = [{"name": "o_orderkey", "type": "BIGINT"}, {"name": "o_orderstatus", "type": "TEXT"}]
    table = create_table(spark, path.rsplit("/", 1)[1].replace("-", "_"), columns, path)
    for status in ("F", "O", "P"):
        reload_table(orders.where(F.col("o_orderstatus") == status), table)
    loads = manifest(spark, table).where("version > 0").orderBy("version").collect()
    restore_version(spark, table, 1)
    restored = location(spark, table)
    spark.sql(f"DROP TABLE {table}")
    seen = [spark.read.schema(orders.schema).parquet(load["path"]).withColumn("step", F.lit(load["version"])) for load in loads]
    seen.append(spark.read.schema(orders.schema).parquet(restored).withColumn("step", F.lit(4)))
    together = reduce(lambda a, b: a.unionByName(b), seen)
    return together.groupBy("step", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query
def preview(spark, folder):
    statement = "SELECT o_orderstatus, count(*) AS n FROM {orders} GROUP BY o_orderstatus;"
    return source(spark, folder).preview(statement, 100)


@query
def count_filtered(spark, folder):
    return source(spark, folder).count_rows(
        "orders", [condition("o_orderstatus", "=", "F"), condition("o_totalprice", ">", 250000)]
    )


@query
def min_max_date(spark, folder):
    return source(spark, folder).min_max("orders", "o_orderdate")


# ---- filter payloads ------------------------------------------------------

_PART = ["p_partkey", "p_name"]
_RED_BLUE = "^(red|blue) .*t$"
filtered("f_contains", "part", _PART, condition("p_name", "CONTAINS", "ring"))
filtered("f_not_contains", "part", _PART, condition("p_name", "NOT_CONTAINS", "ring"))
filtered("f_starts_with", "part", _PART, condition("p_name", "starts with", "red"))
filtered("f_ends_with", "part", _PART, condition("p_name", "ENDS_WITH", "bolt"))
filtered("f_contains_wildcard", "part", _PART, condition("p_name", "CONTAINS", "r_d"))
filtered("f_matches", "part", _PART, condition("p_name", "MATCHES", _RED_BLUE))
filtered("f_not_matches", "part", _PART, condition("p_name", "NOT_MATCHES", _RED_BLUE))
filtered(
    "f_matches_class", "part", _PART, condition("p_name", "MATCHES", "^[[:lower:]]{3} [^[:space:]]+t$")
)
filtered(
    "f_matches_lines",
    "documents",
    ["doc_id"],
    condition("text", "MATCHES", "[.].[[:upper:]][a-z]+.$"),
)
filtered("f_eq", "orders", ["o_orderkey"], condition("o_orderpriority", "EQUALS", "1-URGENT"))
filtered("f_ne", "orders", ["o_orderkey"], condition("o_orderpriority", "!=", "1-URGENT"))
filtered("f_gt", "orders", ["o_orderkey"], condition("o_totalprice", "GREATER_THAN", "400000"))
filtered("f_lt", "orders", ["o_orderkey"], condition("o_totalprice", "<", 50000))
filtered("f_ge", "part", ["p_partkey"], condition("p_size", "GREATER_THAN_OR_EQUAL", "40"))
filtered("f_le", "part", ["p_partkey"], condition("p_size", "<=", 5))
filtered("f_between", "part", ["p_partkey", "p_size"], condition("p_size", "BETWEEN", "10", "20"))
filtered(
    "f_not_between", "part", ["p_partkey", "p_size"], condition("p_size", "NOT BETWEEN", 10, 20)
)
filtered(
    "f_in",
    "customer",
    ["c_custkey", "c_mktsegment"],
    condition("c_mktsegment", "IN", "BUILDING, MACHINERY"),
)
filtered(
    "f_not_in",
    "customer",
    ["c_custkey", "c_mktsegment"],
    condition("c_mktsegment", "NOT_IN", ["BUILDING", "MACHINERY"]),
)
filtered(
    "f_skip_invalid",
    "part",
    ["p_partkey"],
    condition("p_size", ">", 45),
    condition("p_size; DROP", "=", 1),
    condition("p_size", "ALMOST", 1),
    condition("p_size", "BETWEEN", 1),
    condition("p_size", "IN", " , "),
    condition("p_size", "=", None),
)


@query
def f_is_null(spark, folder):
    rows = balances(source(spark, folder))["customer"]
    return filter_rows(rows, [condition("bal", "IS_NULL")]).select("c_custkey")


@query
def f_is_not_null(spark, folder):
    rows = balances(source(spark, folder))["customer"]
    return filter_rows(rows, [condition("bal", "is not null")]).select("c_custkey")


# ---- query specs: select and where ----------------------------------------

specified("sel_star", {"baseTable": "customer"})
specified(
    "sel_alias",
    {
        "baseTable": "customer",
        "selectedFields": [
            field("customer", "c_custkey", " customer id "),
            field("", "c_name", "full name"),
        ],
    },
)
specified(
    "sel_array_text",
    {
        "baseTable": "documents",
        "selectedFields": [
            field("documents", "doc_id"),
            field("documents", "parts", kind="list"),
            field("documents", "lines", kind="multiset"),
        ],
    },
    document_lists,
)
specified(
    "w_list_contains",
    {
        "baseTable": "documents",
        "selectedFields": [field("documents", "doc_id", "doc")],
        "whereConditions": [where("documents", "parts", "LIST CONTAINS", "7", "string")],
    },
    document_lists,
)
specified(
    "w_list_not_contains",
    {
        "baseTable": "documents",
        "selectedFields": [field("documents", "doc_id", "doc")],
        "whereConditions": [where("documents", "parts", "LIST NOT CONTAINS", "7", "string")],
    },
    document_lists,
)
specified(
    "w_and_or_precedence",
    {
        "baseTable": "orders",
        "selectedFields": [field("orders", "o_orderkey")],
        "whereConditions": [
            where("orders", "o_orderstatus", "=", "F", "string", connector="OR"),
            where("orders", "o_orderstatus", "=", "O", "string", connector="AND"),
            where("orders", "o_totalprice", ">", 400000, "number"),
        ],
    },
)
specified(
    "w_inverted",
    {
        "baseTable": "customer",
        "selectedFields": [field("customer", "c_custkey")],
        "whereConditions": [where("customer", "bal", ">", 5000, "number")],
    },
    balances,
    invert=True,
)
specified(
    "w_in_number",
    {
        "baseTable": "part",
        "selectedFields": [field("part", "p_partkey")],
        "whereConditions": [
            where("part", "p_size", "IN", "3, 5, 8", "number"),
            where("part", "p_brand", "NOT IN", ["Brand#1", "Brand#2"], "list"),
        ],
    },
)
specified(
    "w_like",
    {
        "baseTable": "part",
        "selectedFields": [field("part", "p_partkey")],
        "whereConditions": [
            where("part", "p_name", "ENDS WITH", "g", "string"),
            where("part", "p_brand", "STARTS WITH", "Brand", "string"),
            where("part", "p_brand", "NOT CONTAIN", "#1", "string", connector="OR"),
            where("part", "p_name", "CONTAINS", "et", "string"),
        ],
    },
)
specified(
    "w_regex",
    {
        "baseTable": "part",
        "selectedFields": [field("part", "p_partkey")],
        "whereConditions": [
            where("part", "p_brand", "MATCHES", "^Brand#[1-3]$", "string"),
            where("part", "p_name", "NOT MATCHES", "[gt]$", "string"),
        ],
    },
)
specified(
    "w_null",
    {
        "baseTable": "customer",
        "selectedFields": [field("customer", "c_custkey")],
        "whereConditions": [
            where("customer", "bal", "IS NULL", None, "number", connector="OR"),
            where("customer", "bal", "IS NOT NULL", None, "number"),
            where("customer", "c_nationkey", "<", 5, "number"),
        ],
    },
    balances,
)
specified(
    "w_dates",
    {
        "baseTable": "orders",
        "selectedFields": [field("orders", "o_orderkey")],
        "whereConditions": [
            where(
                "orders", "o_orderdate", "BETWEEN", "1996-02-01", "Date", secondValue="1996-04-30"
            ),
            where("orders", "o_orderdate", "!=", "1996-03-01 00:00:00", "Datetime"),
        ],
    },
)

_LINE_ORDER = [join("orders", ("l_orderkey", "=", "o_orderkey"))]
_LINE_KEYS = [
    field("lineitem", "l_orderkey"),
    field("lineitem", "l_linenumber"),
    field("lineitem", "l_partkey"),
]


def line_dates(operator: str, value: int, unit: str) -> dict:
    return {
        "baseTable": "lineitem",
        "selectedFields": _LINE_KEYS,
        "joins": _LINE_ORDER,
        "whereConditions": [
            {
                "table": "lineitem",
                "field": "l_shipdate",
                "comparisonType": "COLUMN",
                "targetTable": "orders",
                "targetField": "o_orderdate",
                "valueType": "Date",
                "dateUnit": unit,
                "operator": operator,
                "value": value,
            }
        ],
    }


specified("w_date_year_diff", line_dates(">=", 5, "YEAR"))
specified("w_date_month_diff", line_dates("=", 2, "MONTH"))
specified("w_date_day_diff", line_dates("=", 7, "DAY"))
specified(
    "w_column_compare",
    {
        "baseTable": "lineitem",
        "selectedFields": [
            field("lineitem", "l_orderkey"),
            field("lineitem", "l_linenumber"),
            field("lineitem", "l_shipdate"),
        ],
        "joins": _LINE_ORDER,
        "whereConditions": [
            {
                "table": "lineitem",
                "field": "l_shipdate",
                "comparisonType": "COLUMN",
                "compareOperator": "<",
                "targetTable": "orders",
                "targetField": "o_orderdate",
            }
        ],
    },
)
specified(
    "w_column_arith",
    {
        "baseTable": "orders",
        "selectedFields": [field("orders", "o_orderkey"), field("customer", "c_custkey")],
        "joins": [join("customer", ("o_custkey", "=", "c_custkey"))],
        "whereConditions": [
            {
                "table": "orders",
                "field": "o_totalprice",
                "comparisonType": "COLUMN",
                "compareOperator": "-",
                "targetTable": "customer",
                "targetField": "c_acctbal",
                "operator": ">",
                "value": 400000,
                "valueType": "number",
            }
        ],
    },
)

# ---- query specs: joins ---------------------------------------------------

specified(
    "j_inner",
    {
        "baseTable": "orders",
        "selectedFields": [field("orders", "o_orderkey"), field("customer", "c_name")],
        "joins": [join("customer", ("o_custkey", "=", "c_custkey"))],
    },
)
specified(
    "j_left",
    {
        "baseTable": "customer",
        "selectedFields": [field("customer", "c_custkey"), field("supplier", "s_suppkey")],
        "joins": [join("supplier", ("c_custkey", "=", "s_suppkey"), kind="LEFT")],
    },
)
specified(
    "j_right",
    {
        "baseTable": "supplier",
        "selectedFields": [field("supplier", "s_suppkey"), field("customer", "c_custkey")],
        "joins": [join("customer", ("s_suppkey", "=", "c_custkey"), kind="RIGHT")],
    },
)
specified(
    "j_theta",
    {
        "baseTable": "supplier",
        "selectedFields": [field("supplier", "s_suppkey"), field("nation", "n_nationkey")],
        "joins": [join("nation", ("s_nationkey", ">", "n_nationkey"))],
    },
)


def bands(spark: SparkSession, folder: str, how: str) -> DataFrame:
    """Events against orders whose key lies in a narrow band of the event's number."""
    origin = source(spark, folder)
    number = F.col("event_id")
    spans = origin.table("events").select(
        number.alias("e.id"),
        (number * 3).alias("e.low"),
        F.when(number % 7 != 0, number * 3 + 2).alias("e.high"),
    )
    orders = origin.table("orders").select(F.col("o_orderkey").alias("o.key"))
    group = [("e.low", "<=", "o.key"), ("e.high", ">=", "o.key")]
    found = join_frames(spans, orders, how, [group])
    return found.select(F.col("`e.id`").alias("event_id"), F.col("`o.key`").alias("o_orderkey"))


@query
def j_theta_large(spark, folder):
    """A band between two tables that are too large for a nested loop."""
    return bands(spark, folder, "inner")


@query
def j_theta_left(spark, folder):
    """The band again, with the events that no order meets."""
    return bands(spark, folder, "left")


@query
def j_theta_mixed(spark, folder):
    """A band whose bounds are text and whose values are numbers."""
    origin = source(spark, folder)
    lines = origin.table("lineitem").select(F.col("l_orderkey").alias("l.key"))
    orders = origin.table("orders").select(
        F.col("o_orderkey").alias("o.key"),
        F.col("o_orderkey").cast("string").alias("o.low"),
        (F.col("o_orderkey") + 1).cast("string").alias("o.high"),
    )
    group = [("l.key", ">=", "o.low"), ("l.key", "<", "o.high")]
    found = join_frames(lines, orders, "inner", [group])
    return found.select(F.col("`o.key`").alias("o_orderkey"), F.col("`l.key`").alias("l_orderkey"))


specified(
    "j_compound_and",
    {
        "baseTable": "orders",
        "selectedFields": [
            field("orders", "o_orderkey"),
            field("lineitem", "l_linenumber"),
            field("lineitem", "l_partkey"),
        ],
        "joins": [
            join(
                "lineitem", ("o_orderkey", "=", "l_orderkey"), ("o_orderdate", "<", "l_shipdate")
            )
        ],
    },
)
specified(
    "j_compound_or",
    {
        "baseTable": "orders",
        "selectedFields": [field("orders", "o_orderkey"), field("customer", "c_custkey")],
        "joins": [
            join(
                "customer",
                ("o_custkey", "=", "c_custkey", "OR"),
                ("o_orderkey", "=", "c_custkey"),
            )
        ],
    },
)
specified(
    "j_left_or",
    {
        "baseTable": "orders",
        "selectedFields": [field("orders", "o_orderkey"), field("supplier", "s_suppkey")],
        "joins": [
            join(
                "supplier",
                ("o_custkey", "=", "s_suppkey", "OR"),
                ("o_orderkey", "=", "s_suppkey"),
                kind="LEFT",
            )
        ],
    },
)
specified(
    "j_right_chain",
    {
        "baseTable": "lineitem",
        "selectedFields": [
            field("part", "p_brand"),
            measure("COUNT", "lines", "lineitem", "l_orderkey"),
            measure("COUNT(DISTINCT)", "buyers", "orders", "o_custkey"),
        ],
        "joins": [*_LINE_ORDER, join("part", ("l_partkey", "=", "p_partkey"), kind="RIGHT")],
        "groupByFields": [{"table": "part", "field": "p_brand"}],
    },
)
specified(
    "j_star",
    {
        "baseTable": "lineitem",
        "selectedFields": [
            *_LINE_KEYS,
            field("orders", "o_orderpriority"),
            field("supplier", "s_name"),
        ],
        "joins": [*_LINE_ORDER, join("supplier", ("l_partkey", "=", "s_suppkey"), kind="LEFT")],
        "whereConditions": [where("lineitem", "l_quantity", ">", 45, "number")],
    },
)

# ---- query specs: aggregates ----------------------------------------------


def grouped(table: str, key: str, *measures: dict, **more: Any) -> dict:
    return {
        "baseTable": table,
        "selectedFields": [field(table, key), *measures],
        "groupByFields": [{"table": table, "field": key}, {"table": table}],
        **more,
    }


specified(
    "a_count_col",
    grouped("customer", "c_mktsegment", measure("COUNT", "n", "customer", "bal")),
    balances,
)
specified("a_count_all", grouped("orders", "o_orderstatus", measure("COUNT(*)", "n")))
specified(
    "a_count_distinct",
    grouped("orders", "o_orderstatus", measure("COUNT(DISTINCT)", "n", "orders", "o_custkey")),
)
specified(
    "a_distinct",
    {
        "baseTable": "orders",
        "selectedFields": [
            measure("DISTINCT", "", "orders", "o_orderstatus"),
            field("orders", "o_orderpriority"),
        ],
    },
)
specified(
    "a_min_max",
    grouped(
        "orders",
        "o_orderpriority",
        measure("MIN", "lo", "orders", "o_totalprice"),
        measure("MAX", "hi", "orders", "o_orderdate"),
    ),
)
specified(
    "a_global_having",
    {
        "baseTable": "orders",
        "selectedFields": [measure("COUNT(*)", "n")],
        "having": [
            having("COUNT(*)", ">", 10, connector="AND"),
            having("MAX", ">", 1000, "orders", "o_totalprice"),
        ],
    },
)
specified(
    "a_having_hidden",
    grouped(
        "orders",
        "o_custkey",
        having=[
            having("COUNT(*)", ">", 15, connector="AND"),
            having("SUM", ">", 4000000, "orders", "o_totalprice"),
        ],
    ),
)
specified(
    "a_having_count_distinct",
    grouped(
        "orders",
        "o_custkey",
        measure("COUNT(*)", "n"),
        having=[
            having("COUNT(DISTINCT)", ">=", 5, "orders", "o_orderpriority", connector="OR"),
            having("COUNT(*)", "BETWEEN", 1, secondValue=3),
        ],
    ),
)


@query
def a_sum(spark, folder):
    spec = grouped("orders", "o_orderpriority", measure("SUM", "total", "orders", "o_totalprice"))
    rows = source(spark, folder).query(spec)
    return rows.withColumn("total", F.round("total", 2))


@query
def a_avg(spark, folder):
    spec = grouped("orders", "o_orderpriority", measure("AVG", "mean", "orders", "o_totalprice"))
    rows = source(spark, folder).query(spec)
    return rows.withColumn("mean", F.round("mean", 4))


@query
def a_global(spark, folder):
    spec = {
        "baseTable": "lineitem",
        "selectedFields": [
            measure("COUNT(*)", "n"),
            measure("SUM", "qty", "lineitem", "l_quantity"),
        ],
    }
    return source(spark, folder).query(spec).withColumn("qty", F.round("qty", 2))


FLAGSHIP = {
    "baseTable": "lineitem",
    "selectedFields": [
        field("part", "p_brand"),
        measure("COUNT(*)", "n"),
        measure("COUNT(DISTINCT)", "buyers", "orders", "o_custkey"),
        measure("SUM", "revenue", "lineitem", "l_extendedprice"),
    ],
    "joins": [
        join("orders", ("l_orderkey", "=", "o_orderkey")),
        join("part", ("l_partkey", "=", "p_partkey")),
    ],
    "whereConditions": [
        where("orders", "o_orderstatus", "=", "F", "string", connector="AND"),
        where("part", "p_size", "BETWEEN", 5, "number", secondValue=40),
    ],
    "groupByFields": [{"table": "part", "field": "p_brand"}],
}


def flagship(spark: SparkSession, folder: str, more_than: int) -> DataFrame:
    """Brands by orders and buyers, where a brand has enough line items."""
    spec = {**FLAGSHIP, "having": [having("COUNT(*)", ">", more_than)]}
    rows = source(spark, folder).query(spec)
    return rows.withColumn("revenue", F.round("revenue", 2))


@query
def flagship_spec(spark, folder):
    return flagship(spark, folder, 100)


# ---- change data capture --------------------------------------------------


@query
def delta_latest(spark, folder):
    return latest_changes(source(spark, folder).table("events"), "user_id", "2024-01-29", ts="ts")


@query
def delta_composite(spark, folder):
    events = source(spark, folder).table("events")
    return latest_changes(events, ["user_id", "event_type"], "2024-01-15", ts="ts")


@query
def delta_ties(spark, folder):
    log = source(spark, folder).table("events").select(
        "event_id", "user_id", "event_type", F.to_date("ts").alias("op_date")
    )
    return latest_changes(log, ["user_id"], "2024-01-15", ts="op_date", ties="all")


@named("delta_page")
def delta_page_rows(spark, folder):
    events = source(spark, folder).table("events")
    return delta_page(events, "user_id", "2024-01-15", 40, 20, ts="ts")


@query
def delta_snapshot_page(spark, folder):
    """A page of changes from a stored snapshot."""
    events = source(spark, folder).table("events")
    snapshot = delta_snapshot(events, "user_id", "2024-01-15", ts="ts")
    return read_page(spark, snapshot, 40, 20)


@query
def delta_stream(spark, folder):
    origin = source(spark, folder)
    target, checkpoint = scratch_path(spark, "deltas"), scratch_path(spark, "offsets")
    stream = origin.stream("events", maxFilesPerTrigger="1000")
    running = stream_deltas(stream, "user_id", "2024-01-15", target, checkpoint, ts="ts")
    running.awaitTermination()
    return stored_deltas(spark, target, "user_id", stream.schema)


@query
def delta_merged(spark, folder):
    """Changes merged by bucket, some late and some as a stream, with errors as deletes."""
    origin = source(spark, folder)
    events = origin.table("events")
    target = MergedTarget(spark, scratch_path(spark, "merged"), "user_id", events.schema, "ts", F.col("event_type") == "error", buckets=8)
    target.merge(events.where("event_id % 3 = 2"), 0)
    target.merge(events.where("event_id % 3 = 1"), 1)
    # The stream's first batch has number 0: a target of its own takes it.
    whole = MergedTarget(spark, scratch_path(spark, "streamed"), "user_id", events.schema, "ts", F.col("event_type") == "error", buckets=8)
    merge_stream(origin.stream("events", maxFilesPerTrigger="1000"), whole, scratch_path(spark, "offsets"), "2024-01-15").awaitTermination()
    return target.read().withColumn("how", F.lit("late")).unionByName(whole.read().withColumn("how", F.lit("stream")))


# ---- targets --------------------------------------------------------------


def _label_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query
def part_range_year(spark, folder):
    orders, path = source(spark, folder).table("orders"), scratch_path(spark, "year")
    schema = write_target(orders, path, "o_orderdate", "RANGE", "year", ["1996", "1997"])
    return _label_counts(read_partitioned(spark, path, schema))


@query
def part_range_month(spark, folder):
    orders, path = source(spark, folder).table("orders"), scratch_path(spark, "month")
    schema = write_target(orders, path, "o_orderdate", "RANGE", "month", ["1996-12", "1997-01"])
    return _label_counts(read_partitioned(spark, path, schema))


@query
def part_list(spark, folder):
    orders, path = source(spark, folder).table("orders"), scratch_path(spark, "list")
    schema = write_target(orders, path, "o_orderstatus", "LIST", values=["F", "O"])
    return _label_counts(read_partitioned(spark, path, schema))


@query
def part_list_odd(spark, folder):
    """Listed values whose labels would be the same, one of them named as the default."""
    status = F.col("o_orderstatus")
    odd = F.when(status == "F", "a-b").when(status == "O", "a_b").otherwise("default")
    orders = source(spark, folder).table("orders")
    rows = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, odd).alias("odd"))
    path = scratch_path(spark, "odd")
    schema = write_target(rows, path, "odd", "LIST", values=["a-b", "a_b", "default"])
    return read_partitioned(spark, path, schema).select("o_orderkey", "odd", "part")


@query
def part_range_read(spark, folder):
    """A date range read from its own partitions only."""
    orders, path = source(spark, folder).table("orders"), scratch_path(spark, "read")
    years = ["1996", "1997"]
    schema = write_target(orders, path, "o_orderdate", "RANGE", "year", years)
    stored = read_partitioned(spark, path, schema)
    found = in_dates(stored, "o_orderdate", "year", years, "1996-11-15", "1997-02-01")
    return found.select("o_orderkey", "o_orderdate")


@query
def part_hash_roundtrip(spark, folder):
    orders = source(spark, folder).table("orders").select("o_orderkey", "o_custkey")
    path = scratch_path(spark, "hash")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    write_target(orders, path, "o_custkey", "HASH", table=table, buckets=8)
    return spark.table(table)


@named("key_violations")
def key_violations_lineitem(spark, folder):
    return key_violations(source(spark, folder).table("lineitem"), ["l_orderkey", "l_linenumber"])


@named("load_violations")
def load_violations_events(spark, folder):
    """Event numbers as a load against the keys of the orders."""
    origin = source(spark, folder)
    batch = origin.table("events").select((F.floor(F.col("event_id") * 1.5)).alias("number"), "event_type")
    return load_violations(batch, origin.table("orders").select(F.col("o_orderkey").alias("number")), "number")


@query
def unique_index_violations(spark, folder):
    layout = plan_layout([{"columns": ["c_mktsegment", "c_nationkey"], "unique": True}])
    return unique_violations(source(spark, folder).table("customer"), layout)[0]


@named("column_stats")
def column_stats_orders(spark, folder):
    return column_stats(source(spark, folder).table("orders"))


@query
def column_stats_loads(spark, folder):
    """Statistics of orders that came in three loads, merged from the sketches of each."""
    orders = source(spark, folder).table("orders")
    kept = ColumnSketches(spark, scratch_path(spark, "sketches"))
    for status in ("F", "O", "P"):
        kept.add("orders", status, orders.where(F.col("o_orderstatus") == status))
    found = kept.stats("orders", orders.schema)
    exact = column_stats(orders).select("column_name", F.col("distincts").alias("exact"))
    middle = orders.agg(F.percentile("o_totalprice", F.lit(0.5))).first()[0]
    near = found.join(exact, "column_name")
    # What sketches estimate is given as whether it lies within five percent.
    return near.select(
        "column_name",
        "rows",
        "nulls",
        "lo",
        "hi",
        (F.abs(F.col("distincts") - F.col("exact")) <= 1 + 0.05 * F.col("exact")).alias("distincts_near"),
        F.when(F.col("column_name") == "o_totalprice", F.abs(F.col("quantiles")[1] / middle - 1) < 0.05).alias("middle_near"),
    )


def _read_share(spark: SparkSession, path: str, value: Column) -> float:
    """The share of a table's rows that a lookup of one value reads, by the ends of its files; the mean of five lookups."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), value.alias("value"))
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()  # one row per file
    looked = rows.agg(F.percentile_approx("value", [0.1, 0.3, 0.5, 0.7, 0.9])).first()[0]
    read = sum(f["n"] for f in files for v in looked if f["lo"] <= v <= f["hi"])
    return read / len(looked) / sum(f["n"] for f in files)


@query
def layout_curve(spark, folder):
    """Orders by their date alone, and by a curve over date and customer: whether a lookup by either column reads under half of the rows."""
    orders = source(spark, folder).table("orders")
    indexes = per_column(["o_orderdate", "o_custkey"])
    day = F.unix_date(F.col("o_orderdate").cast("date"))
    per_file = orders.count() // 24 + 1
    parts = []
    for kind in ("sorted", "curve"):
        path = scratch_path(spark, kind)
        write_layout(orders, path, plan_layout(indexes, curve=kind == "curve"), per_file)
        by_date, by_customer = (_read_share(spark, path, value) < 0.5 for value in (day, F.col("o_custkey")))
        counted = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))
        parts.append(counted.select(F.lit(kind).alias("layout"), "n", "keys", F.lit(by_date).alias("by_date"), F.lit(by_customer).alias("by_customer")))
    return parts[0].unionByName(parts[1])


@query
def layout_roundtrip(spark, folder):
    layout = plan_layout(
        [
            {"columns": ["o_orderkey"], "unique": True, "primary": True},
            {"columns": ["o_orderdate", "o_custkey"], "unique": False, "primary": False},
            {"columns": ["o_orderpriority"], "unique": False, "primary": False},
        ]
    )
    path = scratch_path(spark, "layout")
    write_layout(source(spark, folder).table("orders"), path, layout)
    return spark.read.parquet(path)


@query
def layout_order(spark, folder):
    """Rows out of order inside their files, and files whose keys overlap: none."""
    layout = plan_layout([{"columns": ["o_orderdate", "o_custkey"]}])
    path = scratch_path(spark, "ordered")
    write_layout(source(spark, folder).table("orders"), path, layout)
    rows = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("place"),
        F.struct("o_orderdate", "o_custkey").alias("key"),
    )
    before = F.lag("key").over(Window.partitionBy("file").orderBy("place"))
    files = rows.withColumn("wrong", F.coalesce(before > F.col("key"), F.lit(False)).cast("long"))
    files = files.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.sum("wrong").alias("wrong"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    # One row per file.
    earlier = F.lag("high").over(Window.orderBy("low", "high"))
    ends = files.withColumn("overlap", F.coalesce(earlier > F.col("low"), F.lit(False)).cast("long"))
    return ends.agg(
        F.sum("n").alias("n"), F.sum("wrong").alias("out_of_order"), F.sum("overlap").alias("overlaps")
    )


@query
def reload_roundtrip(spark, folder):
    return reload_files(source(spark, folder).scan("customer"), scratch_path(spark, "reload"))


@query
def truncate_and_reload(spark, folder):
    """A filled table, emptied, filled again and reloaded with other rows."""
    customer = source(spark, folder).table("customer").select("c_custkey", "c_name")
    path = scratch_path(spark, "filled")
    columns = [{"name": "c_custkey", "type": "BIGINT"}, {"name": "c_name", "type": "TEXT"}]
    table = create_table(spark, path.rsplit("/", 1)[1].replace("-", "_"), columns, path)
    insert_rows(customer, table)
    truncate_table(spark, table)
    emptied = spark.table(table).count()
    insert_rows(customer, table)
    reload_table(customer.where("c_custkey % 2 = 0"), table)
    loaded = location(spark, table)
    spark.sql(f"DROP TABLE {table}")
    stored = spark.read.schema(customer.schema).parquet(loaded)
    return stored.withColumn("left_after_truncate", F.lit(emptied))


@query
def create_table_insert(spark, folder):
    columns = [
        {"name": "id", "type": "BIGINT", "nullable": "NO", "default": None},
        {"name": "name", "type": "VARCHAR", "length": 50, "nullable": "YES", "default": ""},
        {"name": "note", "type": "TEXT", "nullable": "YES", "default": "'n/a'::text"},
    ]
    path = scratch_path(spark, "target")
    table = create_table(spark, path.rsplit("/", 1)[1].replace("-", "_"), columns, path)
    customer = source(spark, folder).table("customer")
    named = customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    insert_rows(named, table)
    return spark.table(table)


# ---- schemas and types ----------------------------------------------------


def order_texts(origin) -> DataFrame:
    """Orders as text columns, one for each kind of type to find."""
    orders = origin.table("orders").withColumn("d", F.to_date("o_orderdate"))
    return stringify(orders).select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        "d",
        (F.col("o_orderkey").cast("bigint") * 1000000).cast("string").alias("big"),
        F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("n").alias("flag"),
        F.lit(" ").alias("blank"),
    )


@named("infer_types")
def infer_order_types(spark, folder):
    return infer_types(order_texts(source(spark, folder)))


@query
def infer_document_types(spark, folder):
    """Types of whole texts and their derived columns."""
    return infer_types(source(spark, folder).table("documents"))


@named("apply_types")
def apply_order_types(spark, folder):
    texts = order_texts(source(spark, folder)).select("o_orderkey", F.col("d").alias("o_orderdate"))
    return apply_types(texts, {"o_orderkey": "INTEGER", "o_orderdate": "DATE"})


@named("rejected_values")
def rejected_order_values(spark, folder):
    texts = order_texts(source(spark, folder))
    return rejected_values(
        texts, {"o_orderkey": "INTEGER", "o_orderstatus": "INTEGER", "big": "INTEGER", "d": "DATE"}
    )


@named("stringify")
def stringify_events(spark, folder):
    return stringify(source(spark, folder).table("events"))


@query
def stringify_lists(spark, folder):
    """Lists as text, over whole documents."""
    rows = document_lists(source(spark, folder))["documents"]
    return stringify(rows.select("doc_id", "parts", "lines"))


@query
def apply_inferred_orders(spark, folder):
    """Text columns converted to the types found in them."""
    texts = order_texts(source(spark, folder)).select(
        "o_orderkey", "o_orderstatus", "d", "big", "flag"
    )
    return apply_inferred(texts)


@query
def apply_inferred_rejects(spark, folder):
    """Whole texts with columns that look typed but do not convert whole: they stay text."""
    documents = source(spark, folder).table("documents")
    number = F.col("doc_id")
    texts = documents.select(
        F.col("doc_id").cast("string").alias("id"),
        "text",
        F.concat(F.lit("1234567890123"), F.lpad(number.cast("string"), 9, "0")).alias("large"),
        F.when(number % 2 == 0, "13/02/2024").otherwise("02/13/2024").alias("day"),
        F.concat(F.col("n_chars").cast("string"), F.lit(".1234567890123456789012")).alias("fine"),
    )
    return apply_inferred(texts)


@query
def bytes_as_text(spark, folder):
    """Binary columns as text, over whole documents."""
    documents = source(spark, folder).table("documents")
    return stringify(documents.select("doc_id", F.col("text").cast("binary").alias("body")))


@named("dedupe_columns")
def dedupe_customer_columns(spark, folder):
    customer = source(spark, folder).table("customer")
    doubled = customer.select(
        "c_custkey",
        "c_name",
        F.col("c_nationkey").alias("C_NAME"),
        F.col("c_name").alias("C_Custkey"),
    )
    return dedupe_columns(doubled)


@query
def list_tables(spark, folder):
    """Every table of the source with its row count."""
    origin = source(spark, folder)
    found = [row["table_name"] for row in origin.table_names().collect()]
    counts = [
        origin.count_rows(name).select(F.lit(name).alias("table_name"), "n")
        for name in sorted(found)
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


@query
def describe_columns(spark, folder):
    origin = source(spark, folder)
    return measured_columns(
        {row["table_name"]: origin.table(row["table_name"]) for row in origin.table_names().collect()}
    )


@query
def schema_sqlserver(spark, folder):
    """SQL Server catalog rows derived from parts, converted."""
    part, key = source(spark, folder).table("part"), F.col("p_partkey")
    rows = part.select(
        F.col("p_brand").alias("table_name"),
        key.cast("int").alias("column_id"),
        F.when(key % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("name"),
        pick(SQLSERVER_NAMES, key).alias("data_type"),
        F.when(F.col("p_size") % 5 == 0, -1).otherwise(F.col("p_size")).alias("max_length"),
        F.when(key % 3 == 0, "NO").otherwise("YES").alias("is_nullable"),
        F.when(key % 4 == 0, "((0))").alias("default_value"),
        F.lit("NO").alias("is_primary_key"),
        F.lit("NO").alias("is_foreign_key"),
        F.lit("NO").alias("is_indexed"),
    )
    return convert_catalog(rows, "sqlserver").select(
        "table_name", "position", "name", "type", "length", "nullable", "default"
    )


@query
def schema_informix(spark, folder):
    """Informix catalog rows derived from orders, converted."""
    orders, key = source(spark, folder).table("orders"), F.col("o_orderkey")
    rows = orders.select(
        F.col("o_orderpriority").alias("table_name"),
        key.cast("int").alias("ordinal_position"),
        F.concat(F.lit("c"), key.cast("string")).alias("colname"),
        (key % 4201).cast("int").alias("coltype"),
        F.length("o_orderpriority").alias("collength"),
        F.lit(None).cast("string").alias("default_value"),
        F.lit("NO").alias("is_primary_key"),
        F.lit("NO").alias("is_foreign_key"),
        F.lit("NO").alias("is_index"),
    )
    return convert_catalog(rows, "informix").select(
        "table_name", "position", "name", "type", "nullable"
    )


@query
def schema_postgres(spark, folder):
    """PostgreSQL catalog rows derived from parts, converted."""
    part, key = source(spark, folder).table("part"), F.col("p_partkey")
    rows = part.select(
        F.col("p_brand").alias("table_name"),
        key.cast("int").alias("position"),
        F.col("p_name").alias("name"),
        F.concat(pick(POSTGRES_DECLARED, key), F.col("p_size").cast("string"), F.lit(")")).alias(
            "data_type"
        ),
        F.lit(-1).alias("max_length"),
        F.when(key % 3 == 0, "NO").otherwise("YES").alias("is_nullable"),
        F.when(key % 2 == 0, F.concat(F.lit("'"), F.col("p_type"), F.lit("'::text"))).alias(
            "default_value"
        ),
        F.lit("NO").alias("is_primary_key"),
        F.lit("NO").alias("is_foreign_key"),
        F.lit("NO").alias("is_index"),
    )
    return convert_catalog(rows, "postgres").select(
        "table_name", "position", "name", "type", "nullable", "default"
    )


@named("view_columns")
def view_column_types(spark, folder):
    """View columns derived from parts."""
    part, key = source(spark, folder).table("part"), F.col("p_partkey")
    declared = pick(POSTGRES_DECLARED, key)
    return view_columns(
        part.select(
            F.concat(F.col("p_name"), key.cast("string")).alias("name"),
            F.concat(declared, F.col("p_size").cast("string"), F.lit(")")).alias("data_type"),
        )
    )


@query
def api_types(spark, folder):
    """Types of all dialects, derived from orders."""
    orders = source(spark, folder).table("orders")
    key = F.col("o_orderkey")
    number = F.floor(key / 3)
    dialect = pick(names.DIALECTS, key)
    native = (
        F.when(dialect == "informix", (number % 4201).cast("string"))
        .when(dialect == "postgres", pick(POSTGRES_NAMES, number))
        .otherwise(pick(SQLSERVER_NAMES, number))
    )
    rows = orders.select(key, dialect.alias("dialect"), native.alias("type"))
    return rows.withColumn("api_type", names.api_type_by_dialect(F.col("dialect"), F.col("type")))


# Type names for the derived catalogs, with some that no table knows.
# Type names of the catalogs, known and unknown ones.
SQLSERVER_NAMES = (
    "int", "bigint", "smallint", "tinyint", "decimal", "numeric", "money", "smallmoney",
    "float", "real", "bit", "char", "nchar", "varchar", "nvarchar", "text", "ntext", "sysname",
    "xml", "binary", "varbinary", "image", "rowversion", "timestamp", "uniqueidentifier",
    "sql_variant", "date", "time", "datetime", "smalldatetime", "datetime2", "datetimeoffset",
    "geometry", "geography", "hierarchyid", "VARCHAR", "cursor",
)
POSTGRES_NAMES = (
    "smallint", "integer", "bigint", "numeric", "decimal", "real", "double precision",
    "smallserial", "serial", "bigserial", "money", "character varying", "varchar", "character",
    "char", "text", "citext", "boolean", "bool", "date", "time", "time without time zone",
    "time with time zone", "timestamp", "timestamp without time zone", "timestamp with time zone",
    "interval", "json", "jsonb", "uuid", "USER-DEFINED", "point", "bytea",
)
POSTGRES_DECLARED = ("numeric(", "character varying(", "timestamp(", "bit(", "time (", "uuid(")
