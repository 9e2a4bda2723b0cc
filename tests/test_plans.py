"""Plans: what reaches the scan, and what is shuffled."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tablebridge.operators.infer import infer_types
from tablebridge.operators.stats import sketch_columns
from tablebridge.sources.files import ParquetSource
from tests.conftest import SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def query_plan(spark, name) -> str:
    return plan_of(contract.queries()[name](spark, SMALL))


def read_columns(plan: str, table: str) -> set[str]:
    """Columns that the scan of a table reads."""
    scan = next(line for line in plan.splitlines() if f"/{table}.parquet" in line)
    return {name.split("#")[0] for name in re.search(r"FileScan parquet \[(.*?)\]", scan)[1].split(",")}


@pytest.mark.parametrize("name", sorted(n for n in contract.queries() if n.startswith("f_")))
def test_filters_shuffle_nothing(spark, name):
    plan = query_plan(spark, name)
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("f_eq", "EqualTo(o_orderpriority,1-URGENT)"),
        ("f_gt", "GreaterThan(o_totalprice,400000.0)"),
        ("f_in", "In(c_mktsegment, [BUILDING,MACHINERY])"),
        ("f_starts_with", "StringStartsWith(p_name,red)"),
        ("f_contains", "StringContains(p_name,ring)"),
        ("w_dates", "GreaterThanOrEqual(o_orderdate,1996-02-01T00:00)"),
        ("flagship_spec", "EqualTo(o_orderstatus,F)"),
        ("delta_latest", "GreaterThan(ts,2024-01-29T00:00)"),
    ],
)
def test_filter_is_pushed_down(spark, name, pushed):
    assert pushed in query_plan(spark, name)


@pytest.mark.parametrize(
    ("name", "table", "columns"),
    [
        ("flagship_spec", "lineitem", {"l_orderkey", "l_partkey", "l_extendedprice"}),
        ("flagship_spec", "part", {"p_partkey", "p_brand", "p_size"}),
        ("sel_alias", "customer", {"c_custkey", "c_name"}),
        ("j_star", "supplier", {"s_suppkey", "s_name"}),
        ("a_global", "lineitem", {"l_quantity"}),
        ("count_filtered", "orders", {"o_orderstatus", "o_totalprice"}),
        ("key_violations", "lineitem", {"l_orderkey", "l_linenumber"}),
    ],
)
def test_only_needed_columns_are_read(spark, name, table, columns):
    assert read_columns(query_plan(spark, name), table) == columns


@pytest.mark.parametrize("name", ["j_compound_or", "j_left_or", "j_inner", "w_column_arith"])
def test_equality_joins_never_loop(spark, name):
    plan = query_plan(spark, name)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_statistics_of_all_columns_take_one_scan(spark):
    plan = query_plan(spark, "column_stats")
    assert plan.count("Scan parquet") == 1 and "Expand" in plan
    lines = plan_of(sketch_columns(ParquetSource(spark, SMALL).table("orders")))
    assert lines.count("Scan parquet") == 1 and lines.count("Exchange") == 1 and "Expand" not in lines


def test_the_target_of_a_load_is_not_shuffled(spark):
    """Its rows meet a broadcast filter in the scan's own stage; only what passes is exchanged."""
    from tablebridge.operators.checks import load_violations

    target = ParquetSource(spark, SMALL).table("lineitem").select("l_orderkey")
    batch = spark.range(50_000).select(F.col("id").alias("l_orderkey"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(load_violations(batch, target, "l_orderkey"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    meeting = plan.index("BroadcastHashJoin [__word")
    assert "Exchange" not in plan[meeting : plan.index("lineitem.parquet", meeting)]


def test_texts_that_a_pattern_needs_are_pushed_down(spark):
    from tablebridge.operators.filters import filter_rows

    part = ParquetSource(spark, SMALL).table("part")
    found = filter_rows(part, [{"column": {"name": "p_name"}, "operator": "MATCHES", "value": "^red .+ring( |$)"}])
    plan = plan_of(found)
    assert "StringStartsWith(p_name,red )" in plan and "StringContains(p_name,ring)" in plan
    assert found.count() == part.where(F.col("p_name").rlike("^red .+ring( |$)")).count()


def test_top_k_page(spark):
    assert "TakeOrderedAndProject" in query_plan(spark, "page_raw")


def test_distinct_counts_are_spread_by_value(spark):
    """A hot group is first grouped by its values."""
    assert "hashpartitioning(orders.o_orderstatus#" in query_plan(spark, "a_count_distinct")
    plan = query_plan(spark, "a_count_distinct")
    assert re.search(r"hashpartitioning\(orders\.o_orderstatus#\d+, orders\.o_custkey#\d+L", plan)


def test_one_shuffle_of_two_numbers_per_column(spark):
    plan = plan_of(infer_types(ParquetSource(spark, SMALL).table("documents")))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_bit_and" in plan
