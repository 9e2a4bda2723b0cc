"""Targets: partitions, tables, layout, key checks, statistics."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tablebridge.operators.checks import column_stats, key_violations
from tablebridge.sinks import partitions as P
from tablebridge.sinks import tables as K
from tablebridge.sinks.layout import per_column, plan_layout, unique_violations, write_layout


def fresh(prefix="t"):
    return f"{prefix}_{uuid.uuid4().hex}"


@pytest.fixture(scope="module")
def dated(spark):
    rows = [
        (1, "1995-12-31 23:59:59"), (2, "1996-01-01 00:00:00"), (3, "1996-12-31 23:59:59"),
        (4, "1997-01-01 00:00:00"), (5, None), (6, "1997-01-31 00:00:00"), (7, "1997-02-01 00:00:00"),
    ]
    table = spark.createDataFrame(rows, "id int, day string")
    return table.withColumn("day", F.col("day").cast("timestamp_ntz"))


def labels(df):
    return {row.id: row.part for row in df.collect()}


def test_year_and_month_labels(dated):
    assert labels(P.with_range_label(dated, "day", "Year", ["1996", 1997, "1996"])) == {
        1: "default", 2: "1996", 3: "1996", 4: "1997", 5: "default", 6: "1997", 7: "1997"
    }
    assert labels(P.with_range_label(dated, "day", "month", ["1996-12", "1997-01"])) == {
        1: "default", 2: "default", 3: "1996_12", 4: "1997_01", 5: "default", 6: "1997_01",
        7: "default",
    }


def test_range_bounds():
    assert P.date_ranges("month", ["2024-12"]) == {
        "2024_12": (dt.date(2024, 12, 1), dt.date(2025, 1, 1))
    }
    assert P.date_ranges("year", ["2024"]) == {"2024": (dt.date(2024, 1, 1), dt.date(2025, 1, 1))}


@pytest.mark.parametrize(
    ("strategy", "ranges"), [("day", ["2024"]), ("year", []), ("month", ["2024"]), (None, ["2024"])]
)
def test_bad_ranges(strategy, ranges):
    with pytest.raises(ValueError):
        P.date_ranges(strategy, ranges)


def test_bad_method(spark, dated, tmp_path):
    with pytest.raises(ValueError):
        P.write_target(dated, str(tmp_path), "day", "ROUND_ROBIN")
    with pytest.raises(ValueError):
        P.write_target(dated, str(tmp_path), "id", "HASH")


def test_list_labels(spark):
    table = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, v int")
    assert labels(P.with_list_label(table, "v", ["10", 30])) == {1: "10", 2: "default", 3: "default"}


def test_partitioned_roundtrip_and_pruning(spark, dated, tmp_path):
    years = ["1996", "1997"]
    path = f"{tmp_path}/p"
    schema = P.write_target(dated, path, "day", "range", "year", years)
    stored = P.read_partitioned(spark, path, schema)
    assert dict(stored.dtypes)["part"] == "string"
    assert labels(stored) == labels(P.with_range_label(dated, "day", "year", years))

    def found(start, end):
        return sorted(r.id for r in P.in_dates(stored, "day", "year", years, start, end).collect())

    assert found("1996-06-01", "1997-02-01") == [3, 4, 6]
    assert found("1995-01-01", "1996-01-02") == [1, 2]
    assert found("1997-01-31", "1999-01-01") == [6, 7]
    inside = P.in_dates(stored, "day", "year", years, "1996-02-01", "1996-03-01")
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(part#" in plan or "PartitionFilters: [isnotnull(part#" in plan
    assert "default" not in plan.split("PartitionFilters")[1].split("]")[0]
    # A gap between ranges is held by the default label.
    gap = P.in_dates(stored, "day", "year", ["1995", "1997"], "1995-06-01", "1997-06-01")
    assert "default" in gap._jdf.queryExecution().executedPlan().toString()


def test_hashed_table_joins_without_shuffle(spark, tmp_path):
    a, b = fresh(), fresh()
    rows = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    P.write_target(rows, f"{tmp_path}/a", "k", "HASH", table=a, buckets=4)
    P.write_target(rows, f"{tmp_path}/b", "k", "HASH", table=b, buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(a).join(spark.table(b), "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 50 * 20 * 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


COLUMNS = [
    {"name": "id", "type": "BIGINT", "length": 8, "nullable": "NO", "default": None},
    {"name": "we ird", "type": "VARCHAR", "length": 20, "nullable": " YES ", "default": "'it''s'::character varying"},
    {"name": "n", "type": "NUMERIC(6,2)", "nullable": "YES", "default": "((1.5))"},
    {"name": "at", "type": "TIMESTAMP", "nullable": "YES", "default": "now()"},
    {"name": "on", "type": "DATE", "nullable": "YES", "default": "'2024-01-01'::date"},
    {"name": "ok", "type": "BOOLEAN", "nullable": "YES", "default": "true"},
    {"name": "x", "type": "INTEGER", "nullable": "YES", "default": "(getdate())"},
]


def test_create_insert_truncate_reload(spark, tmp_path):
    database = fresh("db")
    K.create_database(spark, database, f"{tmp_path}/db")
    K.create_database(spark, database)
    table = K.create_table(spark, "target", COLUMNS, database=database)
    assert K.create_table(spark, "target", COLUMNS, database=database) == table
    types = dict(spark.table(table).dtypes)
    assert types["we ird"] == "string" and types["n"] == "decimal(6,2)" and types["at"] == "timestamp_ntz"
    assert spark.table(table).schema["we ird"].metadata["comment"] == "VARCHAR(20)"

    K.insert_rows(spark.createDataFrame([(1,), (2,)], "id bigint"), table)
    row = spark.table(table).where("id = 1").first().asDict()
    assert (row["we ird"], float(row["n"]), row["at"], row["on"], row["ok"], row["x"]) == (
        "it's", 1.5, None, dt.date(2024, 1, 1), True, None
    )

    K.reload_table(spark.createDataFrame([(9,)], "id bigint"), table)
    assert [r.id for r in spark.table(table).collect()] == [9]
    assert K.analyze_table(spark, table)
    assert not K.analyze_table(spark, f"{database}.missing")
    K.truncate_table(spark, table)
    assert spark.table(table).count() == 0 and dict(spark.table(table).dtypes) == types


def test_reload_files_replaces(spark, tmp_path):
    path = f"{tmp_path}/r"
    K.reload_files(spark.range(5).toDF("id"), path)
    assert K.reload_files(spark.range(2).toDF("id"), path).count() == 2


def test_layout_plan():
    layout = plan_layout(
        [
            {"columns": ["id"], "unique": True, "primary": True},
            {"columns": [" ", None], "unique": True},
            {"columns": ["a", "b"], "unique": False},
            {"columns": ["c", "a"], "unique": True},
        ]
    )
    assert layout.sort_columns == ["a", "b"]
    assert layout.bloom_columns == ["c"]
    assert layout.unique_keys == [["c", "a"]]
    assert plan_layout(None).sort_columns == []
    assert plan_layout(per_column(["x", "y"])).bloom_columns == ["y"]


def test_layout_write(spark, tmp_path):
    rows = spark.range(2000).select((F.col("id") * 7919 % 2000).alias("a"), F.col("id").cast("string").alias("b"))
    layout = plan_layout(per_column(["a", "b"]))
    path = f"{tmp_path}/l"
    write_layout(rows, path, layout)
    stored = spark.read.parquet(path)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, rows.collect()))
    # Value ranges of files do not overlap.
    ranges = stored.groupBy(F.input_file_name()).agg(F.min("a"), F.max("a")).collect()
    ordered = sorted((r[1], r[2]) for r in ranges)
    assert all(left[1] <= right[0] for left, right in zip(ordered, ordered[1:]))


def test_key_violations(spark):
    rows = spark.createDataFrame(
        [(1, 1), (1, 1), (1, 2), (None, 1), (None, 2), (None, 2)], "a int, b int"
    )
    found = {(r.a, r.b): r.n for r in key_violations(rows, "a, b").collect()}
    assert found == {(1, 1): 2, (None, 1): 1, (None, 2): 2}
    unique = unique_violations(rows, plan_layout([{"columns": ["a", "b"], "unique": True}]))
    assert [tuple(r) for r in unique[0].collect()] == [(1, 1, 2)]


def test_key_named_like_the_count(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,)], "n int")
    assert [tuple(r) for r in key_violations(rows, "n").collect()] == [(1, 2)]


def test_label_never_replaces_a_column(dated):
    for make in (
        lambda t: P.with_range_label(t, "day", "year", ["1996"], "ID"),
        lambda t: P.with_list_label(t, "id", [1], "day"),
    ):
        with pytest.raises(ValueError):
            make(dated)


def test_column_stats(spark):
    rows = spark.createDataFrame(
        [(1, "b", True), (None, "a", None), (1, None, False), (5, "a", True)], "i int, s string, b boolean"
    )
    expected = {
        ("i", 1, 2, "1", "5"), ("s", 1, 2, "a", "b"), ("b", 1, 2, "False", "True")
    }
    assert {tuple(r) for r in column_stats(rows).collect()} == expected
    assert {tuple(r) for r in column_stats(rows, approximate=True).collect()} == expected
    empty = column_stats(rows.limit(0), ["i"]).first()
    assert tuple(empty) == ("i", 0, 0, None, None)


def test_a_failing_load_leaves_the_old_rows(spark, tmp_path):
    table = K.create_table(spark, "safe_load", [{"name": "id", "type": "BIGINT"}], f"{tmp_path}/safe")
    try:
        K.insert_rows(spark.range(5), table)
        stop = F.when(F.col("id") == 3, F.raise_error(F.lit("stop")).cast("bigint"))
        broken = spark.range(5).select(F.coalesce(stop, "id").alias("id"))
        for load in (
            lambda: K.reload_table(broken, table),
            lambda: K.reload_table(spark.createDataFrame([("x",)], "id string"), table),
            lambda: K.reload_files(broken, f"{tmp_path}/safe"),
        ):
            with pytest.raises(Exception):
                load()
            assert spark.table(table).count() == 5
        K.reload_table(spark.table(table).where("id < 2"), table)
        assert spark.table(table).count() == 2
        K.truncate_table(spark, table)
        assert spark.table(table).count() == 0 and spark.table(table).columns == ["id"]
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_list_labels_stay_apart(spark):
    found = P.list_labels(["a-b", "a_b", "default", "a b", "a-b"])
    assert list(found.values()) == ["a-b", "a_b", "default", "a b"]
    assert len(set(found)) == 4 and "default" not in found
    table = spark.createDataFrame([("a-b",), ("a_b",), ("default",), ("other",), (None,)], "v string")
    rows = P.with_list_label(table, "v", ["a-b", "a_b", "default"]).collect()
    labels = {r.v: r.part for r in rows}
    assert len({labels[v] for v in ("a-b", "a_b", "default")}) == 3
    assert labels["other"] == labels[None] == "default"


def test_quotes_in_types_and_places(spark, tmp_path):
    columns = [{"name": "id", "type": "it's"}]
    assert K.column_definitions(columns)[0].endswith(r"COMMENT 'it\'s'")


def test_versions_of_a_table(spark, tmp_path):
    """Old or new rows as a whole; a load killed before the switch changes nothing."""
    from tablebridge.sinks import versions as V

    path = f"{tmp_path}/own"
    columns = [{"name": "id", "type": "BIGINT"}, {"name": "kind", "type": "TEXT", "default": "'new'"}]
    table = K.create_table(spark, fresh("versions"), columns, path)
    try:
        K.insert_rows(spark.range(5).select("id", F.lit("old").alias("kind")), table)
        began = spark.read.schema(spark.table(table).schema).parquet(V.location(spark, table))
        # Killed between the write and the switch.
        V.write_version(spark.range(7), table)
        assert spark.table(table).count() == 5 and V.manifest(spark, table).where("current").first().version == 0
        # Killed while it writes: a folder without a line in the manifest.
        stop = F.when(F.col("id") == 3, F.raise_error(F.lit("stop")).cast("bigint"))
        with pytest.raises(Exception):
            V.load_version(spark.range(5).select(F.coalesce(stop, "id").alias("id")), table)
        assert spark.table(table).count() == 5 and V.manifest(spark, table).count() == 2
        K.reload_table(spark.range(3), table)
        assert sorted(map(tuple, spark.table(table).collect())) == [(0, "new"), (1, "new"), (2, "new")]
        assert began.count() == 5  # a reader that began before goes on
        K.reload_table(spark.table(table).where("id > 0"), table)
        K.truncate_table(spark, table)
        assert spark.table(table).count() == 0
        found = [(r.version, r.rows, r.current) for r in V.manifest(spark, table).orderBy("version").collect()]
        assert found == [(0, None, False), (1, 7, False), (2, 3, False), (3, 2, False), (4, 0, True)]
        V.restore_version(spark, table, 2)
        assert spark.table(table).count() == 3
        assert V.expire_versions(spark, table, keep=2) == [0]
        V.restore_version(spark, table, 4)
        assert V.expire_versions(spark, table, keep=2) == [1, 2]
        with pytest.raises(ValueError, match="no version 2"):
            V.restore_version(spark, table, 2)
        V.restore_version(spark, table, 3)
        assert spark.table(table).count() == 2
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_partitioned_and_managed_tables_are_overwritten(spark, tmp_path):
    from tablebridge.sinks import versions as V

    name = fresh("parted")
    spark.range(6).select("id", (F.col("id") % 2).alias("part")).write.partitionBy("part").option("path", f"{tmp_path}/parted").saveAsTable(name)
    assert not V.can_switch(spark, name)
    K.reload_table(spark.range(2).select("id", F.lit(7).cast("bigint").alias("part")), name)
    assert sorted(map(tuple, spark.table(name).collect())) == [(0, 7), (1, 7)]
    spark.sql(f"DROP TABLE {name}")


def test_statistics_merge_over_loads(spark, tmp_path):
    """Merged lines say what the whole table says; a load that is taken back is left out."""
    from tablebridge.operators.stats import ColumnSketches

    def rows(low, high):
        number = F.col("id")
        return spark.range(low, high).select(
            F.when(number % 7 != 0, number.cast("int")).alias("i"),
            (number * 0.5).alias("x"),
            F.format_string("n%d", number % 100).alias("s"),
            F.date_add(F.lit("2024-01-01").cast("date"), (number % 50).cast("int")).alias("d"),
            (number % 2 == 0).alias("b"),
            F.lit(None).cast("decimal(9,2)").alias("none"),
        )

    kept = ColumnSketches(spark, f"{tmp_path}/lines")
    for name, low, high in (("a", 0, 1000), ("b", 1000, 5000), ("c", 5000, 5001)):
        kept.add("t", name, rows(low, high))
    kept.add("other", "a", rows(0, 10))
    whole = rows(0, 5001)
    exact = {r.column_name: r for r in column_stats(whole).collect()}
    merged = {r.column_name: r for r in kept.stats("t", whole.schema).collect()}
    assert set(merged) == set(exact)
    for name, r in merged.items():
        e = exact[name]
        assert (r.rows, r.nulls, r.lo, r.hi) == (5001, e.nulls, e.lo, e.hi)
        assert abs(r.distincts - e.distincts) <= 0.05 * e.distincts
    assert abs(merged["x"].quantiles[1] - 1250) < 40 and merged["s"].quantiles is None and merged["none"].quantiles is None
    once = ColumnSketches(spark, f"{tmp_path}/once")
    once.add("t", "all", whole)
    full = {r.column_name: (r.rows, r.nulls, r.lo, r.hi, r.distincts) for r in once.stats("t", whole.schema).collect()}
    assert {n: (r.rows, r.nulls, r.lo, r.hi, r.distincts) for n, r in merged.items()} == full
    less = {r.column_name: r for r in kept.stats("t", whole.schema, without=["b"]).collect()}
    assert (less["x"].rows, less["x"].hi) == (1001, "2500.0")
    assert kept.stats("nothing", whole.schema).collect() == []


def test_a_curve_lets_each_index_skip_files(spark, tmp_path):
    """Lookups by either of two columns read few files, with text, nulls and a value that a third of the rows share."""
    from tablebridge.sinks.layout import curve_key, indexed_layout

    number = F.col("id")
    rows = spark.range(20_000).select(
        (number * 7919 % 20_000).alias("a"),
        F.when(number % 3 != 0, F.format_string("%05d", number * 104_729 % 20_000)).alias("b"),
        number,
    )
    layout = indexed_layout([{"name": "a", "is_index": "YES"}, {"name": "id", "is_index": "NO"}, {"name": "b", "is_index": "yes"}])
    assert layout.curve_columns == ["a", "b"] and layout.sort_columns == ["a"] and layout.bloom_columns == ["b"]
    shares = {}
    for kind in ("curve", "plain"):
        own = layout if kind == "curve" else plan_layout(per_column(["a", "b"]))
        write_layout(rows, f"{tmp_path}/{kind}", own, 500)
        stored = spark.read.parquet(f"{tmp_path}/{kind}")
        assert stored.count() == 20_000 and stored.columns == ["a", "b", "id"]
        files = stored.groupBy(F.input_file_name()).agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).collect()
        shares[kind] = [
            sum(f[low] is not None and f[low] <= v <= f[low + 1] for f in files for v in values) / len(files) / len(values)
            for low, values in ((1, [100, 9000, 15_000]), (3, ["00100", "09000", "15000"]))
        ]
    assert shares["plain"][0] < 0.1 and shares["plain"][1] > 0.6
    assert max(shares["curve"]) < 0.35
    # The key interleaves the places' bits, the first column's first.
    keys = [r.k for r in rows.orderBy("a").select(curve_key(rows.select("a"), ["a"], 3).alias("k")).collect()]
    assert keys == sorted(keys) and set(keys) == set(range(8))


def test_flagged_columns_lay_out_the_loads_of_a_table(spark, tmp_path):
    from tablebridge.sinks import versions as V

    columns = [{"name": "a", "type": "BIGINT", "is_index": "YES"}, {"name": "b", "type": "BIGINT", "is_index": "YES"}, {"name": "c", "type": "TEXT", "is_index": "NO"}]
    table = K.create_table(spark, fresh("flagged"), columns, f"{tmp_path}/flagged")
    try:
        assert V.table_layout(spark, table).curve_columns == ["a", "b"]
        rows = spark.range(5000).select((F.col("id") * 37 % 5000).alias("a"), (F.col("id") * 53 % 4999).alias("b"), F.lit("x").alias("c"))
        K.reload_table(rows, table)
        assert spark.table(table).count() == 5000
        place = spark.table(table).select(F.col("_metadata.row_index").alias("i"), "a", "b").orderBy("i").limit(300).collect()
        # The first rows of a file lie in one corner of both columns.
        assert max(r.a for r in place) < 3500 and max(r.b for r in place) < 3500
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_violations_of_a_load(spark, monkeypatch):
    """Twice in the load, already in the target, nulls; keys of two columns, text and doubles, with and without a filter."""
    from tablebridge.operators import checks

    batch = spark.createDataFrame([(1, "a", 0.0), (1, "a", 0.0), (2, "b", -0.0), (3, None, 1.0), (4, "d", 2.0), (5, "e", 3.0)], "k int, s string, x double")
    target = spark.createDataFrame([(2, "b", 0.0), (2, "b", 0.0), (3, "c", 1.0), (5, "other", 3.0), (None, "d", 2.0)], "k bigint, s string, x double")
    want = {(1, "a", 0.0, 2, 0), (2, "b", 0.0, 1, 2)}
    for bits in (26, 0):  # beyond the filter's size all rows of the target meet the load
        monkeypatch.setattr(checks, "FILTER_BITS", bits)
        found = {tuple(r) for r in checks.load_violations(batch, target, "k, s, x").collect()}
        assert found == want | {(3, None, 1.0, 1, 0)}
        assert {tuple(r) for r in checks.load_violations(batch, target, ["k", "s", "x"], nulls_allowed=True).collect()} == want
    assert checks.load_violations(batch.limit(0), target, "k").collect() == []
    assert {tuple(r) for r in checks.load_violations(batch, target.limit(0), "k").collect()} == {(1, 2, 0)}
