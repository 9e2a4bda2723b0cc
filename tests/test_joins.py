"""Join chains against brute force, with and without broadcast."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import pytest

from tablebridge.operators import joins

COMPARE = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}
BASE, TARGET = ["b.k", "b.v", "b.s"], ["t.k", "t.v", "t.s"]


def rows(count: int, seed: int) -> list[tuple]:
    """Rows with duplicates, nulls and a key that a third of them share."""
    made = random.Random(seed)

    def maybe(value):
        return None if made.random() < 0.15 else value

    return [
        (
            7 if made.random() < 0.33 else maybe(made.randint(0, 9)),
            maybe(round(made.uniform(-5, 5), 1)),
            maybe(made.choice(["a", "ab", "abcdefgh", "abcdefgi", "", "é", "z"])),
        )
        for _ in range(count)
    ]


def brute(base, target, how, groups):
    def holds(left, right):
        value = dict(zip(BASE, left)) | dict(zip(TARGET, right))

        def one(name, operator, other):
            a, b = value[name], value[other]
            return None not in (a, b) and COMPARE[operator](a, b)

        return any(all(one(*condition) for condition in group) for group in groups)

    pairs = [(a, b) for a, b in itertools.product(range(len(base)), range(len(target)))
             if holds(base[a], target[b])]
    found = Counter(base[a] + target[b] for a, b in pairs)
    nothing = (None, None, None)
    if how == "left":
        hit = {a for a, _ in pairs}
        found.update(row + nothing for i, row in enumerate(base) if i not in hit)
    if how == "right":
        hit = {b for _, b in pairs}
        found.update(nothing + row for i, row in enumerate(target) if i not in hit)
    return found


CHAINS = {
    "equal": [[("b.k", "=", "t.k")]],
    "equal and range": [[("b.k", "=", "t.k"), ("b.v", "<", "t.v")]],
    "or of equals": [[("b.k", "=", "t.k")], [("b.s", "=", "t.s")]],
    "three groups": [
        [("b.k", "=", "t.k"), ("b.v", ">", "t.v")],
        [("b.s", "=", "t.s")],
        [("b.v", "<=", "t.v"), ("b.s", "!=", "t.s")],
    ],
    "less": [[("b.v", "<", "t.v")]],
    "at least": [[("b.k", ">=", "t.k"), ("b.v", ">", "t.v")]],
    "text order": [[("b.s", ">", "t.s")]],
    "not equal": [[("b.k", "!=", "t.k")]],
    "not equal twice": [[("b.k", "!=", "t.k"), ("b.s", "!=", "t.s")]],
    "band": [[("b.v", "<=", "t.v"), ("b.k", ">=", "t.v")]],
    "band of base": [[("b.v", ">=", "t.k"), ("b.v", "<", "t.v")]],
    "mixed types": [[("b.k", "<", "t.v"), ("b.v", "<=", "t.k")]],
}


# How, whether a probe finds the sides small, whether the base is a table.
KINDS = [(how, small, True) for how in ("inner", "left", "right") for small in (True, False)]
KINDS.append(("right", False, False))


@pytest.mark.parametrize(("how", "small", "is_table"), KINDS)
@pytest.mark.parametrize("chain", CHAINS)
def test_chain(spark, monkeypatch, chain, how, small, is_table):
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: small)
    monkeypatch.setattr(joins, "planned_broadcast", lambda df: small)
    hot = spark.sql("SELECT xxhash64(7) AS k, xxhash64('a') AS s").first()
    monkeypatch.setattr(joins, "hot_keys", lambda df, keys: [hot.k] if keys[0].endswith("k") else [hot.s])
    left, right = rows(40, 1), rows(30, 2)
    schema = "`{0}.k` int, `{0}.v` double, `{0}.s` string"
    base = spark.createDataFrame(left, schema.format("b"))
    target = spark.createDataFrame(right, schema.format("t"))
    joined = joins.join_frames(base, target, how, CHAINS[chain], is_table)
    assert joined.columns == BASE + TARGET
    assert Counter(tuple(row) for row in joined.collect()) == brute(left, right, how, CHAINS[chain])


def test_no_nested_loop_for_or_of_equals(spark):
    base = spark.createDataFrame(rows(20, 3), "`b.k` int, `b.v` double, `b.s` string")
    target = spark.createDataFrame(rows(20, 4), "`t.k` int, `t.v` double, `t.s` string")
    joined = joins.join_frames(base, target, "left", CHAINS["or of equals"])
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_size_probe(spark):
    from tablebridge.operators.sizing import fits_broadcast

    table = spark.range(100)
    assert fits_broadcast(table, max_rows=100)
    assert not fits_broadcast(table, max_rows=99)
    assert not fits_broadcast(table, max_rows=100, max_bytes=50)


def hash_of(spark, value: int) -> int:
    return spark.sql(f"SELECT xxhash64({value}L)").first()[0]


def test_hot_keys_of_a_small_share_are_found(spark):
    """A key with 0.6 percent of the rows, spread over all tasks, beside 200,000 others."""
    from pyspark.sql import functions as F

    from tablebridge.operators.heavy import hot_keys

    even = spark.range(0, 200_000, 1, 8).withColumnRenamed("id", "k")
    some = even.withColumn("k", F.when(F.col("k") % 166 == 0, 1).otherwise(F.col("k")))
    assert hot_keys(some, ["k"]) == [hash_of(spark, 1)] and hot_keys(even, ["k"]) == []
    assert hot_keys(even.limit(0), ["k"]) == []
    assert hot_keys(some.withColumn("k", F.when(F.col("k") != 1, F.col("k"))), ["k"]) == []  # nulls hold no share
    both = some.select("k", F.lit("x").alias("t"))
    assert hot_keys(both, ["k", "t"]) == [spark.sql("SELECT xxhash64(1L, 'x')").first()[0]]


def test_a_table_is_asked_once(spark, tmp_path):
    """The second frame over the same files, under other names, runs no job."""
    from pyspark.sql import functions as F

    from tablebridge.operators.heavy import hot_keys

    spark.range(5000).select((F.col("id") % 3).alias("k"), "id").write.parquet(f"{tmp_path}/t")
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    for name in ("a.k", "b.k"):
        frame = spark.read.parquet(f"{tmp_path}/t").select(F.col("k").alias(name))
        spark.sparkContext.setJobGroup(f"hot-{name}", name)
        assert len(hot_keys(frame, [name])) == 3
        jobs.append(len(tracker.getJobIdsForGroup(f"hot-{name}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] > 0 and jobs[1] == 0


def test_sketches_of_loads_are_merged(spark, tmp_path):
    from pyspark.sql import functions as F

    from tablebridge.operators.heavy import KeySketches

    kept = KeySketches(spark, f"{tmp_path}/sketches")
    first = spark.range(10_000).select(F.when(F.col("id") % 100 == 0, 3).otherwise(F.col("id")).alias("k"))
    kept.add("t", first, ["k"])
    kept.add("u", spark.range(50).select(F.lit(9).cast("long").alias("k")), ["k"])
    assert kept.hot("t", ["k"]) == [hash_of(spark, 3)]
    later = spark.range(30_000).select(F.when(F.col("id") % 50 == 0, 4).otherwise(-F.col("id")).alias("k"))
    kept.add("t", later, ["k"])
    # 100 of 40,000 rows are no longer hot, 600 are.
    assert kept.hot("t", ["k"]) == [hash_of(spark, 4)]
    assert kept.hot("u", ["k"]) == [hash_of(spark, 9)] and kept.hot("v", ["k"]) == []


def test_no_job_while_a_small_outer_join_is_built(spark):
    base, target = spark.range(100).withColumnRenamed("id", "b.k"), spark.range(100).withColumnRenamed("id", "t.k")
    spark.sparkContext.setJobGroup("outer", "outer")
    for how in ("left", "right"):
        joins.join_frames(base, target, how, [[("b.k", "=", "t.k")]])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("outer")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_outer_join_on_a_hot_key_is_split(spark, monkeypatch):
    """A third of the optional side shares one key."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(joins, "planned_broadcast", lambda df: False)
    base = spark.range(1000).select(F.col("id").alias("b.k"))
    target = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("t.k"), F.col("id").alias("t.v")
    )
    joined = joins.join_frames(base, target, "left", [[("b.k", "=", "t.k")]])
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert plan.count("LeftAnti") == 1 and plan.count("LeftOuter") == 1
    plain = base.join(target, F.col("`b.k`") == F.col("`t.k`"), "left")
    assert joined.count() == plain.count()


TYPED = {
    "int": [3, -2, None, 40, 7, 7],
    "bigint": [3, 9007199254740993, None, -5, 9007199254740992, 7],
    "double": [2.5, float("nan"), None, float("inf"), 7.0, -1.0],
    "decimal(20,2)": ["3.00", "-2.50", None, "99999999999.25", "7.00", "7.01"],
    "string": ["3", "10", None, "7", "-2", "40"],
    "date": ["2024-01-02", "2023-12-31", None, "2024-02-01", "1999-01-01", "2024-01-02"],
    "timestamp": ["2024-01-02 00:00:00", "2024-01-02 10:00:00", None, "2023-12-31 23:59:59", "1999-01-01 00:00:00", "2030-01-01 00:00:00"],
    "boolean": [True, False, None, True, False, True],
    "binary": ["ab", "", None, "b", "aa", "é"],
}
NUMBERS, TIMES = ("int", "bigint", "double", "decimal(20,2)", "string"), ("date", "timestamp")
TYPE_PAIRS = [
    *itertools.product(NUMBERS, NUMBERS),
    *itertools.product(TIMES, TIMES),
    ("boolean", "boolean"),
    ("binary", "binary"),
]


@pytest.mark.parametrize(("one", "two"), TYPE_PAIRS)
def test_small_and_large_paths_agree(spark, monkeypatch, one, two):
    """Every comparison between two types, by nested loop and by ranges, with outer rows."""
    from pyspark.sql import functions as F

    def frame(name, kind):
        raw = spark.createDataFrame([(str(v) if v is not None else None,) for v in TYPED[kind] * 3], "v string")
        return raw.select(F.col("v").cast(kind).alias(name))

    base, target = frame("b.v", one), frame("t.v", two)
    for operator, how in [("<", "inner"), ("<=", "left"), (">", "right"), (">=", "inner"), ("!=", "left")]:
        outcome = []
        for small in (True, False):
            monkeypatch.setattr(joins, "fits_broadcast", lambda df, small=small: small)
            joined = joins.join_frames(base, target, how, [[("b.v", operator, "t.v")]])
            outcome.append(Counter(str(tuple(row)) for row in joined.collect()))
        assert outcome[0] == outcome[1] and outcome[0]


def met(left, right, group) -> tuple[int, int, int]:
    """Rows that each side sends to nodes, and pairs that meet there, of a band of ``left`` around values of ``right``."""
    from pyspark.sql import functions as F

    compare = joins._Compare(left, right)
    ranks = joins._Ranks(compare)
    band = joins._band(group, compare)
    joined = joins._interval_pairs(left, right, group, ranks, compare)
    (found,) = ranks._made.values()
    kind = compare.type_of(band.point, band.low or band.high)
    values = joins._ranked(right, compare.value(band.point, kind), found, "r")
    held = values.select(F.explode(joins.value_nodes(F.col("r"), found))).count()
    spans = joins._ranked(joins._ranked(left, compare.value(band.low, kind), found, "a"), compare.value(band.high, kind), found, "z")
    sent = spans.where("a <= z").select(F.explode(joins.interval_nodes("a", "z", found))).count()
    return held, sent, joined.count()


def test_work_grows_with_rows_not_with_their_product(spark):
    from pyspark.sql import functions as F

    sizes = []
    for n in (2_000, 20_000):
        spans = spark.range(n).select(F.col("id").alias("b.lo"), (F.col("id") + 30).alias("b.hi"))
        values = spark.range(2 * n).select((F.col("id") / 2).alias("t.v"))
        sizes.append(met(spans, values, [("b.lo", "<=", "t.v"), ("b.hi", ">=", "t.v")]))
    (held, sent, pairs), (more_held, more_sent, more_pairs) = sizes
    assert pairs == 2_000 * 61 - 900 and more_pairs == 20_000 * 61 - 900
    assert 9 < more_held / held < 11 and 9 < more_sent / sent < 11
    assert more_sent < 20_000 * 25 and more_held <= 40_000 * 5


@pytest.mark.parametrize("rows_per_value", [1, 30, 5000])
def test_nodes_cover_an_interval_once(spark, rows_per_value):
    """Each rank of an interval lies in one of its nodes, and no other does; many equal values keep nodes small."""
    from pyspark.sql import functions as F

    from tablebridge.operators import intervals

    levels = {1: 4, 30: 2, 5000: 0}[rows_per_value]
    values = spark.range(9000).select((F.col("id") * 7).alias("value"), F.lit(rows_per_value).alias("n"))
    ranks = intervals.rank_values(values.union(spark.createDataFrame([(None, 5), (63, 0)], "value long, n int")))
    assert (ranks.distinct, ranks.levels) == (9000, levels)
    order = ranks.table.orderBy("value").collect()
    assert [(r.value, r.rank) for r in order] == [(7 * i, i) for i in range(9000)]
    made = random.Random(3)
    spans = [(0, 8999), (0, 0), (8999, 8999), (1, 8998), (5, 4)] + [tuple(sorted(made.sample(range(9000), 2))) for _ in range(60)]
    frame = spark.createDataFrame([(a, z) for a, z in spans], "a long, z long")
    nodes = {(r.a, r.z): r.n for r in frame.select("a", "z", intervals.interval_nodes("a", "z", ranks).alias("n")).collect()}
    own = {r.rank: set(r.n) for r in ranks.table.select("rank", intervals.value_nodes(F.col("rank"), ranks).alias("n")).collect()}
    for (a, z), visited in nodes.items():
        once = set(visited)
        assert len(once) == len(visited)
        for rank in {*range(max(0, a - 9), min(9000, a + 90)), *range(max(0, z - 90), min(9000, z + 10)), *made.sample(range(9000), 50)}:
            assert len(own[rank] & once) == (a <= rank <= z)
        assert len(visited) <= max(0, z - a + 1) and (levels < 4 or len(visited) <= 14 * 4 + 3)


def test_common_values_and_outliers(spark, monkeypatch):
    """A third of the values equal, one far from all others, and bounds that no value equals."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    target = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 50).when(F.col("id") == 1, 10**12).otherwise(F.col("id")).alias("t.v"))
    base = spark.range(200).select((F.col("id") - 0.5).alias("b.lo"), (F.col("id") * F.col("id") + 0.25).alias("b.hi"))
    values = [50 if i % 3 == 0 else 10**12 if i == 1 else i for i in range(3000)]
    for how in ("inner", "left", "right"):
        joined = joins.join_frames(base, target, how, [[("b.lo", "<", "t.v"), ("b.hi", ">", "t.v")]])
        pairs = [(i, v) for i in range(200) for v in values if i - 0.5 < v < i * i + 0.25]
        met_values = {v for _, v in pairs}
        lonely = {"inner": 0, "left": 200 - len({i for i, _ in pairs}), "right": sum(v not in met_values for v in values)}
        assert joined.count() == len(pairs) + lonely[how]


def test_a_band_visits_few_ranges(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    base = spark.range(20_000).select(F.col("id").alias("b.lo"), (F.col("id") + 2).alias("b.hi"))
    target = spark.range(20_000).select(F.col("id").alias("t.v"))
    group = [("b.lo", "<=", "t.v"), ("b.hi", ">=", "t.v")]
    band = joins._band(group, joins._Compare(base, target))
    assert (band.point, band.low, band.high) == ("t.v", "b.lo", "b.hi")
    joined = joins.join_frames(base, target, "inner", [group])
    assert joined.count() == 3 * 20_000 - 3


def test_a_right_join_after_joins_runs_its_base_once(spark):
    """No probe of the base, and one join."""
    from pyspark.sql import functions as F

    one, two = spark.range(50).select(F.col("id").alias("a.k")), spark.range(60).select(F.col("id").alias("b.k"))
    base = one.join(two, F.col("`a.k`") == F.col("`b.k`"))
    target = spark.range(70).select(F.col("id").alias("c.k"))
    joined = joins.join_frames(base, target, "right", [[("b.k", "=", "c.k")]], base_is_table=False)
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert plan.count("RightOuter") == 1 and "Union" not in plan
    assert joined.count() == 70
