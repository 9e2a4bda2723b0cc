"""Sources: settings, names, splits, batches."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablebridge import open_source
from tablebridge.functions.naming import checked_name
from tablebridge.sources.dialects import DIALECTS
from tablebridge.sources.jdbc import JdbcSource, jdbc_options
from tablebridge.sources.splits import for_each_batch, map_batches, with_splits
from tablebridge.session import scratch_path, scratch_root
from tests.conftest import SMALL

SETTINGS = {"host": "h", "user": "u", "password": "p", "port": 1, "database": "d"}


def test_postgres_options():
    options = jdbc_options("postgres", SETTINGS)
    assert options["url"] == "jdbc:postgresql://h:1/d?connectTimeout=10&currentSchema=public"
    assert options["driver"] == "org.postgresql.Driver"
    assert (options["user"], options["password"], options["fetchsize"]) == ("u", "p", "10000")
    assert jdbc_options("postgres", {**SETTINGS, "schema": "s"})["url"].endswith("currentSchema=s")


def test_other_options():
    assert jdbc_options("sqlserver", SETTINGS)["url"] == (
        "jdbc:sqlserver://h:1;databaseName=d;loginTimeout=10"
    )
    url = jdbc_options("informix", {**SETTINGS, "protocol": "x", "locale": "en_US.819"})["url"]
    assert url.startswith("jdbc:informix-sqli://h:1/d:") and "DB_LOCALE=en_US.819" in url
    assert "LOCALE" not in jdbc_options("informix", SETTINGS)["url"]


@pytest.mark.parametrize("missing", sorted(SETTINGS))
def test_missing_setting(missing):
    with pytest.raises(ValueError, match=missing):
        jdbc_options("postgres", {k: v for k, v in SETTINGS.items() if k != missing})


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        open_source(spark, "oracle", SETTINGS)


@pytest.mark.parametrize("name", ["a b", "a;b", "a--", '"a"', "a.b.c.d", "", "1a"])
def test_names_are_checked(name):
    with pytest.raises(ValueError):
        checked_name(name)


def test_jdbc_statements_and_splits(spark):
    source = open_source(spark, "postgres", SETTINGS)
    assert isinstance(source, JdbcSource)
    assert source.reader_options("s.t")["dbtable"] == "s.t"
    assert source.dialect.count_statement("t") == "SELECT COUNT(*) AS n FROM t"
    assert source.min_max_statement("t", "day") == (
        'SELECT MIN("day") AS min_val, MAX("day") AS max_val FROM t'
    )
    written = source.writer_options("t", 8)
    assert (written["numPartitions"], written["batchsize"]) == ("8", "10000")
    server = open_source(spark, "sqlserver", SETTINGS)
    assert "MIN([day])" in server.min_max_statement("t", "day")
    informix = open_source(spark, "informix", {**SETTINGS, "protocol": "onsoctcp"})
    assert "MIN(day)" in informix.min_max_statement("t", "day")
    assert (source.ties, informix.ties) == ("one", "all")


def test_jdbc_results_by_position(spark):
    """Databases fold result names as they like; values are taken by position."""

    class Canned(JdbcSource):
        def run(self, statement):
            self.statement = statement
            return spark.createDataFrame([(3, 9)], "`MIN_VAL` int, `MAX_VAL` int") if (
                "MIN" in statement
            ) else spark.createDataFrame([(7,)], "`N` int")

    source = Canned(spark, "postgres", {**SETTINGS, "schema": "s"})
    counted = source.count_rows("t")
    assert counted.dtypes == [("n", "bigint")] and counted.first().n == 7
    assert tuple(source.min_max("t", "day").first()) == (3, 9)
    assert source.min_max("t", "day").columns == ["min_val", "max_val"]
    assert source.table_names().columns == ["table_name"] and "'s'" in source.statement
    assert source.preview(" SELECT 1; ", 5).count() == 1 and source.statement == "SELECT 1"


def test_parquet_source(spark):
    source = open_source(spark, "parquet", {"folder": SMALL})
    names = {row.table_name for row in source.table_names().collect()}
    assert {"orders", "region", "events"} <= names and len(names) == 14
    described = source.columns("nation").orderBy("position").collect()
    assert [(r.name, r.type) for r in described] == [
        ("n_nationkey", "number"), ("n_name", "string"), ("n_regionkey", "number")
    ]
    assert source.preview("SELECT * FROM {nation} n;", 3).count() == 3


def test_folder_tables_are_listed_once(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(f"{tmp_path}/many.parquet")
    source = open_source(spark, "parquet", {"folder": str(tmp_path)})
    assert [row.table_name for row in source.table_names().collect()] == ["many"]


def test_catalog_source(spark, tmp_path):
    spark.range(4).write.option("path", f"{tmp_path}/c").saveAsTable("catalog_source_probe")
    source = open_source(spark, "catalog", {})
    assert "catalog_source_probe" in {row.table_name for row in source.table_names().collect()}
    assert source.count_rows("catalog_source_probe").first().n == 4
    assert tuple(source.min_max("catalog_source_probe", "id").first()) == (0, 3)


def test_splits(spark):
    rows = spark.createDataFrame([(-(2**63),), (0,), (2**63 - 1,), (None,)], "k bigint")
    assert {r.k: r.split for r in with_splits(rows, "k", 4).collect()} == {
        -(2**63): 0, 0: 2, 2**63 - 1: 3, None: None
    }
    counts = with_splits(spark.range(100), "id", 7).groupBy("split").count().collect()
    assert sum(r["count"] for r in counts) == 100 and len(counts) == 7
    assert with_splits(spark.range(0), "id", 3).count() == 0


def test_batches(spark):
    rows = spark.range(0, 1005, 1, 2)

    def sizes(batch):
        return pd.DataFrame({"n": [len(batch)], "s": [batch["id"].sum()]})

    seen = map_batches(rows, sizes, "n bigint, s bigint", 100).collect()
    assert sum(r.n for r in seen) == 1005 and sum(r.s for r in seen) == 1005 * 1004 // 2
    assert max(r.n for r in seen) == 100 and sum(r.n < 100 for r in seen) <= 2
    assert map_batches(rows.limit(0), sizes, "n bigint, s bigint").count() == 0


def test_for_each_batch_runs_in_tasks(spark, tmp_path):
    folder = str(tmp_path)

    def keep(batch):
        import os
        import uuid

        with open(os.path.join(folder, uuid.uuid4().hex), "w") as out:
            out.write(str(len(batch)))

    for_each_batch(spark.range(0, 50, 1, 2), keep, 10)
    assert sum(int(path.read_text()) for path in tmp_path.iterdir()) == 50


def test_scratch_follows_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_source_operators_share_one_table(spark):
    source = open_source(spark, "parquet", {"folder": SMALL})
    filters = [{"column": {"name": "o_orderstatus"}, "operator": "=", "value": "F"}]
    total = source.count_rows("orders", filters).first().n
    assert total == source.table("orders").where(F.col("o_orderstatus") == "F").count()
    assert source.page_text("orders", "o_orderkey", 0, 3, filters).count() == 3
    assert source.changes("events", "user_id", "2024-01-15", ts="ts").count() > 0


class Reader:
    """Stands for a session and its reader; answers statements and keeps what it is asked to load."""

    def __init__(self, answers):
        self.read, self.answers, self.loads = self, answers, []

    def format(self, kind):
        assert kind == "jdbc"
        return self

    def options(self, **options):
        self.asked = options
        return self

    def load(self):
        self.loads.append(self.asked)
        name = self.asked.get("query") or self.asked["dbtable"]
        return next((rows for start, rows in self.answers.items() if name.startswith(start)), "rows")

    def jdbc(self, url, table, predicates, properties):
        assert "url" not in properties and properties["user"] == "u"
        self.loads.append({"url": url, "dbtable": table, "predicates": predicates})
        return "rows"


def jdbc(spark, dialect="postgres", answers=None, **settings):
    reader = Reader(answers or {})
    return JdbcSource(reader, dialect, {**SETTINGS, "auto_splits": False, **settings}), reader


def tiles(spark, values: list, count: int):
    """What NTILE gives for sorted values."""
    size, more = divmod(len(values), count)
    rows, at = [], 0
    for i in range(count):
        own = values[at : at + size + (i < more)]
        at += len(own)
        if own:
            rows.append((i + 1, own[0], own[-1]))
    return spark.createDataFrame(rows[::-1])


def kept(predicate: str, values: list) -> list:
    """Values that a split's condition accepts, in DuckDB."""
    import duckdb

    connection = duckdb.connect()
    connection.execute("CREATE TABLE t (id BIGINT)")
    connection.executemany("INSERT INTO t VALUES (?)", [(v,) for v in values])
    return [row[0] for row in connection.execute(f"SELECT id FROM t WHERE {predicate}").fetchall()]


def test_split_points_follow_the_rows(spark):
    """Gaps, a value with a third of the rows, and nulls: every row lies in one range, and ranges are about as large."""
    values = sorted([*range(100), *[50] * 120, *range(10**9, 10**9 + 140)])
    source, reader = jdbc(spark, answers={"SELECT tile": tiles(spark, values, 12)})
    for _ in range(2):
        source.scan("orders", "id", 12)
    asked, *reads = reader.loads
    assert asked["query"] == (
        'SELECT tile, MIN(v) AS low, MAX(v) AS high FROM (SELECT "id" AS v, NTILE(12) OVER (ORDER BY "id") AS tile'
        ' FROM orders WHERE "id" IS NOT NULL) tiled GROUP BY tile'
    )
    assert len(reads) == 2 and reads[0] == reads[1]
    predicates = reads[0]["predicates"]
    rows = [None, None, -5, 10**12, *values]
    parts = [kept(p, rows) for p in predicates]
    assert sorted(map(str, sum(parts, []))) == sorted(map(str, rows))
    assert '"id" = 50' in predicates and None in parts[0]
    assert max(len(part) for part, p in zip(parts, predicates, strict=True) if "= 50" not in p) <= 2 * len(values) / 12


def test_split_literals_by_dialect():
    import datetime as dt

    day, time = dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5, 6000)
    forms = {
        "postgres": ("'2024-01-02'", "'2024-01-02 03:04:05.006000'"),
        "sqlserver": ("'2024-01-02'", "'2024-01-02T03:04:05.006000'"),
        "informix": ("MDY(1, 2, 2024)", "DATETIME (2024-01-02 03:04:05.00600) YEAR TO FRACTION(5)"),
    }
    for name, (date, timestamp) in forms.items():
        assert DIALECTS[name].literal(day) == date and DIALECTS[name].literal(time) == timestamp
        assert DIALECTS[name].split_predicates("d", [])  == []
    own = DIALECTS["sqlserver"].split_predicates("name", [("a", "it's"), ("j", "z")])
    assert own == ["[name] < 'a' OR [name] IS NULL", "[name] >= 'a' AND [name] < 'j'", "[name] >= 'j'"]


def test_split_tables_are_read_in_parallel_everywhere(spark):
    found = tiles(spark, list(range(800)), 8)
    source, reader = jdbc(spark, answers={"SELECT tile": found}, splits={"orders": ("id", 8)})
    for _ in range(3):
        source.table("orders")
    source.scan("other")
    bounds, *reads = reader.loads
    assert "NTILE(8)" in bounds["query"]
    assert [len(r["predicates"]) for r in reads[:3]] == [9] * 3
    assert "predicates" not in reads[3]
    with pytest.raises(ValueError):
        jdbc(spark, splits={"orders": ("id; drop", 8)})


@pytest.mark.parametrize("dialect", ["postgres", "sqlserver", "informix"])
def test_large_tables_are_split_by_their_key_unasked(spark, dialect):
    own = DIALECTS[dialect]
    asked = {"name": "orders", "table": "orders", "schema": "public"}
    answers = {
        own.estimated_rows.format(**asked): spark.createDataFrame([(2_600_000,)], "n long"),
        own.key_column.format(**asked): spark.createDataFrame([("id ",)], "c string"),
        own.estimated_rows.format(**(asked | {"name": "s.few", "table": "few", "schema": "s"})): spark.createDataFrame([(9,)], "n long"),
        "SELECT tile": tiles(spark, list(range(600)), 6),
    }
    source, reader = jdbc(spark, dialect, answers, auto_splits=True)
    source.table("orders")
    source.table("s.few")
    source.table("orders")
    assert source.split_of("orders") == ("id", 6) and source.split_of("s.few") is None
    assert [len(load.get("predicates", [])) for load in reader.loads if "query" not in load] == [7, 0, 7]
    assert sum("query" in load for load in reader.loads) == 4  # rows, key, tiles; rows


COLUMNS = "id long, day date, note string, open boolean, price decimal(9,2), body binary"


def test_pages_are_cut_inside_the_database(spark):
    answers = {"orders": spark.createDataFrame([], COLUMNS), "SELECT": "page"}
    source, reader = jdbc(spark, answers=answers, keys={"orders": ["id"]})
    assert source.page("orders", ["day", "id"], 200, 50) == "page"
    assert reader.loads[-1]["query"] == 'SELECT * FROM orders ORDER BY "day" NULLS FIRST, "id" NULLS FIRST LIMIT 50 OFFSET 200'
    # Without a known key all other plain columns settle ties.
    source, reader = jdbc(spark, "sqlserver", answers)
    assert source.page("orders", "day", 20, 5) == "page"
    assert reader.loads[-1]["query"] == "SELECT * FROM orders ORDER BY [day], [id], [note], [open], [price] OFFSET 20 ROWS FETCH NEXT 5 ROWS ONLY"
    source, reader = jdbc(spark, "informix", answers, keys={"orders": "id"})
    assert source.page("orders", "day", 20, 5) == "page"
    assert reader.loads[-1]["query"] == "SELECT SKIP 20 FIRST 5 * FROM orders ORDER BY day, id"
    with pytest.raises(ValueError):
        source.page("orders", "id", -1, 5)


def entry(name, operator, value=None, to=None):
    return {"column": {"name": name}, "operator": operator, "value": value, "valueTo": to}


FORMS = [
    (entry("id", ">", 5.5), "{id} > 5.5"),
    (entry("id", "IN", "3, 4"), "{id} IN ('3', '4')"),
    (entry("id", "NOT_BETWEEN", 1, 9), "{id} NOT BETWEEN 1 AND 9"),
    (entry("NOTE", "=", "O'Hara; DROP TABLE x --"), "{note} = 'O''Hara; DROP TABLE x --'"),
    (entry("note", "EQUALS", 7), "{note} = '7'"),
    (entry("note", "STARTS_WITH", "a_%"), "{note} LIKE 'a_%%'"),
    (entry("note", "NOT_CONTAIN", "x"), "{note} NOT LIKE '%x%'"),
    (entry("day", "!=", "2024-01-02"), "{day} <> '2024-01-02'"),
    (entry("day", "IS_NOT_NULL"), "{day} IS NOT NULL"),
]


@pytest.mark.parametrize("dialect", ["postgres", "sqlserver", "informix"])
def test_filters_run_inside_the_database(spark, dialect):
    counted = spark.createDataFrame([(4,)], "N long")
    answers = {"orders": spark.createDataFrame([], COLUMNS), "SELECT COUNT": counted}
    source, reader = jdbc(spark, dialect, answers, keys={"orders": "id"})
    names = {n: DIALECTS[dialect].quote.format(n) for n in ("id", "note", "day")}
    for payload, text in FORMS:
        text = text.format(**names) + (" ESCAPE '\\'" if dialect == "sqlserver" and "LIKE" in text else "")
        source.page("orders", "day", 0, 5, [payload])
        query = reader.loads[-1]["query"]
        assert f" WHERE {text} ORDER BY " in query
        assert source.count_rows("orders", [payload]).first().n == 4
        assert reader.loads[-1]["query"] == f"SELECT COUNT(*) AS n FROM orders WHERE {text}"
    both = [FORMS[0][0], entry("open", "=", "yes"), {"bad": 1}]
    truth = {"postgres": "TRUE", "sqlserver": "1", "informix": "'t'"}[dialect]
    assert source.where("orders", both) == f" WHERE {names['id']} > 5.5 AND {DIALECTS[dialect].quote.format('open')} = {truth}"
    with pytest.raises(ValueError, match="unknown column"):
        source.page("orders", "id", 0, 5, [entry("nobody", "=", 1)])


def test_regexes_run_where_the_database_has_them(spark):
    """Elsewhere the filter runs in Spark, in the same order."""
    rows = spark.createDataFrame([(3, None, "ab"), (1, None, "abc"), (2, None, "b"), (4, 0, "ab")], "id long, day int, note string")
    wanted = [entry("note", "MATCHES", "^a'b$")]
    source, reader = jdbc(spark, "postgres", {"orders": rows}, keys={"orders": "id"})
    source.page("orders", "day", 0, 2, wanted)
    assert reader.loads[-1]["query"].startswith("SELECT * FROM orders WHERE \"note\" ~ '^a''b$' ORDER BY")
    source, reader = jdbc(spark, "sqlserver", {"orders": rows}, keys={"orders": "id"})
    page = source.page("orders", "day", 0, 3, [entry("note", "MATCHES", "^ab")])
    assert [r.id for r in page.collect()] == [1, 3, 4]  # nulls of the key first, ties by the table's key
    assert source.count_rows("orders", [entry("note", "NOT_MATCHES", "^ab")]).first().n == 1


def test_patterns_mean_the_same_in_every_dialect():
    from tablebridge.sources.dialects import NotInDialect
    from pyspark.sql import types as T

    server, postgres = DIALECTS["sqlserver"], DIALECTS["postgres"]
    assert server.condition(("a", "contains", "[x]%", None), T.StringType()) == "[a] LIKE '%\\[x]%%' ESCAPE '\\'"
    assert postgres.condition(("a", "not_contains", "[x]", None), T.StringType()) == "\"a\" NOT LIKE '%[x]%'"
    for condition in [("a", "matches", "x", None), ("a", "=", float("nan"), None), ("a", "=", "a\x00", None)]:
        with pytest.raises(NotInDialect):
            server.condition(condition, T.StringType())


def test_a_reload_is_one_transaction(spark):
    """Rows go beside the table first; nothing touches the table if that fails."""
    done = []

    class Kept(JdbcSource):
        def writer(self, df, name, connections):
            done.append(("write", name, connections))

            class Writer:
                def mode(self, how):
                    assert how == "overwrite"
                    return self

                def save(self):
                    if df.count() == 3:
                        raise RuntimeError("the connection broke")

            return Writer()

        def execute(self, statements):
            done.append(list(statements))

    source = Kept(spark, "postgres", SETTINGS)
    rows = spark.range(2).select("id", F.lit("x").alias("note"))
    source.reload(rows, "s.orders", 4)
    assert done == [
        ("write", "s.orders__load", 4),
        ["DELETE FROM s.orders", 'INSERT INTO s.orders ("id", "note") SELECT "id", "note" FROM s.orders__load'],
        ["DROP TABLE s.orders__load"],
    ]
    done.clear()
    with pytest.raises(RuntimeError):
        source.reload(spark.range(3).toDF("id"), "orders")
    assert done == [("write", "orders__load", 16)]
    source.truncate("orders")
    assert done[-1] == ["DELETE FROM orders"]
    assert DIALECTS["sqlserver"].swap_statements("t", "u", ["a"])[1] == "INSERT INTO t ([a]) SELECT [a] FROM u"
