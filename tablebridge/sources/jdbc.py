"""Databases over JDBC.

Spark opens the connections, on the executors that read; the driver jar of the
database must be on the class path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.naming import checked_name, name_list
from tablebridge.functions.text import stringify
from tablebridge.operators.filters import checked_conditions
from tablebridge.sources.base import Source
from tablebridge.sources.dialects import DIALECTS, NotInDialect

# Rows per fetch and seconds to connect.
FETCH_ROWS = 10_000
CONNECT_SECONDS = 10

DRIVERS = {
    "postgres": "org.postgresql.Driver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "informix": "com.informix.jdbc.IfxDriver",
}
# Each dialect's catalog query for user tables.
TABLE_LISTS = {
    "postgres": (
        "SELECT table_name FROM information_schema.tables"
        " WHERE table_type = 'BASE TABLE' AND table_schema = '{schema}'"
    ),
    "sqlserver": "SELECT name AS table_name FROM sys.tables WHERE is_ms_shipped = 0",
    "informix": (
        "SELECT tabname AS table_name FROM systables"
        " WHERE tabtype = 'T' AND tabname NOT LIKE 'sys%'"
    ),
}
_REQUIRED = ("host", "user", "password", "port", "database")


def jdbc_options(dialect: str, settings: Mapping[str, Any]) -> dict[str, str]:
    """Connection settings as options of Spark's JDBC source."""
    if dialect not in DRIVERS:
        raise ValueError(f"unknown dialect: {dialect!r}")
    missing = [name for name in _REQUIRED if not settings.get(name)]
    if missing:
        raise ValueError(f"missing connection settings: {', '.join(missing)}")
    host, port, database = settings["host"], settings["port"], settings["database"]
    if dialect == "postgres":
        schema = settings.get("schema") or "public"
        url = (
            f"jdbc:postgresql://{host}:{port}/{database}"
            f"?connectTimeout={CONNECT_SECONDS}&currentSchema={schema}"
        )
    elif dialect == "sqlserver":
        url = (
            f"jdbc:sqlserver://{host}:{port};databaseName={database};"
            f"loginTimeout={CONNECT_SECONDS}"
        )
    else:
        # Spark quotes names with double quotes, which Informix takes for text
        # unless DELIMIDENT is set.
        properties = {"DELIMIDENT": "y", "LOGINTIMEOUT": str(CONNECT_SECONDS * 1000)}
        if settings.get("server"):
            properties["INFORMIXSERVER"] = str(settings["server"])
        if settings.get("locale"):
            properties["CLIENT_LOCALE"] = properties["DB_LOCALE"] = str(settings["locale"])
        text = ";".join(f"{key}={value}" for key, value in properties.items())
        url = f"jdbc:informix-sqli://{host}:{port}/{database}:{text}"
    return {
        "url": url,
        "driver": DRIVERS[dialect],
        "user": str(settings["user"]),
        "password": str(settings["password"]),
        "fetchsize": str(FETCH_ROWS),
        # Times without a zone stay without one.
        "preferTimestampNTZ": "true",
    }


# Rows that a task reads of a table that is split without being told how, and the rows from which on it is.
ROWS_PER_SPLIT = 500_000
MOST_SPLITS = 1_000


class JdbcSource(Source):
    """One database. Pages and counts run inside it, filters included where its SQL has a form for them.

    A table is read in parallel by a column whose quantiles the database is asked for once: the one that
    the setting ``splits`` names with a number of ranges by table, as ``{"orders": ("id", 64)}``, else the first
    column of the primary key, with a range for each ``ROWS_PER_SPLIT`` rows that the database's statistics count.
    Smaller tables and those without a key are read by one task, as is everything with ``auto_splits`` off. The setting
    ``keys`` names the key columns by table, which settle ties of a page's order.
    """

    def __init__(self, spark: SparkSession, dialect: str, settings: Mapping[str, Any]):
        super().__init__(spark)
        self.options = jdbc_options(dialect, settings)
        self.dialect = DIALECTS[dialect]
        self.schema = settings.get("schema") or "public"
        self.ties = "all" if dialect == "informix" else "one"
        self.splits = {
            name: (checked_name(column), int(count))
            for name, (column, count) in (settings.get("splits") or {}).items()
        }
        self.keys = {name: name_list(keys) for name, keys in (settings.get("keys") or {}).items()}
        self.auto_splits = bool(settings.get("auto_splits", True))
        self._predicates: dict[tuple[str, str, int], list[str]] = {}
        self._automatic: dict[str, tuple[str, int] | None] = {}

    def reader_options(self, name: str) -> dict[str, str]:
        return {**self.options, "dbtable": checked_name(name)}

    def table(self, name: str) -> DataFrame:
        column, count = self.split_of(name) or (None, 0)
        return self.scan(name, column, count)

    def split_of(self, name: str) -> tuple[str, int] | None:
        """Column and number of ranges that a table is read by."""
        if name in self.splits or not self.auto_splits:
            return self.splits.get(name)
        if name not in self._automatic:
            *schema, table = checked_name(name).split(".")
            asked = {"name": name, "table": table, "schema": schema[-1] if schema else checked_name(self.schema)}
            self._automatic[name] = None
            rows = self._one(self.dialect.estimated_rows.format(**asked))
            if rows and rows > ROWS_PER_SPLIT:
                column = self._one(self.dialect.key_column.format(**asked))
                if column:
                    count = min(MOST_SPLITS, -(-int(rows) // ROWS_PER_SPLIT))
                    self._automatic[name] = (checked_name(str(column).strip()), count)
        return self._automatic[name]

    def _one(self, statement: str) -> Any:
        found = self.run(statement).first()
        return found[0] if found else None

    def predicates(self, name: str, column: str, splits: int) -> list[str]:
        """Conditions that part a table into about equally many rows; asked of the database once."""
        key = (name, column, splits)
        if key not in self._predicates:
            tiles = self.run(self.dialect.quantile_statement(name, column, splits)).collect()
            tiles.sort(key=lambda tile: tile[0])
            self._predicates[key] = self.dialect.split_predicates(column, [(tile[1], tile[2]) for tile in tiles])
        return self._predicates[key]

    def run(self, statement: str) -> DataFrame:
        """A statement that runs inside the database."""
        return self.spark.read.format("jdbc").options(**self.options, query=statement).load()

    def table_names(self) -> DataFrame:
        names = self.run(TABLE_LISTS[self.dialect.name].format(schema=checked_name(self.schema)))
        return names.select(F.col(names.columns[0]).alias("table_name"))

    def scan(self, name: str, split_column: str | None = None, splits: int = 0) -> DataFrame:
        """The whole table; with a column to split on, in ranges that hold about equally many rows each.

        Gaps cost nothing, and a value with many rows has a range of its own. Nulls join the first range."""
        if split_column and splits > 1:
            parts = self.predicates(name, split_column, splits)
            if len(parts) > 1:
                rest = {key: value for key, value in self.options.items() if key != "url"}
                return self.spark.read.jdbc(self.options["url"], checked_name(name), predicates=parts, properties=rest)
        return self.spark.read.format("jdbc").options(**self.reader_options(name)).load()

    def types(self, name: str) -> dict[str, Any]:
        """Columns and their types; no rows are read."""
        bare = self.spark.read.format("jdbc").options(**self.reader_options(name)).load()
        return {field.name: field.dataType for field in bare.schema.fields}

    def order_columns(self, name: str, order_by: str | Sequence[str]) -> list[str]:
        """The order of a page: its keys, then what settles ties, the table's key or else all other plain columns."""
        own = name_list(order_by)
        if name in self.keys:
            rest = self.keys[name]
        else:
            rest = [n for n, dtype in self.types(name).items() if isinstance(dtype, T.AtomicType) and not isinstance(dtype, T.BinaryType)]
        known = {n.lower() for n in own}
        return [*own, *(n for n in rest if n.lower() not in known)]

    def where(self, name: str, filters: Any, strict: bool = False) -> str | None:
        """The filters as a WHERE clause; None if the database's SQL has no form for one of them."""
        conditions = checked_conditions(filters, strict)
        if not conditions:
            return ""
        try:
            return self.dialect.where(conditions, self.types(name))
        except NotInDialect:
            return None

    def page(
        self,
        name: str,
        order_by: str | Sequence[str],
        offset: int = 0,
        limit: int = 100,
        filters: Any = None,
        strict: bool = False,
    ) -> DataFrame:
        """A page of rows that the database filters, orders and cuts itself.

        The order is the same with filters and without: keys, nulls first, then ``order_columns``. Filters that the database has
        no form for are applied in Spark, which then orders by the same columns; texts there sort by their code points.
        """
        order = self.order_columns(name, order_by)
        where = self.where(name, filters, strict)
        if where is None:
            return super().page(name, order, offset, limit, filters, strict)
        return self.run(self.dialect.page_statement(name, order, offset, limit, where))

    def page_text(
        self,
        name: str,
        order_by: str | Sequence[str],
        offset: int = 0,
        limit: int = 100,
        filters: Any = None,
        strict: bool = False,
    ) -> DataFrame:
        return stringify(self.page(name, order_by, offset, limit, filters, strict))

    def count_rows(self, name: str, filters: Any = None, strict: bool = False) -> DataFrame:
        where = self.where(name, filters, strict)
        if where is None:
            return super().count_rows(name, filters, strict)
        counted = self.run(self.dialect.count_statement(name, where))
        return counted.select(F.col(counted.columns[0]).cast("bigint").alias("n"))

    def min_max(self, name: str, column: str) -> DataFrame:
        found = self.run(self.min_max_statement(name, column))
        low, high = found.columns
        return found.select(F.col(low).alias("min_val"), F.col(high).alias("max_val"))

    def min_max_statement(self, name: str, column: str) -> str:
        quoted = self.dialect.column(column)
        return (
            f"SELECT MIN({quoted}) AS min_val, MAX({quoted}) AS max_val FROM {checked_name(name)}"
        )

    def preview(self, query: str, rows: int = 100) -> DataFrame:
        """The first rows of a query in the database's own SQL."""
        return self.run(query.strip().rstrip(";")).limit(rows)

    def writer(self, df: DataFrame, name: str, connections: int = 16) -> DataFrameWriter:
        """A writer into one of the database's tables.

        Executors write in parallel, through at most ``connections`` at a time.
        """
        return df.write.format("jdbc").options(**self.writer_options(name, connections))

    def writer_options(self, name: str, connections: int) -> dict[str, str]:
        return {
            **self.options,
            "dbtable": checked_name(name),
            "batchsize": str(FETCH_ROWS),
            "numPartitions": str(connections),
        }

    def reload(self, df: DataFrame, name: str, connections: int = 16) -> None:
        """Replace all rows of a table and keep its structure.

        The rows are first written to a table beside it, in parallel. One transaction then empties the table and fills it
        from there, so readers see the old rows or the new ones, and a load that fails leaves the old.
        """
        staged = f"{checked_name(name)}__load"
        self.writer(df, staged, connections).mode("overwrite").save()
        self.execute(self.dialect.swap_statements(name, staged, df.columns))
        self.execute([f"DROP TABLE {staged}"])

    def truncate(self, name: str) -> None:
        """Empty the table and keep its structure."""
        self.execute([f"DELETE FROM {checked_name(name)}"])

    def execute(self, statements: Sequence[str]) -> None:
        """Run statements in one transaction, on a connection of the driver."""
        jvm = self.spark._jvm
        jvm.java.lang.Class.forName(self.options["driver"], True, jvm.java.lang.Thread.currentThread().getContextClassLoader())
        login = jvm.java.util.Properties()
        login.setProperty("user", self.options["user"])
        login.setProperty("password", self.options["password"])
        connection = jvm.java.sql.DriverManager.getConnection(self.options["url"], login)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for text in statements:
                statement.executeUpdate(text)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()
