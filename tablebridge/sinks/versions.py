"""Loads that readers see as a whole: a folder for each, a manifest, and one switch of the table's location.

A load writes its rows to a new version folder below the table's own. When that is finished its
line goes into the manifest, and only then ``ALTER TABLE ... SET LOCATION`` points the table there. Until then
every reader sees the old rows, afterwards the new ones; a load that dies on the way leaves a
folder nobody reads. Old versions stay for readers that have begun, until they are expired.

For unpartitioned tables with a location of their own; the rows they were created with are version 0.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.literals import sql_text
from tablebridge.functions.naming import ref
from tablebridge.session import file_system, hadoop_path
from tablebridge.sinks.layout import Layout, arranged, layout_options, per_column, plan_layout

# The table property that lists a table's indexed columns.
INDEXED = "tablebridge.indexed"

_FOLDER = "_versions"
_MANIFEST = "_manifest"
MANIFEST_SCHEMA = "version long, path string, rows long, loaded timestamp"


def location(spark: SparkSession, table: str) -> str:
    """The folder a table reads now."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Location").first()
    if described is None:
        raise ValueError(f"{table} has no location")
    return described["data_type"].rstrip("/")


def home(spark: SparkSession, table: str) -> str:
    """The folder a table was created with."""
    return location(spark, table).split(f"/{_FOLDER}/")[0]


def can_switch(spark: SparkSession, table: str) -> bool:
    """Whether a table's loads can be versions: its files are its own, in one folder."""
    if spark.catalog.getTable(table).tableType != "EXTERNAL":
        return False
    return not any(column.isPartition for column in spark.catalog.listColumns(table))


def manifest(spark: SparkSession, table: str) -> DataFrame:
    """Finished loads of a table with the one it reads: version, path, rows, loaded, current."""
    base, now = home(spark, table), location(spark, table)
    path = f"{base}/{_MANIFEST}"
    loads = spark.createDataFrame([], MANIFEST_SCHEMA)
    if file_system(spark, path).exists(hadoop_path(spark, path)):
        loads = spark.read.schema(MANIFEST_SCHEMA).parquet(path)
    first = spark.createDataFrame([(0, base, None, None)], MANIFEST_SCHEMA)
    return first.union(loads).withColumn("current", F.col("path") == now)


def table_layout(spark: SparkSession, table: str) -> Layout:
    """The layout of a table whose columns were flagged as indexed when it was created."""
    noted = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return plan_layout(per_column(json.loads(noted.get(INDEXED, "[]"))), curve=True)


def write_version(df: DataFrame, table: str) -> str:
    """Write rows as a new version, with the table's columns and types, and enter it in the manifest; its folder.

    The table does not read it yet. The files are laid out by the table's indexed columns. Columns the rows lack take their defaults.
    """
    spark = df.sparkSession
    base = home(spark, table)
    own = set(df.columns)
    fields = spark.table(table).schema.fields

    def value(field: T.StructField) -> Column:
        if field.name in own:
            return ref(field.name)
        default = field.metadata.get("CURRENT_DEFAULT")
        return F.lit(None) if default is None else F.expr(default)

    rows = df.select([value(f).cast(f.dataType).alias(f.name) for f in fields])
    last = manifest(spark, table).agg(F.max("version")).first()[0]
    path = f"{base}/{_FOLDER}/{last + 1:08d}-{uuid.uuid4().hex}"
    layout = table_layout(spark, table)
    arranged(rows, layout).write.options(**layout_options(layout)).parquet(path)
    count = spark.read.schema(rows.schema).parquet(path).count()
    entry = spark.range(1).select(F.lit(last + 1).cast("long").alias("version"), F.lit(path).alias("path"), F.lit(count).cast("long").alias("rows"), F.current_timestamp().alias("loaded"))
    entry.write.mode("append").parquet(f"{base}/{_MANIFEST}")
    return path


def switch(spark: SparkSession, table: str, path: str) -> None:
    """Let a table read another of its versions: the one step that readers see."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION {sql_text(path)}")
    spark.catalog.refreshTable(table)


def load_version(df: DataFrame, table: str) -> str:
    """Replace all rows of a table by a new version; its folder."""
    path = write_version(df, table)
    switch(df.sparkSession, table, path)
    return path


def restore_version(spark: SparkSession, table: str, version: int) -> None:
    """Go back, or forward, to a finished load."""
    found = manifest(spark, table).where(F.col("version") == version).first()
    if found is None or not file_system(spark, found["path"]).exists(hadoop_path(spark, found["path"])):
        raise ValueError(f"{table} has no version {version}")
    switch(spark, table, found["path"])


def expire_versions(spark: SparkSession, table: str, keep: int = 2) -> Sequence[int]:
    """Delete the files of versions before the one in use, but for the last ``keep - 1``; the numbers of those that went.

    Folders of loads that died go with them; newer ones may still be loading and stay.
    """
    loads = manifest(spark, table).orderBy("version").collect()
    now = next(load["version"] for load in loads if load["current"])
    first_kept = now - max(keep, 1) + 1
    base = home(spark, table)
    files = file_system(spark, base)
    gone = []
    folder = hadoop_path(spark, f"{base}/{_FOLDER}")
    for status in files.listStatus(folder) if files.exists(folder) else []:
        version = int(status.getPath().getName().split("-")[0])
        if version < first_kept and files.delete(status.getPath(), True):
            gone.append(version)
    if first_kept > 0:
        for status in files.listStatus(hadoop_path(spark, base)):
            if not status.getPath().getName().startswith("_") and files.delete(status.getPath(), True):
                gone.append(0)
    return sorted(set(gone))
