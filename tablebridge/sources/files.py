"""A folder of parquet tables, and a database of the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablebridge.sources.base import Source


class ParquetSource(Source):
    """Tables as ``<folder>/<name>.parquet``, files or folders of files."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark)
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def table_names(self) -> DataFrame:
        """Tables found by listing the folder and its tables' own; file contents are not read."""
        files = self.spark.read.format("binaryFile").load(f"{self.folder}/*.parquet").select("path")
        name = F.regexp_extract("path", r"/([^/]+)\.parquet(?:/[^/]*)*$", 1)
        return files.select(name.alias("table_name")).where(F.col("table_name") != "").distinct()

    def stream(self, name: str, **options: str) -> DataFrame:
        """The table's files as a stream; new files are new rows."""
        reader = self.spark.readStream.schema(self.table(name).schema)
        # A pattern, because a stream does not take the path of a single file.
        return reader.options(**options).parquet(f"{self.folder}/[{name[0]}]{name[1:]}.parquet")


class CatalogSource(Source):
    """Tables and views of one database of the session catalog."""

    def __init__(self, spark: SparkSession, database: str = "default"):
        super().__init__(spark)
        self.database = database

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"`{self.database}`.`{name}`")

    def table_names(self) -> DataFrame:
        tables = self.spark.sql(f"SHOW TABLES IN `{self.database}`")
        return tables.where(~F.col("isTemporary")).select(F.col("tableName").alias("table_name"))
