"""Tables written to the shared folder, to cut lineage and to read a costly result twice."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablebridge.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df`, written once to the shared folder of the cluster and read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
