"""Change capture as an incremental stream.

Instead of polling a log with a moving time, a stream keeps the newest change of
each key as state and writes the keys that changed in each micro-batch. State
holds one row per key and never expires: any key may change again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablebridge.functions.hashing import row_hash
from tablebridge.functions.naming import name_list, ref
from tablebridge.operators.deltas import CHANGE_TIME, changes_since

BATCH = "__batch"


def newest_by_key(
    stream: DataFrame,
    keys: str | Sequence[str],
    since: str | dt.date | dt.datetime | None,
    ts: str = CHANGE_TIME,
) -> DataFrame:
    """The newest change of each key so far; ties as in ``latest_changes``.

    Map tasks keep one row per key before the shuffle to the state.
    """
    changes = changes_since(stream, since, ts)
    row = F.struct(*[ref(name) for name in stream.columns])
    newest = F.max_by(row, F.struct(ref(ts), row_hash(stream)))
    return changes.groupBy(*[ref(name) for name in name_list(keys)]).agg(
        newest.alias("__row")
    ).select("__row.*")


def stream_deltas(
    stream: DataFrame,
    keys: str | Sequence[str],
    since: str | dt.date | dt.datetime | None,
    target: str,
    checkpoint: str,
    ts: str = CHANGE_TIME,
    available_now: bool = True,
) -> StreamingQuery:
    """Write each micro-batch's changed keys to ``target/__batch=N``.

    A batch that is run again overwrites its own folder, so each change arrives
    once. With ``available_now`` the query stops when the input is used up.
    """

    # A target without rows is a target too.
    empty = stream.sparkSession.createDataFrame([], stream.schema)
    empty.write.mode("ignore").parquet(f"{target}/{BATCH}=-1")

    def store(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{target}/{BATCH}={batch}")

    writer = (
        newest_by_key(stream, keys, since, ts)
        .writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
    )
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def stored_deltas(
    spark: SparkSession, target: str, keys: str | Sequence[str], schema: T.StructType
) -> DataFrame:
    """The newest change of each key from the stored batches.

    A later batch always holds the newer change of a key.
    """
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    stored = spark.read.schema(full).parquet(target)
    row = F.struct(*[ref(f.name) for f in schema.fields])
    newest = stored.groupBy(*[ref(name) for name in name_list(keys)]).agg(
        F.max_by(row, F.col(BATCH)).alias("__row")
    )
    return newest.select("__row.*")


def compact_deltas(
    spark: SparkSession,
    target: str,
    keys: str | Sequence[str],
    schema: T.StructType,
    new_target: str,
) -> None:
    """Start a new target with one row per key.

    Run it while the stream is stopped, then restart the stream on the new
    target with its old checkpoint: later batches follow on.
    """
    newest = stored_deltas(spark, target, keys, schema)
    newest.write.mode("overwrite").parquet(f"{new_target}/{BATCH}=-1")
