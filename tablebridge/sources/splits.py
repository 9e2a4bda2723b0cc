"""Equal ranges of a key column, and batches of rows inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.naming import ref, unused

# Fixed value: rows in a batch of a full scan.
BATCH_ROWS = 10_000


def split_number(column: str, low: int, high: int, splits: int) -> Column:
    """Which of ``splits`` equal ranges between the bounds a value is in."""
    if splits < 1:
        raise ValueError("splits must be positive")
    width = high - low + 1
    place = ref(column).cast("bigint")
    if width * splits >= 2**62 or abs(low) >= 2**62:
        place = place.cast(T.DecimalType(20, 0))
        scaled = F.floor((place - F.lit(Decimal(low))) * splits / F.lit(Decimal(width)))
    else:
        scaled = F.call_function("div", (place - low) * splits, F.lit(width))
    # least() would pass over a null.
    return F.when(place.isNotNull(), F.least(F.lit(splits - 1), scaled).cast("bigint"))


def with_splits(df: DataFrame, column: str, splits: int, name: str = "split") -> DataFrame:
    """Rows with the number of their range; null keys have none."""
    unused(df, name)
    bounds = df.agg(F.min(ref(column)).alias("low"), F.max(ref(column)).alias("high")).first()
    if bounds["low"] is None:
        return df.withColumn(name, F.lit(None).cast("bigint"))
    return df.withColumn(name, split_number(column, bounds["low"], bounds["high"], splits))


def map_batches(
    df: DataFrame,
    transform: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str | T.StructType,
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """Apply a function to batches of ``batch_rows`` rows, inside the tasks.

    A task holds one batch; only the last batch of a partition is smaller.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        missing = batch_rows
        for frame in frames:
            while len(frame) >= missing:
                held.append(frame.iloc[:missing])
                frame = frame.iloc[missing:]
                yield transform(pd.concat(held, ignore_index=True))
                held, missing = [], batch_rows
            if len(frame):
                held.append(frame)
                missing -= len(frame)
        if held:
            yield transform(pd.concat(held, ignore_index=True))

    return df.mapInPandas(run, schema)


def for_each_batch(
    df: DataFrame, consume: Callable[[pd.DataFrame], None], batch_rows: int = BATCH_ROWS
) -> None:
    """Hand every batch to a function on the executors.

    A task that is run again hands its batches out again.
    """

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        consume(batch)
        return pd.DataFrame({"rows": [len(batch)]})

    map_batches(df, run, "rows bigint", batch_rows).write.format("noop").mode("overwrite").save()
