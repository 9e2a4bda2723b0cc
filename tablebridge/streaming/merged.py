"""A target that holds the newest change of each key, merged bucket by bucket.

Keys are dealt to buckets by hash. A batch of changes reads and rewrites only the buckets it touches; all others keep
their files. What the target is made of is said by one small manifest for each merge, whose completion is
the switch: readers see the target before a batch or after it, and a batch that runs again is known by its number. The target
is the state, so a stream that feeds it keeps none of its own.

Deletes are kept as tombstones, which hide a key and outlive late changes to it. With ``keep`` the state ends: tombstones older
than the newest change less ``keep`` are dropped, and so are changes that come later than that.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablebridge.functions.hashing import row_hash
from tablebridge.functions.naming import name_list, ref
from tablebridge.operators.deltas import CHANGE_TIME, changes_since
from tablebridge.session import file_system, hadoop_path

log = logging.getLogger(__name__)

BUCKET, DELETED = "__bucket", "__deleted"


class MergedTarget:
    """Newest changes under a path; ``deleted`` says of a change whether it deletes its key."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: str | Sequence[str],
        schema: T.StructType,
        ts: str = CHANGE_TIME,
        deleted: Column | None = None,
        buckets: int = 64,
        keep: dt.timedelta | None = None,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.ts, self.buckets, self.keep = name_list(keys), ts, buckets, keep
        self.deleted = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
        self._stored = T.StructType([*schema.fields, T.StructField(DELETED, T.BooleanType())])
        self._lines = T.StructType(
            [
                T.StructField("bucket", T.IntegerType()),
                T.StructField("folder", T.StringType()),
                T.StructField("batch", T.LongType()),
                T.StructField("newest", schema[ts].dataType),
                T.StructField("oldest_tombstone", schema[ts].dataType),
            ]
        )

    def versions(self) -> list[int]:
        """Finished merges, oldest first."""
        folder = hadoop_path(self.spark, f"{self.path}/commits")
        files = file_system(self.spark, self.path)
        if not files.exists(folder):
            return []
        found = [int(status.getPath().getName()) for status in files.listStatus(folder)]
        return sorted(v for v in found if files.exists(hadoop_path(self.spark, f"{self._commit(v)}/_SUCCESS")))

    def manifest(self, version: int | None = None) -> list:
        """One line per bucket: its folder and oldest tombstone, with the last batch and the newest change of the whole target."""
        known = self.versions()
        if not known:
            return []
        return self.spark.read.schema(self._lines).parquet(self._commit(known[-1] if version is None else version)).collect()

    def read(self) -> DataFrame:
        """The newest change of each key that is not deleted."""
        rows = self._rows([line["folder"] for line in self.manifest() if line["folder"]])
        return rows.where(~F.col(DELETED)).select([ref(f.name) for f in self.schema.fields])

    def merge(self, changes: DataFrame, batch: int, since: str | dt.date | dt.datetime | None = None) -> list[int]:
        """Take a batch of changes in; the buckets that were rewritten. A batch that was merged before does nothing."""
        lines = {line["bucket"]: line for line in self.manifest()}
        if lines and batch <= max(line["batch"] for line in lines.values()):
            return []
        rows = changes_since(changes, since, self.ts).withColumn(DELETED, self.deleted)
        newest = max((line["newest"] for line in lines.values()), default=None)
        if self.keep is not None and newest is not None:
            rows = rows.where(ref(self.ts) > F.lit(newest - self.keep))
        own = self._newest(rows.withColumn(BUCKET, self._bucket()))
        seen = {row[0]: row[1] for row in own.groupBy(BUCKET).agg(F.max(ref(self.ts))).collect()}  # a row per bucket
        if not seen:
            return []
        newest = max([*seen.values(), *([newest] if newest is not None else [])])
        old = self._rows([lines[b]["folder"] for b in seen if b in lines]).withColumn(BUCKET, self._bucket())
        merged = self._newest(old.unionByName(own))
        if self.keep is not None:
            merged = merged.where(~F.col(DELETED) | (ref(self.ts) > F.lit(newest - self.keep)))
        return self._write(merged, sorted(seen), lines, batch, newest)

    def expire(self) -> list[int]:
        """Drop tombstones that ``keep`` no longer holds, from the buckets that have some; their numbers."""
        lines = {line["bucket"]: line for line in self.manifest()}
        if self.keep is None or not lines:
            return []
        newest = max(line["newest"] for line in lines.values())
        end = newest - self.keep
        stale = sorted(b for b, line in lines.items() if line["oldest_tombstone"] is not None and line["oldest_tombstone"] <= end)
        if stale:
            rows = self._rows([lines[b]["folder"] for b in stale]).withColumn(BUCKET, self._bucket())
            self._write(rows.where(~F.col(DELETED) | (ref(self.ts) > F.lit(end))), stale, lines, max(line["batch"] for line in lines.values()), newest)
        return stale

    def vacuum(self, keep_versions: int = 2) -> int:
        """Delete files that none of the last merges names; how many folders went."""
        known = self.versions()[-max(keep_versions, 1) :]
        used = {line["folder"] for v in known for line in self.manifest(v)}
        files = file_system(self.spark, self.path)
        gone = 0
        for merge in files.listStatus(hadoop_path(self.spark, f"{self.path}/data")):
            if known and int(merge.getPath().getName()) > known[-1]:
                continue  # still being written
            for bucket in files.listStatus(merge.getPath()):
                name = bucket.getPath().getName()
                folder = f"{self.path}/data/{merge.getPath().getName()}/{name}"
                if name.startswith(f"{BUCKET}=") and folder not in used:
                    gone += files.delete(bucket.getPath(), True)
        return gone

    def _commit(self, version: int) -> str:
        return f"{self.path}/commits/{version:010d}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[ref(name) for name in self.keys]), F.lit(self.buckets)).cast("int")

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self._stored)
        return self.spark.read.schema(self._stored).parquet(*folders)

    def _newest(self, rows: DataFrame) -> DataFrame:
        """One row per key; each task keeps one per key before the shuffle. Equal times are decided as in ``latest_changes``."""
        hashed = row_hash(rows.select([ref(f.name) for f in self.schema.fields]))
        row = F.struct(*[ref(name) for name in rows.columns])
        newest = F.max_by(row, F.struct(ref(self.ts), hashed)).alias("__row")
        return rows.groupBy(*[ref(name) for name in self.keys]).agg(newest).select("__row.*")

    def _write(self, rows: DataFrame, touched: list[int], lines: dict, batch: int, newest) -> list[int]:
        known = self.versions()
        version = known[-1] + 1 if known else 0
        folder = f"{self.path}/data/{version:010d}"
        rows.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        stored = T.StructType([*self._stored.fields, T.StructField(BUCKET, T.IntegerType())])
        ends = self.spark.read.schema(stored).parquet(folder).groupBy(BUCKET).agg(F.min(F.when(F.col(DELETED), ref(self.ts))).alias("oldest"))
        oldest = {row[BUCKET]: row["oldest"] for row in ends.collect()}
        # Every line carries the last batch and the newest change, which hold for the whole target.
        kept = [(line["bucket"], line["folder"], batch, newest, line["oldest_tombstone"]) for bucket, line in lines.items() if bucket not in touched and line["folder"]]
        # A bucket whose last rows went has no folder any more.
        new = [(b, f"{folder}/{BUCKET}={b}", batch, newest, oldest[b]) for b in touched if b in oldest]
        gone = [] if kept or new else [(-1, None, batch, newest, None)]
        manifest = self.spark.createDataFrame([*kept, *new, *gone], self._lines).coalesce(1)
        manifest.write.mode("overwrite").parquet(self._commit(version))
        return touched


def merge_stream(
    stream: DataFrame,
    target: MergedTarget,
    checkpoint: str,
    since: str | dt.date | dt.datetime | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Merge each micro-batch of a change stream into a target; with ``available_now`` until the input is used up."""

    def store(rows: DataFrame, batch: int) -> None:
        touched = target.merge(rows, batch, since)
        log.info("batch %d rewrote %d of %d buckets", batch, len(touched), target.buckets)

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()
