"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


# What the library is tuned for. Only the UTC time zone touches results: it keeps
# the text of zoned timestamps the same on every machine.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app: str = "tablebridge", master: str | None = None, conf: Mapping[str, str] | None = None
) -> SparkSession:
    """A session with ``SETTINGS``, and with ``conf`` on top."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local session may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    fallback = tempfile.mkdtemp(prefix="tablebridge-")
    context.setCheckpointDir(fallback)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, in the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/tablebridge/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str) -> JavaObject:
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str) -> JavaObject:
    """The file system that a path lies in, as Spark reaches it."""
    return hadoop_path(spark, path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
