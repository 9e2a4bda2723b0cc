"""Sources by kind."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import SparkSession

from tablebridge.sources.base import Source
from tablebridge.sources.files import CatalogSource, ParquetSource
from tablebridge.sources.jdbc import DRIVERS, JdbcSource


def open_source(spark: SparkSession, kind: str, settings: Mapping[str, Any]) -> Source:
    """A source from its kind and settings.

    ``postgres``, ``sqlserver`` and ``informix`` take connection settings,
    ``parquet`` a ``folder``, ``catalog`` a ``database``.
    """
    if kind in DRIVERS:
        return JdbcSource(spark, kind, settings)
    if kind == "parquet":
        return ParquetSource(spark, settings["folder"])
    if kind == "catalog":
        return CatalogSource(spark, settings.get("database", "default"))
    raise ValueError(f"unknown source kind: {kind!r}")
