"""Parquet table access for the driver's test tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_SCANS: dict = {}


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Read one table; selecting ``columns`` here lets the scan prune the rest.

    The scan DataFrame (a lazy plan, no data) is reused within a session so
    its schema is resolved once."""
    k = (spark.sparkContext.applicationId, table_path(sf_dir, name))
    if k not in _SCANS:
        _SCANS[k] = spark.read.parquet(table_path(sf_dir, name))
    df = _SCANS[k]
    return df.select(*columns) if columns else df
