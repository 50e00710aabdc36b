"""Parquet table scans of the input folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan of ``{sf_dir}/{name}.parquet`` (a file or a folder).

    Column pruning and filter pushdown happen in the scan, so callers just
    select/filter what they need.
    """
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)
