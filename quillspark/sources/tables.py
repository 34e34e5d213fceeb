"""Parquet table access for the driver-generated tables.

Readers return lazy frames; Catalyst prunes columns and pushes filters into
the Parquet scan, so callers just ``select``/``where`` what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale-factor folder, e.g. ``table(s, d, "orders")``."""
    if name not in TABLE_NAMES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to all tables of one folder: ``Tables(s, d).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
