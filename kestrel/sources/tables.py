"""Named Parquet tables of a data folder (SRC-03 / SRC-04 stand-in).

Reading is lazy: a table is only scanned by the plan that uses it, and
Catalyst prunes its columns and pushes filters into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class Tables:
    """Attribute access to ``<folder>/<name>.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))
