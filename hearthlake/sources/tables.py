"""Parquet table access.

Reads are lazy DataFrames; Catalyst prunes columns and pushes filters into
the parquet scan, so callers simply select what they need.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


class TableReader:
    """Resolves table names to DataFrames, either from a folder of
    ``<name>.parquet`` files or from catalog tables (``database`` set)."""

    def __init__(self, spark: SparkSession, root: str | None = None, database: str | None = None):
        self.spark = spark
        self.root = root
        self.database = database

    def __call__(self, name: str) -> DataFrame:
        """The table as a lazy DataFrame."""
        if self.root is not None:
            return self.spark.read.parquet(os.path.join(self.root, f"{name}.parquet"))
        return self.spark.table(f"{self.database}.{name}" if self.database else name)
