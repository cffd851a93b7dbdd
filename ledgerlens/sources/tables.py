"""Scans of the base Parquet tables (S1) with explicit column pruning."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


class TableSource:
    """Reads ``{root}/{name}.parquet``; callers name the columns they need so
    the scan's ReadSchema stays narrow even before Catalyst prunes."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return os.path.join(self.root, f"{name}.parquet")

    def read(self, name: str, *cols: str) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        return df.select(*cols) if cols else df
