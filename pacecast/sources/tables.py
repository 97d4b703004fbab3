"""Parquet readers for the test tables.

Readers return the plain scan; callers select and filter so Catalyst
prunes columns (``ReadSchema``) and pushes date bounds into the scan
(``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one table (never reshuffled: splits are the reader's business)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


class TableSet:
    """Lazy access to the tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        # one (lazy) scan DataFrame per table: file listing and footers once
        if name not in self._frames:
            self._frames[name] = read_table(self.spark, self.sf_dir, name)
        return self._frames[name]
