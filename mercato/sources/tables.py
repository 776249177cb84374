"""Parquet table access with explicit column lists (column pruning at the scan)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from mercato.session import session_key

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class Tables:
    """Lazy accessor for the Parquet tables of one directory.

    ``tables.read("orders", "o_orderkey", "o_custkey")`` selects only those
    columns, so the Parquet ReadSchema holds just them.
    """

    def __init__(self, spark: SparkSession, root: str, version: str = ""):
        self.spark = spark
        self.root = root
        self.version = version  # of the files, where the caller knows it

    def path(self, name: str) -> str:
        return os.path.join(self.root, f"{name}.parquet")

    def read(self, name: str, *columns: str) -> DataFrame:
        key = (session_key(self.spark), self.path(name), self.version)
        df = _OPENED.get(key)
        if df is None:
            df = _OPENED[key] = self.spark.read.parquet(self.path(name))
        return df.select(*columns) if columns else df


# One DataFrame per (session, file, version): the schema is read from the footer once.
_OPENED: dict[tuple[str, str, str], DataFrame] = {}
