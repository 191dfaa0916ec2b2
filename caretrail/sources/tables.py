"""Readers for the parquet tables.

Every reader returns a lazy DataFrame; projection and filters written later reach the parquet scan
(``ReadSchema`` / ``PushedFilters``), so nothing here selects columns eagerly.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read ``<root>/<name>.parquet`` (a file or a folder of parts)."""
    return spark.read.parquet(os.path.join(root, f"{name}.parquet"))
