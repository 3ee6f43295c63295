"""Parquet table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan ``{root}/{name}.parquet`` (column pruning and filter pushdown are left to
    Catalyst: only the columns a plan uses reach ``ReadSchema``)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
