"""Parquet table access by directory and name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of ``sf_dir``; columns are pruned by the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
