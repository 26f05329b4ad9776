"""Reading the driver tables: one parquet file per relation in a directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.operators.partitioning import spread_for_cpu


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of long texts, spread over the cores when it arrives in too few splits."""
    return spread_for_cpu(table(spark, sf_dir, name))
