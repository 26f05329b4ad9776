"""Database table read.

A single JDBC connection reads the whole table in one task. Give ``partition_column`` with bounds
and ``num_partitions`` so the read is split into ranges, one connection each; ``fetchsize`` sets
rows per round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetchsize: int = 10000) -> DataFrame:
    reader = (spark.read.format("jdbc")
              .option("url", url)
              .option("dbtable", table)
              .option("fetchsize", str(fetchsize)))
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound))
                  .option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()
