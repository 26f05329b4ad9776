"""Database sinks (K3, K4).

Every Spark partition opens its own connection and commits its own transaction, so
``num_partitions`` bounds the connections the database sees, and one partition makes a write one
transaction. Rows go in batches of ``batchsize`` statements per round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append", truncate: bool = False, batchsize: int = 4096,
               isolation_level: str = "READ_COMMITTED", num_partitions: int | None = None) -> None:
    """Write rows to a database table.

    ``mode="overwrite", truncate=True`` replaces the rows and keeps the table definition (K3);
    without ``truncate`` the table is dropped and created again from the DataFrame's schema.
    ``truncate`` has no effect on appends.
    """
    writer = (df.write.format("jdbc")
              .mode(mode)
              .option("url", url)
              .option("dbtable", table)
              .option("batchsize", str(batchsize))
              .option("isolationLevel", isolation_level))
    if truncate and mode == "overwrite":
        writer = writer.option("truncate", "true")
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    writer.save()
