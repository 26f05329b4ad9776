"""Partition-count guard for CPU-heavy per-row work on small inputs.

Tokenizing long texts costs far more CPU per byte than scanning them. A small table often comes as one
row group, which one task would work through alone. ``spread_for_cpu`` deals the rows of such a table
round-robin over the cluster's default parallelism. It looks at the table's size, not at its splits:
beyond ``SMALL_BYTES`` the plan stays as it is, so the shuffle it may add is never larger than that.
Larger tables get their splits from ``spark.sql.files.maxPartitionBytes``.

Round-robin repartitioning survives executor loss: Spark sorts each input partition before
dealing its rows (``spark.sql.execution.sortBeforeRepartition``, on by default), so a recomputed
map task sends the same rows to the same partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

SMALL_BYTES = 64 << 20


def spread_for_cpu(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """``df``, dealt over ``partitions`` tasks if Spark's size estimate is at most SMALL_BYTES."""
    if df.isStreaming:
        return df
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size > SMALL_BYTES:
        return df
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)
