"""Repeat each row by an integer weight (C12): a weighted table as one row per unit.

A naive ``explode(array_repeat(x, n))`` builds an n-element array in one task, so one hot row
(one keyword holding a third of all appearances) would sit in one task's memory. Here a weight is
cut into bounded pieces over three rounds, with a round-robin repartition after the first two, so
no array is long and the pieces of a hot key spread over all tasks. The round-robin repartitions
stay deterministic under task retries (Spark sorts rows before dealing them out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_FANOUT = 1 << 12


def _cut(df: DataFrame, piece: F.Column) -> DataFrame:
    """Cut each range [_lo, _hi) into consecutive pieces of ``piece`` units (last one shorter)."""
    return (df.withColumn("_piece", piece)
            .withColumn("_lo", F.explode(F.sequence(F.col("_lo"), F.col("_hi") - 1, F.col("_piece"))))
            .withColumn("_hi", F.least(F.col("_lo") + F.col("_piece"), F.col("_hi")))
            .drop("_piece"))


def weight_chunks(df: DataFrame, weight_col: str, max_chunk: int = DEFAULT_FANOUT,
                  fanout: int = DEFAULT_FANOUT, spread: bool = True, chunk_name: str = "chunk") -> DataFrame:
    """Each row as pieces whose ``chunk`` sizes sum to its weight, each at most ``max_chunk``
    (NULL or non-positive weight: no piece); ``weight_col`` is dropped.

    Three rounds cut a weight w into pieces of max(max_chunk, w / fanout), then
    max(max_chunk, w / fanout**2), then max_chunk units, so each round makes at most about
    ``fanout`` pieces of a range (for w up to ``fanout**3 * max_chunk``) and a light row stays whole.
    """
    cols = [c for c in df.columns if c != weight_col]
    ranges = df.filter(F.col(weight_col) > 0).select(
        *cols, F.col(weight_col).cast("long").alias("_w"),
        F.lit(0).cast("long").alias("_lo"), F.col(weight_col).cast("long").alias("_hi"))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    floor = F.lit(max_chunk).cast("long")
    for level in (1, 2):
        ranges = _cut(ranges, F.greatest(floor, F.ceil(F.col("_w") / F.lit(float(fanout) ** level)).cast("long")))
        if spread:
            ranges = ranges.repartition(partitions)
    ranges = _cut(ranges, floor)
    return ranges.select(*cols, (F.col("_hi") - F.col("_lo")).alias(chunk_name))


def repeat_by_weight(df: DataFrame, weight_col: str, max_chunk: int = DEFAULT_FANOUT,
                     fanout: int = DEFAULT_FANOUT, spread: bool = True) -> DataFrame:
    """Each row ``weight`` times (NULL or non-positive weight: no row); ``weight_col`` is dropped."""
    chunks = weight_chunks(df, weight_col, max_chunk, fanout, spread, "_chunk")
    cols = [c for c in chunks.columns if c != "_chunk"]
    return chunks.select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_chunk"))).alias("_unit")) \
        .drop("_unit")
