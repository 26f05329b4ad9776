"""Dimension lookup joins.

Whether a side is broadcast is decided by size, never assumed. By default Catalyst broadcasts a
side whose estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-plans a
sort-merge join into a broadcast when the shuffled side turns out small at run time; past those
bounds the join stays a shuffle join, with AQE splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def lookup_join(facts: DataFrame, dim: DataFrame, condition: Column | str | list,
                how: str = "left") -> DataFrame:
    """Join ``facts`` to a dimension; unmatched facts keep their row with NULL dimension columns
    (``how="left"``), and duplicated dimension keys duplicate fact rows, as in any equi-join."""
    return facts.join(dim, condition, how)
