"""Result ordering.

A global ``orderBy`` range-partitions the rows and sorts each range, so the output files read in
part order are the sorted whole, and no task holds more than its range. With AQE on, a small
result is coalesced into one partition, which gives the single ordered file of a report without
forcing one task on a large result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rank_by_count(df: DataFrame, count_col: str, key_col: str) -> DataFrame:
    """Count descending (NULLS LAST), then key ascending (NULLS FIRST): a total order (O1)."""
    return df.orderBy(F.col(count_col).desc_nulls_last(), F.col(key_col).asc_nulls_first())


def ordered(df: DataFrame, *order: Column | str) -> DataFrame:
    """Global sort on any columns."""
    return df.orderBy(*order)


def one_sorted_partition(df: DataFrame, *order: Column | str) -> DataFrame:
    """All rows in one partition, sorted inside it: one output file.

    Only for results of known small size (a report over a bounded number of groups). The
    shuffle into one partition sits after the aggregate, so the aggregate itself stays parallel.
    """
    return df.repartition(1).sortWithinPartitions(*order)
