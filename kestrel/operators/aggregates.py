"""Grouped and global aggregates (A1-A7) and the reports built from them.

All of them are plain ``groupBy().agg()`` plans, so Spark runs a partial aggregate before the
shuffle: a hot key costs one row per task in the exchange, not one row per input row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.formatting import two_decimals
from kestrel.operators.joins import lookup_join
from kestrel.operators.ordering import rank_by_count


def count_by_group(df: DataFrame, key: str, count_name: str = "count", ranked: bool = True) -> DataFrame:
    """Rows per group, most frequent first (A1, O1).

    ``count(key)`` counts non-NULL keys, so the NULL group is listed with count 0.
    """
    counts = df.groupBy(key).agg(F.count(F.col(key)).alias(count_name))
    return rank_by_count(counts, count_name, key) if ranked else counts


def count_and_mean(df: DataFrame, key: str, measure: str, count_name: str = "count",
                   mean_name: str = "mean") -> DataFrame:
    """Rows and mean measure per key (A2): the mean skips NULL measures, the count does not look
    at the measure; a group with only NULL measures has a NULL mean."""
    return df.groupBy(key).agg(F.count(F.col(key)).alias(count_name),
                               F.avg(F.col(measure)).alias(mean_name))


def mean_by_entity(facts: DataFrame, key: str, measure: str, dim: DataFrame | None = None,
                   dim_key: str | None = None, dim_name: str | None = None,
                   name_col: str = "entity_name", count_col: str = "entity_count",
                   mean_text_col: str = "avg_measure_fmt", keep_mean: bool = False) -> DataFrame:
    """Rows and mean per entity with the entity's name, least mean first (Q3).

    Aggregate first, then look the name up, so the join sees one row per entity instead of one
    per fact. An entity missing from the dimension keeps its row with a NULL name; a duplicated
    dimension key lists the entity once per dimension row. The mean is formatted after the sort,
    which runs on the raw value (NULL first), then on the key so the order is total.
    """
    stats = count_and_mean(facts, key, measure, count_col, "_mean")
    if dim is not None:
        names = dim.select(F.col(dim_key).alias("_dim_key"), F.col(dim_name).alias(name_col))
        joined = lookup_join(stats, names, stats[key] == names["_dim_key"], "left")
    else:
        joined = stats.withColumn(name_col, F.col(key).cast("string"))
    ordered_rows = joined.orderBy(F.col("_mean").asc_nulls_first(), F.col(key).asc_nulls_first(),
                                  F.col(name_col).asc_nulls_first())
    cols = [F.col(name_col), F.col(count_col), two_decimals("_mean").alias(mean_text_col)]
    if keep_mean:
        cols.append(F.col("_mean").alias("avg_measure"))
    return ordered_rows.select(*cols)


def grand_total(df: DataFrame, count_col: str, total_name: str = "total") -> DataFrame:
    """Sum of the group counts as one row (A7); no driver loop."""
    return df.agg(F.coalesce(F.sum(F.col(count_col)), F.lit(0)).cast("bigint").alias(total_name))


def sum_by_key(df: DataFrame, key: str, weight: str, total_name: str = "total") -> DataFrame:
    """Summed weight per key (A4)."""
    return df.groupBy(key).agg(F.sum(F.col(weight)).cast("bigint").alias(total_name))


def top_k(df: DataFrame, key: str, weight: str, k: int = 100, total_name: str = "total") -> DataFrame:
    """The ``k`` keys of largest summed weight, ties broken by key.

    Plans as a per-partition top-k followed by one merge of at most k rows per partition.
    """
    totals = sum_by_key(df, key, weight, total_name)
    return totals.orderBy(F.col(total_name).desc(), F.col(key).asc()).limit(k)


def span(df: DataFrame, start: str, end: str, first_name: str = "first_start",
         last_name: str = "last_end") -> DataFrame:
    """First start and last end over all rows (A6); an empty input gives one row of NULLs."""
    return df.agg(F.min(F.col(start)).alias(first_name), F.max(F.col(end)).alias(last_name))


def rows_at_max(df: DataFrame, col: str) -> DataFrame:
    """All rows whose ``col`` equals the column's maximum (F1, A5): ties all kept, an empty
    input gives no rows. The maximum is a scalar subquery, evaluated once."""
    newest: Column = df.agg(F.max(F.col(col))).scalar()
    return df.filter(F.col(col) == newest)
