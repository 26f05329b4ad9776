"""Batch jobs Q1-Q4 with their job parameters (U3) as keyword arguments.

Each job returns its result DataFrame and writes it when an output is given. The result is never
collected: the summary is itself a DataFrame (report lines plus a one-row total).
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.formatting import report_line, thousands
from kestrel.operators.aggregates import count_by_group, grand_total, mean_by_entity
from kestrel.operators.ordering import one_sorted_partition, rank_by_count
from kestrel.sinks.files import DEFAULT_FORMAT, write_files
from kestrel.sinks.jdbc import write_jdbc
from kestrel.sources.files import read_csv


def count_by_group_job(spark: SparkSession, input_file: str, output_file: str | None = None,
                       output_format: str = DEFAULT_FORMAT, key: str = "STATE",
                       count_name: str = "COUNT", schema=None, single_file: bool = False,
                       csv_options: dict | None = None) -> DataFrame:
    """Q1: rows per group, most frequent first, written as files.

    ``single_file=True`` writes one sorted file; use it only when the number of groups is small.
    Otherwise the globally sorted parts read in order are the sorted result.
    """
    counts = count_by_group(read_csv(spark, input_file, schema=schema, **(csv_options or {})), key, count_name,
                            ranked=False)
    if single_file:
        result = one_sorted_partition(counts, F.col(count_name).desc_nulls_last(), F.col(key).asc_nulls_first())
    else:
        result = rank_by_count(counts, count_name, key)
    if output_file:
        write_files(result, output_file, output_format)
    return result


def count_by_group_to_db(spark: SparkSession, input_file: str, url: str, table: str,
                         properties: dict | None = None, key: str = "STATE",
                         count_name: str = "COUNT", schema=None, num_partitions: int | None = None,
                         csv_options: dict | None = None) -> DataFrame:
    """Q2: the Q1 result replaces the rows of a database table, keeping its definition."""
    result = count_by_group(read_csv(spark, input_file, schema=schema, **(csv_options or {})), key, count_name)
    write_jdbc(result, url, table, properties, mode="overwrite", truncate=True,
               num_partitions=num_partitions)
    return result


def summary_lines(result: DataFrame, name_col: str, count_col: str, mean_text_col: str) -> DataFrame:
    """One padded line per result row (K8, C14), in the result's order."""
    return result.select(report_line(F.col(name_col), F.col(count_col), F.col(mean_text_col)).alias("line"))


def total_line(result: DataFrame, count_col: str, unit: str = "flights") -> DataFrame:
    """``Total 1,234 flights.`` from the summed counts."""
    total = grand_total(result, count_col, "total")
    return total.select(F.col("total"),
                        F.concat(F.lit("Total "), thousands("total"), F.lit(f" {unit}.")).alias("total_line"))


def mean_by_entity_job(spark: SparkSession, input_dir: str, output_dir: str | None = None,
                       output_format: str = DEFAULT_FORMAT, show_summary: bool = False,
                       facts_name: str = "flights.csv", dim_name: str = "airlines.csv",
                       key: str = "AIRLINE", measure: str = "ARRIVAL_DELAY", dim_key: str = "IATA_CODE",
                       dim_label: str = "AIRLINE", facts_schema=None, dim_schema=None,
                       name_col: str = "AIRLINE_NAME", count_col: str = "FLIGHTS_COUNT",
                       mean_text_col: str = "AVG_ARRIVAL_DELAY_BY_MINUTES",
                       result_name: str = "avg_arrival_delay_by_airline", unit: str = "flights",
                       csv_options: dict | None = None, single_file: bool = False):
    """Q3: rows and mean measure per entity with its name, least mean first.

    ``csv_options`` go to the CSV reader, e.g. ``{"samplingRatio": "0.01"}`` to infer types from a
    sample instead of a full extra pass over a large input.

    Returns ``(result, summary)``; ``summary`` is ``(lines, total)`` when asked for, else None.
    With both an output and a summary the result is persisted; ``result.unpersist()`` frees it.
    """
    base = input_dir.rstrip("/")
    facts = read_csv(spark, f"{base}/{facts_name}", schema=facts_schema, **(csv_options or {}))
    dim = read_csv(spark, f"{base}/{dim_name}", schema=dim_schema, **(csv_options or {}))
    result = mean_by_entity(facts, key, measure, dim, dim_key, dim_label, name_col=name_col,
                            count_col=count_col, mean_text_col=mean_text_col)
    if output_dir and show_summary:
        # Written once and summarized twice: keep the result (one row per entity, spilling to disk
        # when large) instead of aggregating the facts three times.
        result = result.persist(StorageLevel.MEMORY_AND_DISK)
    if output_dir:
        # The result is sorted: moving its ranges, in order, into one task keeps the order. One row
        # per entity, so ask for a single file only where the number of entities is small.
        out = result.coalesce(1) if single_file else result
        write_files(out, f"{output_dir.rstrip('/')}/{result_name}", output_format)
    summary = None
    if show_summary:
        summary = (summary_lines(result, name_col, count_col, mean_text_col),
                   total_line(result, count_col, unit))
        if output_dir:
            write_files(summary[0], f"{output_dir.rstrip('/')}/{result_name}_summary", "text")
    return result, summary


MEAN_BY_ENTITY_SQL = """
WITH f AS (
  SELECT {key} AS k, count({key}) AS n, avg({measure}) AS m
  FROM {facts} GROUP BY {key}
), d AS (
  SELECT {dim_key} AS k, min({dim_label}) AS name, count(*) AS copies
  FROM {dim} GROUP BY {dim_key}
)
SELECT d.name AS {name_col}, f.n * coalesce(d.copies, 1) AS {count_col}, f.m AS {mean_col}
FROM f LEFT JOIN d ON f.k = d.k
ORDER BY {mean_col} ASC NULLS FIRST, f.k ASC NULLS FIRST
"""


def mean_by_entity_sql(spark: SparkSession, facts: DataFrame, dim: DataFrame, key: str, measure: str,
                       dim_key: str, dim_label: str, facts_view: str | None = None, dim_view: str | None = None,
                       name_col: str = "entity_name", count_col: str = "entity_count",
                       mean_col: str = "avg_measure") -> DataFrame:
    """Q4: the same question as SQL text over temp views.

    Meaning is that of joining before grouping: a dimension key listed twice doubles the count of
    its entity, and the name is the smallest of the names (fixed, unlike ``first``); the mean does
    not change with copies of a fact. The text aggregates each side before the join, so only one
    row per key reaches the join.

    Views without a given name get one of their own and are dropped once the text is resolved.
    """
    own = uuid.uuid4().hex
    views = {"facts": facts_view or f"facts_{own}", "dim": dim_view or f"dim_{own}"}
    facts.createOrReplaceTempView(views["facts"])
    dim.createOrReplaceTempView(views["dim"])
    names = {"key": key, "measure": measure, "dim_key": dim_key, "dim_label": dim_label, "name_col": name_col,
             "count_col": count_col, "mean_col": mean_col, **views}
    result = spark.sql(MEAN_BY_ENTITY_SQL.format(**{k: "`" + v.replace("`", "``") + "`" for k, v in names.items()}))
    if facts_view is None:
        spark.catalog.dropTempView(views["facts"])
    if dim_view is None:
        spark.catalog.dropTempView(views["dim"])
    return result
