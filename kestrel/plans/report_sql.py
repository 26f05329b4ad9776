"""The reports (Q7, Q9, Q10) as Spark SQL text over a keyword table registered as a view
``(window_start, window_end, keyword, appearances)``. Same results as ``reports.py``; use
whichever form fits the caller. The word bag (Q8) stays in ``reports.py``: expanding rows by a
weight needs the bounded splitting done there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.plans.reports import LOCAL_CLOCK_HOURS

LATEST_WINDOW_RANKING = """
SELECT window_end + make_dt_interval(0, {hours}) AS window_end_local, keyword, appearances
FROM {table}
WHERE window_end = (SELECT max(window_end) FROM {table})
ORDER BY appearances DESC, keyword
"""

ALLTIME_SPAN = """
SELECT min(window_start) + make_dt_interval(0, {hours}) AS first_start_local,
       max(window_end) + make_dt_interval(0, {hours}) AS last_end_local,
       concat('From ', date_format(min(window_start) + make_dt_interval(0, {hours}), "yyyy-MM-dd'T'HH:mm:ss"),
              ' To ', date_format(max(window_end) + make_dt_interval(0, {hours}), "yyyy-MM-dd'T'HH:mm:ss")) AS caption
FROM {table}
"""

ALLTIME_TOP = """
SELECT keyword, CAST(sum(appearances) AS BIGINT) AS total
FROM {table}
GROUP BY keyword
ORDER BY total DESC, keyword
LIMIT {k}
"""


def run_report(spark: SparkSession, sql: str, table: str, hours: int = LOCAL_CLOCK_HOURS, k: int = 100) -> DataFrame:
    return spark.sql(sql.format(table=table, hours=hours, k=k))


def register_keyword_table(counts: DataFrame, name: str = "keyword_counts") -> str:
    counts.createOrReplaceTempView(name)
    return name
