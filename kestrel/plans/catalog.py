"""All registered queries over the driver tables, each with its DuckDB twin where one exists.

Every query reads whole tables (or data Spark derives from them), so its work grows with the
data. Output columns carry the same names in both forms.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kestrel.plans import catalog_tables, file_queries, stream_queries, text_queries
from kestrel.session import ensure_utc

QueryFn = Callable[[SparkSession, str], DataFrame]
MODULES = (catalog_tables, text_queries, stream_queries, file_queries)

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
for _module in MODULES:
    QUERIES.update(_module.QUERIES)
    ORACLE.update(_module.ORACLE)


def _with_utc(fn: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, QueryFn]:
    return {name: _with_utc(fn) for name, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in ORACLE.items() if name in QUERIES}
