"""Registered queries of the corpus operators, and of the pipeline at the repository's top."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import queries as operator_queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**operator_queries.QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**operator_queries.ORACLE, **pipeline}
