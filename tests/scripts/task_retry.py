"""Runs in its own process (a fresh Spark context that retries tasks): the first attempt of some
tasks fails; the results after the retries must be exact. Prints one JSON line."""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import BooleanType  # noqa: E402


def fail_first_attempt(_):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected task failure")
    return True


def main():
    spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    flaky = F.udf(fail_first_attempt, BooleanType()).asNondeterministic()
    from kestrel.functions.keywords import count_keywords
    from kestrel.streaming.sinks import WindowTableSink

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(4)
    clean = {r["keyword"]: r["appearances"] for r in count_keywords(docs, "text", []).collect()}
    failing = {r["keyword"]: r["appearances"]
               for r in count_keywords(docs.filter(flaky(F.col("doc_id"))), "text", []).collect()}

    rows = spark.range(1000).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 600).alias("window_start"),
        F.timestamp_seconds(F.lit(1704067230) + F.col("id") * 600).alias("window_end"),
        F.concat(F.lit("k"), F.col("id")).alias("keyword"), F.lit(1).cast("long").alias("appearances"))
    path = tempfile.mkdtemp(prefix="kestrel-retry-")
    sink = WindowTableSink(path)
    sink(rows.repartition(4).filter(flaky(F.col("id"))), 0)
    sink(rows.repartition(4).filter(flaky(F.col("id"))), 0)  # replay
    stored = sink.read(spark)
    print(json.dumps({"counts_equal": clean == failing, "keywords": len(clean),
                      "stored": stored.count(), "distinct": stored.select("keyword").distinct().count()}))


if __name__ == "__main__":
    main()
