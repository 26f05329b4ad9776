"""One key holding a third of all rows: results stay exact, and no plan moves a hot key's raw rows
through an exchange without a partial aggregate first."""

import datetime as dt

from pyspark.sql import functions as F

from kestrel.functions.keywords import count_keywords
from kestrel.operators.aggregates import count_by_group, mean_by_entity
from kestrel.streaming.windows import keyword_counts

N = 30_000


def _skewed(spark):
    # Key 0 holds a third of the rows; the rest spread over 1,000 keys.
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        (F.col("id") % 7).cast("double").alias("v"))


def test_count_and_mean_with_hot_key(spark, capsys):
    df = _skewed(spark)
    counts = {r["k"]: r["n"] for r in count_by_group(df, "k", "n").collect()}
    assert counts[0] == N // 3 and sum(counts.values()) == N
    dim = spark.range(0, 1001).select(F.col("id").alias("key"), F.concat(F.lit("e"), F.col("id")).alias("name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = mean_by_entity(df, "k", "v", dim, "key", "name")
        result.explain()
        plan = capsys.readouterr().out
        rows = {r["entity_name"]: r["entity_count"] for r in result.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "partial_count" in plan
    assert rows["e0"] == N // 3 and sum(rows.values()) == N


def test_hot_keyword(spark, capsys):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(seconds=i % 60), "hot " * 10 + f"w{i % 50}") for i in range(3000)]
    df = spark.createDataFrame(rows, "ts timestamp, text string")
    counts = keyword_counts(df, width="30 seconds")
    counts.explain()
    plan = capsys.readouterr().out
    got = {(r["window_start"].second, r["keyword"]): r["appearances"] for r in counts.collect()}
    assert got[(0, "hot")] == got[(30, "hot")] == 15_000
    assert plan.index("partial_count") > plan.index("Exchange")  # partial count sits below the exchange
    overall = {r["keyword"]: r["appearances"] for r in count_keywords(df, "text", []).collect()}
    assert overall["hot"] == 30_000 and sum(overall.values()) == 33_000


def test_range_sort_stays_balanced_when_counts_tie(spark):
    """9,000 of 9,010 groups have count 1; the unique key at the end of the sort order lets the
    range partitioner split them evenly instead of sending every tied row to one partition."""
    from collections import Counter

    from pyspark.sql.functions import spark_partition_id

    df = spark.range(12_000).select(F.when(F.col("id") < 3000, F.col("id") % 10).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ranked = count_by_group(df, "k", "n").withColumn("p", spark_partition_id())
        sizes = Counter(r["p"] for r in ranked.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(sizes.values()) < 2 * (sum(sizes.values()) / len(sizes))
