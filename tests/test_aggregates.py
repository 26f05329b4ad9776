from pyspark.sql import functions as F

from kestrel.functions.formatting import two_decimals
from kestrel.operators.aggregates import count_by_group, grand_total, mean_by_entity, rows_at_max, span, top_k
from kestrel.plans.batch_jobs import mean_by_entity_sql, summary_lines, total_line


def test_null_group_key_counts_zero_and_ranks_last(spark):
    df = spark.createDataFrame([("TX",), ("TX",), ("CA",), ("AK",), (None,)], "STATE string")
    rows = [tuple(r) for r in count_by_group(df, "STATE", "COUNT").collect()]
    assert rows == [("TX", 2), ("AK", 1), ("CA", 1), (None, 0)]


def _flights(spark):
    return spark.createDataFrame(
        [("AA", 5), ("AA", -3), ("AA", None), ("UA", 10), ("ZZ", 1), ("ZZ", None), ("YY", None)],
        "AIRLINE string, ARRIVAL_DELAY int")


def test_mean_with_nulls_and_unmatched_keys(spark):
    airlines = spark.createDataFrame([("AA", "American"), ("UA", "United")], "IATA_CODE string, AIRLINE string")
    result = mean_by_entity(_flights(spark), "AIRLINE", "ARRIVAL_DELAY", airlines, "IATA_CODE", "AIRLINE",
                            "AIRLINE_NAME", "FLIGHTS_COUNT", "AVG")
    rows = [tuple(r) for r in result.collect()]
    assert rows[0] == (None, 1, None)                       # YY: all measures NULL
    assert set(rows[1:3]) == {(None, 2, "1.00"), ("American", 3, "1.00")}
    assert rows[3] == ("United", 1, "10.00")


def test_duplicated_dimension_key_dataframe_vs_sql(spark):
    flights = _flights(spark)
    airlines = spark.createDataFrame([("AA", "American"), ("AA", "American")], "IATA_CODE string, AIRLINE string")
    df_rows = mean_by_entity(flights, "AIRLINE", "ARRIVAL_DELAY", airlines, "IATA_CODE", "AIRLINE").collect()
    aa = [r for r in df_rows if r["entity_name"] == "American"]
    assert len(aa) == 2 and all(r["entity_count"] == 3 for r in aa)
    sql_rows = mean_by_entity_sql(spark, flights, airlines, "AIRLINE", "ARRIVAL_DELAY", "IATA_CODE",
                                  "AIRLINE").collect()
    aa = [r for r in sql_rows if r["entity_name"] == "American"]
    assert len(aa) == 1 and aa[0]["entity_count"] == 6 and aa[0]["avg_measure"] == 1.0


def test_sql_form_equals_dataframe_form_on_unique_keys(spark):
    flights = _flights(spark)
    airlines = spark.createDataFrame([("AA", "American"), ("UA", "United")], "IATA_CODE string, AIRLINE string")
    a = mean_by_entity(flights, "AIRLINE", "ARRIVAL_DELAY", airlines, "IATA_CODE", "AIRLINE", keep_mean=True)
    b = mean_by_entity_sql(spark, flights, airlines, "AIRLINE", "ARRIVAL_DELAY", "IATA_CODE", "AIRLINE")
    assert sorted(map(repr, a.select("entity_name", "entity_count", "avg_measure").collect())) == \
        sorted(map(repr, b.collect()))


def test_format_two_decimals(spark):
    df = spark.createDataFrame([(1234567.125,), (0.125,), (0.375,), (-0.004,), (None,)], "x double")
    assert [r[0] for r in df.select(two_decimals("x")).collect()] == \
        ["1,234,567.12", "0.12", "0.38", "-0.00", None]


def test_summary_lines_and_total(spark):
    df = spark.createDataFrame([("American", 3, "1.00"), (None, 2, None)], "n string, c bigint, m string")
    lines = [r[0] for r in summary_lines(df, "n", "c", "m").collect()]
    assert lines[0] == f"{'American':32} {3:10d} {'1.00':>8}"
    assert lines[1] == f"{'':32} {2:10d} {'':>8}"
    total = total_line(df, "c").collect()[0]
    assert (total["total"], total["total_line"]) == (5, "Total 5 flights.")
    big = spark.createDataFrame([(1234567,)], "c bigint")
    assert total_line(big, "c").collect()[0]["total_line"] == "Total 1,234,567 flights."


def test_grand_total_of_empty_is_zero(spark):
    df = spark.createDataFrame([], "c bigint")
    assert grand_total(df, "c").collect()[0][0] == 0


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1), ("a", 1)], "keyword string, appearances bigint")
    assert [tuple(r) for r in top_k(df, "keyword", "appearances", 2).collect()] == [("a", 3), ("b", 2)]


def test_rows_at_max_keeps_ties_and_empty_gives_none(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "e int, k string")
    assert sorted(r["k"] for r in rows_at_max(df, "e").collect()) == ["b", "c"]
    empty = spark.createDataFrame([], "e int, k string")
    assert rows_at_max(empty, "e").count() == 0


def test_span_of_empty_is_nulls(spark):
    empty = spark.createDataFrame([], "window_start timestamp, window_end timestamp")
    assert tuple(span(empty, "window_start", "window_end").collect()[0]) == (None, None)


def test_mean_plan_partial_aggregate_and_pruned_scan(spark, capsys):
    facts = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    dim = spark.read.parquet("/root/testdata/sf0.001/supplier.parquet")
    mean_by_entity(facts, "l_suppkey", "l_quantity", dim, "s_suppkey", "s_name").explain("formatted")
    plan = capsys.readouterr().out
    assert "partial_count" in plan and "partial_avg" in plan
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in plan
    assert "ReadSchema: struct<s_suppkey:bigint,s_name:string>" in plan


def test_cluster_settings_scale_with_shuffle_size():
    from kestrel.session import cluster_settings
    small = cluster_settings(1 << 30, executors=10)
    big = cluster_settings(10 * 10**12)
    assert int(small["spark.sql.shuffle.partitions"]) == 3 * 10 * 4
    assert int(big["spark.sql.shuffle.partitions"]) == -(-10 * 10**12 // (512 << 20))
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_lookup_join_broadcasts_only_what_measures_small(spark, capsys):
    from kestrel.operators.joins import lookup_join

    facts = spark.range(100).select((F.col("id") % 10).alias("k"))
    dim = spark.range(10).select(F.col("id").alias("dk"), F.col("id").cast("string").alias("name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        lookup_join(facts, dim, facts["k"] == dim["dk"]).explain()
        default_plan = capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in default_plan and "BroadcastHashJoin" not in default_plan
    lookup_join(facts, dim, facts["k"] == dim["dk"]).explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out
