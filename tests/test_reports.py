import datetime as dt

from pyspark.sql import functions as F

from kestrel.operators.expand import repeat_by_weight
from kestrel.plans.reports import alltime_span, alltime_top, bag_text_pieces, latest_window_bag, latest_window_ranking

T = dt.datetime(2024, 1, 1)


def _counts(spark):
    rows = [(T, T + dt.timedelta(seconds=30), "a", 3),
            (T + dt.timedelta(seconds=30), T + dt.timedelta(seconds=60), "b", 2),
            (T + dt.timedelta(seconds=30), T + dt.timedelta(seconds=60), "c", 1)]
    return spark.createDataFrame(rows, "window_start timestamp_ntz, window_end timestamp_ntz, keyword string, "
                                       "appearances bigint")


def test_latest_window_ranking(spark):
    rows = [tuple(r) for r in latest_window_ranking(_counts(spark)).collect()]
    end_local = dt.datetime(2024, 1, 1, 9, 1, 0)
    assert rows == [(end_local, "b", 2), (end_local, "c", 1)]


def test_word_bag(spark):
    bag = sorted(r["keyword"] for r in latest_window_bag(_counts(spark)).collect())
    assert bag == ["b", "b", "c"]
    pieces = sorted(r["piece"] for r in bag_text_pieces(_counts(spark)).collect())
    assert pieces == ["b b", "c"]


def test_span_and_top(spark):
    s = alltime_span(_counts(spark)).collect()[0]
    assert s["caption"] == "From 2024-01-01T09:00:00 To 2024-01-01T09:01:00"
    top = [tuple(r) for r in alltime_top(_counts(spark), 2).collect()]
    assert top == [("a", 3), ("b", 2)]


def test_text_pieces_are_bounded(spark):
    from kestrel.operators.expand import weight_chunks
    df = spark.createDataFrame([("hot", 1_000_000)], "k string, w long")
    chunks = weight_chunks(df, "w", max_chunk=100, fanout=16).collect()
    assert sum(r["chunk"] for r in chunks) == 1_000_000
    assert max(r["chunk"] for r in chunks) <= 100 and len(chunks) < 11_000
    small = weight_chunks(spark.createDataFrame([("b", 2)], "k string, w long"), "w").collect()
    assert [r["chunk"] for r in small] == [2]


def test_repeat_by_weight_splits_large_weights(spark):
    df = spark.createDataFrame([("hot", 100_003), ("one", 1), ("zero", 0), ("none", None)], "k string, w long")
    out = repeat_by_weight(df, "w", max_chunk=50, fanout=16)
    counts = {r["k"]: r["n"] for r in out.groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert counts == {"hot": 100_003, "one": 1}


def test_sql_forms_equal_dataframe_forms(spark):
    from kestrel.plans.report_sql import (ALLTIME_SPAN, ALLTIME_TOP, LATEST_WINDOW_RANKING, register_keyword_table,
                                          run_report)
    from kestrel.plans.text_queries import document_keyword_counts
    from kestrel.streaming.windows import as_wall_clock

    counts = as_wall_clock(document_keyword_counts(spark, "/root/testdata/sf0.001"), "window_start", "window_end")
    view = register_keyword_table(counts, "kw_test")
    pairs = [(run_report(spark, LATEST_WINDOW_RANKING, view), latest_window_ranking(counts)),
             (run_report(spark, ALLTIME_SPAN, view), alltime_span(counts)),
             (run_report(spark, ALLTIME_TOP, view), alltime_top(counts, 100))]
    for sql_form, df_form in pairs:
        assert sql_form.columns == df_form.columns
        assert [tuple(r) for r in sql_form.collect()] == [tuple(r) for r in df_form.collect()]


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-3, 5000)), min_size=1, max_size=12),
       st.integers(1, 9), st.integers(2, 7))
def test_weight_expansion_property(spark, weights, max_chunk, fanout):
    from kestrel.operators.expand import weight_chunks

    df = spark.createDataFrame([(f"k{i}", w) for i, w in enumerate(weights)], "k string, w long")
    chunks = weight_chunks(df, "w", max_chunk=max_chunk, fanout=fanout).collect()
    assert all(0 < r["chunk"] <= max_chunk for r in chunks)
    expected = {f"k{i}": w for i, w in enumerate(weights) if w is not None and w > 0}
    got = {}
    for r in chunks:
        got[r["k"]] = got.get(r["k"], 0) + r["chunk"]
    assert got == expected
    units = repeat_by_weight(df, "w", max_chunk=max_chunk, fanout=fanout).groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in units} == expected


def test_stored_table_counts_each_text_where_it_is_dealt_to(spark, tmp_path, monkeypatch):
    """Rows of null times and texts, of one window that is larger than a task's share, and of many days; no
    shuffle after the one of the texts."""
    from kestrel.plans import text_queries

    rows = [(i, f"w{i % 7} alpha beta alpha", "en", "s") for i in range(0, 400_000, 4000)]
    rows += [(5, "gamma alpha", "en", "s"), (None, "lost", "en", "s"), (6, None, "en", "s"), *[(31, f"crowd c{i} crowd", "en", "s") for i in range(300)]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = sorted(map(tuple, text_queries.document_keyword_counts(spark, str(tmp_path)).collect()))
    assert expected
    for most in (32 << 20, 1000):
        monkeypatch.setattr(text_queries, "WINDOW_TEXT", most)
        stored = text_queries.build_keyword_table(spark, str(tmp_path))
        found = stored.all().select("window_start", "window_end", "keyword", "appearances")
        assert sorted(map(tuple, found.collect())) == expected and len(stored.days) == 5
    texts = spark.read.parquet(f"{tmp_path}/documents.parquet").selectExpr("timestamp_seconds(doc_id) AS window_start", "text")
    plan = text_queries.in_order_of_time(text_queries.keywords_in_place(texts))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") + plan.count("Exchange(") == 1, plan


def test_texts_that_compress_well_make_as_many_tasks_as_others(spark, tmp_path, monkeypatch):
    """Equal texts take hardly any room in a file; the tasks of the table's build follow their characters."""
    from kestrel.plans import text_queries

    monkeypatch.setattr(text_queries, "TASK_TEXT", 20_000)
    text = " ".join(f"word{i}" for i in range(200))
    rows = [(i * 60, text, "en", "s") for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    seen, whole = [], text_queries.keywords_in_place

    def recorded(*args):
        counts = whole(*args)
        seen.append(counts.rdd.getNumPartitions())
        return counts

    monkeypatch.setattr(text_queries, "keywords_in_place", recorded)
    stored = text_queries.build_keyword_table(spark, str(tmp_path))
    assert seen[0] >= 400 * len(text) // 20_000
    assert stored.all().count() == 400 * 200
