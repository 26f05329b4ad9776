"""Bounded micro-batches, concurrent queries, committed reads, progress, and tables read by what they need."""

import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from kestrel.plans import stream_queries, text_queries
from kestrel.plans.reports import KeywordTable, alltime_span, latest_window_ranking
from kestrel.sources.files import files_in_name_order, input_version, ordered_lines, partition_values
from kestrel.sources.streams import file_stream, text_line_stream
from kestrel.streaming.jobs import await_all, rocksdb_state, run_to_end, start_keyword_job
from kestrel.streaming.progress import ProgressTable
from kestrel.streaming.sinks import CommittedFileSink, FileBatchSink

SF = "/root/testdata/sf0.001"


def state_rows(query):
    return [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress]


@pytest.fixture(autouse=True)
def no_query_left(spark):
    yield
    for query in spark.streams.active:
        query.stop()


@pytest.mark.parametrize("run", [stream_queries.keyword_stream, stream_queries.event_window_stream])
def test_streams_take_the_feed_in_batches_with_bounded_state(spark, run):
    stored, query = run(spark, SF)
    batches = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(batches) == stream_queries.FEED_FILES
    states = state_rows(query)
    assert max(states) < 0.6 * stored.count() and states[-1] < max(states)  # open windows only, never all history
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")
    metrics = query.lastProgress["stateOperators"][0]["customMetrics"]
    assert any("rocksdb" in m for m in metrics)


def test_feed_files_rise_in_time(spark, scratch):
    events = spark.read.parquet(f"{SF}/events.parquet").select("ts", "event_type")
    path = stream_queries.write_in_order(events, "ts", f"{scratch}/feed", "parquet", files=5)
    assert files_in_name_order(spark, path) == 5
    seen = []
    query = run_to_end(file_stream(spark, path, events.schema, max_files_per_trigger=1).writeStream.foreachBatch(
        lambda df, _: seen.append(df.agg(F.min("ts"), F.max("ts"), F.count("*")).first())).option("checkpointLocation", f"{scratch}/ckpt"))
    assert len(seen) == 5 and sum(r[2] for r in seen) == events.count() and not query.isActive
    assert all(a[1] <= b[0] for a, b in zip(seen[:-1], seen[1:]))


def feed(spark):
    return text_line_stream(spark, stream_queries.write_document_feed(spark, SF), max_files_per_trigger=1)


class Slow(FileBatchSink):
    """A sink that goes on until it is stopped."""

    def __call__(self, batch_df, batch_id):
        import time

        super().__call__(batch_df, batch_id)
        time.sleep(2)


def test_failure_of_the_second_query_ends_both(spark, scratch):
    """The keyword query still runs when the text query fails: the failure is raised, and both are stopped."""
    os.makedirs(f"{scratch}/ckpt/texts/offsets")
    with open(f"{scratch}/ckpt/texts/offsets/0", "w") as f:
        f.write("not an offset")  # the second query cannot read its own checkpoint
    started = start_keyword_job(spark, feed(spark), Slow(f"{scratch}/keywords"), f"{scratch}/ckpt", trigger={"processingTime": "0 seconds"},
                                console=False, texts_path=f"{scratch}/texts")
    assert [q.name for q in started] == ["keywords to database", "texts to table"]
    with pytest.raises(Exception, match="(?i)log|offset"):
        await_all(spark, started, timeout=60)
    assert not any(q.isActive for q in started)


def test_failure_of_the_first_query_ends_both(spark, scratch):
    def broken(batch_df, batch_id):
        raise RuntimeError("database gone")

    started = start_keyword_job(spark, feed(spark), broken, f"{scratch}/ckpt", trigger={"processingTime": "0 seconds"}, console=False,
                                texts_path=f"{scratch}/texts")
    with pytest.raises(Exception, match="database gone"):
        await_all(spark, started, timeout=120)
    assert not any(q.isActive for q in started)


def test_waiting_ignores_other_queries_and_stops_at_the_time_limit(spark, scratch):
    other = spark.readStream.format("rate").load().writeStream.format("noop").option("checkpointLocation", f"{scratch}/other").start()
    own = spark.readStream.format("rate").load().writeStream.format("noop").option("checkpointLocation", f"{scratch}/own").start()
    try:
        assert await_all(spark, [own], timeout=1.5) is False
        own.stop()
        assert await_all(spark, [own], timeout=30) is True and other.isActive
    finally:
        other.stop()


def test_a_query_that_cannot_start_stops_the_others(spark, scratch, monkeypatch):
    import kestrel.streaming.jobs as jobs

    running = []

    class Broken:
        def start(self):
            running.extend(spark.streams.active)
            raise RuntimeError("no start")

    monkeypatch.setattr(jobs, "text_table_writer", lambda *_, **__: Broken())
    with pytest.raises(RuntimeError, match="no start"):
        start_keyword_job(spark, feed(spark), FileBatchSink(f"{scratch}/k"), f"{scratch}/ckpt", console=False, texts_path=f"{scratch}/t")
    assert running and not any(q.isActive for q in running)


def test_rocksdb_setting_comes_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with pytest.raises(ValueError):
        with rocksdb_state(spark):
            assert "RocksDB" in spark.conf.get(key)
            raise ValueError
    assert spark.conf.get(key, None) == before


def test_readers_see_committed_attempts_only(spark, scratch):
    sink = CommittedFileSink(f"{scratch}/t")
    schema = "k string, n long"
    batch = lambda *rows: spark.createDataFrame(rows, schema)
    assert sink.read(spark, schema=schema).count() == 0
    sink.write_attempt(batch(("dead", 1)), 0)
    assert sink.read(spark, schema=schema).count() == 0
    sink(batch(("a", 1), ("b", 2)), 0)
    sink(batch(("again", 1)), 0)  # committed before: not written again
    half = sink.write_attempt(batch(("half", 3)), 1)
    folder = f"{scratch}/t/rows/batch_id=1/attempt={half}"
    part = next(f for f in os.listdir(folder) if f.startswith("part-"))
    shutil.copy(f"{folder}/{part}", f"{folder}/{part.replace('part-', 'part-9')}")
    with open(f"{scratch}/t/commits/1", "w") as f:  # a commit cut short
        f.write(f"1 {half[:20]}")
    assert sorted(r["k"] for r in sink.read(spark).collect()) == ["a", "b"]
    sink(batch(("c", 4)), 1)
    assert sorted(tuple(r) for r in sink.read(spark).collect()) == [("a", 1), ("b", 2), ("c", 4)]
    assert sorted(r["batch_id"] for r in sink.committed(spark).collect()) == [0, 1]


def test_progress_table_keeps_every_batch(spark, scratch, monkeypatch):
    import kestrel.streaming.progress as progress

    monkeypatch.setattr(progress, "FLUSH", 2)  # several files
    events = spark.read.parquet(f"{SF}/events.parquet").select("ts", "event_type")
    path = stream_queries.write_in_order(events, "ts", f"{scratch}/feed", "parquet", files=5)
    with ProgressTable(spark, f"{scratch}/progress") as table:
        stream = file_stream(spark, path, events.schema, max_files_per_trigger=1)
        table.wait_for(run_to_end(stream.writeStream.format("noop").queryName("copy").option("checkpointLocation", f"{scratch}/ckpt")))
    rows = table.read().where("query = 'copy' AND input_rows > 0").orderBy("batch_id").collect()
    assert [r["batch_id"] for r in rows] == list(range(5)) and sum(r["input_rows"] for r in rows) == events.count()
    assert len([f for f in os.listdir(f"{scratch}/progress") if f.startswith("part-")]) > 1


REPORTS = ["latest_window_ranking", "latest_window_ranking_sql", "latest_window_bag", "latest_window_text", "latest_window_from_table",
           "alltime_span", "alltime_span_sql", "alltime_top100", "alltime_top100_sql"]


def test_reports_follow_their_input(spark, scratch):
    """Documents replaced at the same path: every report reads the new ones."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    values = lambda: {name: sorted(map(str, text_queries.QUERIES[name](spark, scratch).collect())) for name in REPORTS}
    docs.write.parquet(f"{scratch}/documents.parquet")
    version, first = input_version(spark, f"{scratch}/documents.parquet"), values()
    docs.orderBy("doc_id").limit(20).write.mode("overwrite").parquet(f"{scratch}/documents.parquet")
    assert input_version(spark, f"{scratch}/documents.parquet") != version
    second = values()
    assert all(first[name] != second[name] for name in REPORTS)
    docs.write.mode("overwrite").parquet(f"{scratch}/documents.parquet")
    assert values() == first


def test_reports_list_and_read_only_the_days_they_need(spark, scratch):
    rows = [(f"2024-01-{d:02d} 10:00:{s:02d}", f"2024-01-{d:02d} 10:00:{s + 30:02d}", f"k{s}", d) for d in range(1, 10) for s in (0, 20)]
    counts = spark.createDataFrame(rows, "window_start string, window_end string, keyword string, appearances long").selectExpr(
        "CAST(window_start AS timestamp) AS window_start", "CAST(window_end AS timestamp) AS window_end", "keyword", "appearances",
        "to_date(window_start) AS window_day")
    path = f"{scratch}/t"
    counts.write.partitionBy("window_day").parquet(path)
    table = KeywordTable(spark, path)
    assert table.days == partition_values(spark, path, "window_day") == [f"2024-01-{d:02d}" for d in range(1, 10)]
    assert {f.split("window_day=")[1][:10] for f in table.newest_day().inputFiles()} == {"2024-01-09"}
    assert {f.split("window_day=")[1][:10] for f in table.edge_days().inputFiles()} == {"2024-01-01", "2024-01-09"}
    assert [r["keyword"] for r in latest_window_ranking(table.newest_day()).collect()] == ["k20"]
    whole, edges = alltime_span(table.all()).collect(), alltime_span(table.edge_days()).collect()
    assert whole == edges
    # the rows of a day are in the table's own columns, window_day among them
    assert sorted(table.newest_day().columns) == sorted(table.all().columns)


def test_lines_keep_their_places_over_files_and_splits(spark, scratch):
    n = 20_000
    spark.range(n).selectExpr("concat('line ', id, repeat('x', 50))").coalesce(1).write.text(f"{scratch}/one")
    spark.range(n).repartitionByRange(7, "id").sortWithinPartitions("id").selectExpr("concat('line ', id, repeat('x', 50))").write.text(f"{scratch}/many")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "100000")  # many splits of one file
    try:
        for path in (f"{scratch}/one", f"{scratch}/many"):
            found = {r["position"]: r["line"] for r in ordered_lines(spark, path).collect()}
            assert len(found) == n and all(found[i].startswith(f"line {i}x") for i in range(n))
    finally:
        spark.conf.set(key, before)


def test_batch_analyzer_is_called_once_per_arrow_batch(spark):
    from kestrel.functions.analyzers import batch_tokens

    sc = spark.sparkContext
    calls, texts = sc.accumulator(0), sc.accumulator(0)
    df = spark.createDataFrame([(i, None if i % 10 == 0 else f"alpha {i} the https://t.co/x") for i in range(1000)], "id long, text string").repartition(4)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "100")
    try:
        found = batch_tokens(df, "text", ["id"], text_queries.letter_run_analyzer, calls=calls, texts=texts)
        rows = found.groupBy("keyword").count().collect()
    finally:
        spark.conf.set(key, before)
    assert {r["keyword"]: r["count"] for r in rows} == {"alpha": 900, "theる": 900, **{r["keyword"]: r["count"] for r in rows if r["keyword"][0].isdigit()}}
    assert texts.value == 900 and 9 <= calls.value <= 16


def test_only_hot_words_are_salted(spark):
    """A word of a third of all tokens is spread over tasks; the others keep one lexicon row each."""
    from kestrel.functions.keywords import classify, explode_tokens, extract_keywords, hot_surfaces, lexicon_frame

    texts = spark.range(3000).selectExpr("id", "concat('hot rare', id % 400, ' word', id % 700) AS text")
    lexicon = spark.createDataFrame([("hot", "名詞,一般", "hot")] + [(f"rare{i}", "助詞", "x") for i in range(400)], "surface string, pos string, base_form string")
    tokens = explode_tokens(texts, "text", ["id"], salt_name="_token")
    hot = hot_surfaces(tokens)
    assert hot == ["hot"]
    salts = spark.sparkContext.defaultParallelism
    joined = classify(tokens, lexicon_frame(spark, lexicon), salt_col="_token", hot=hot)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = extract_keywords(texts, "text", ["id"], lexicon=lexicon).groupBy("keyword").count()
        counts = {r["keyword"]: r["count"] for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert counts["hot"] == 3000 and sum(counts.values()) == 6000 and len(counts) == 701
    copies = F.when(F.col("surface").isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    assert lexicon_frame(spark, lexicon).select(F.explode(copies)).count() == 400 + salts
    assert hot_surfaces(tokens.where("false")) == []


def part_files(path):
    return [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]


def test_batches_do_not_grow_with_the_feed(spark, monkeypatch):
    """A larger table makes more files of its feed, not larger ones, and the same rows."""
    made = []
    write = stream_queries.write_in_order
    monkeypatch.setattr(stream_queries, "write_in_order", lambda *a, **k: made.append(write(*a, **k)) or made[-1])
    before = sorted(map(str, stream_queries.q_window_counts_stream(spark, SF).collect()))
    monkeypatch.setattr(stream_queries, "FEED_BYTES", 600)
    assert sorted(map(str, stream_queries.q_window_counts_stream(spark, SF).collect())) == before
    assert len(part_files(made[0])) <= stream_queries.FEED_FILES < len(part_files(made[1]))
    small = stream_queries.write_document_feed(spark, SF, file_bytes=25_000)
    assert stream_queries.FEED_FILES < len(part_files(small))
    whole = stream_queries.write_document_feed(spark, SF, file_bytes=1 << 30)
    assert sorted(spark.read.text(small).collect()) == sorted(spark.read.text(whole).collect())


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def bytes_under(path, end=""):
    return sum(os.path.getsize(os.path.join(folder, f)) for folder, _, names in os.walk(path.removeprefix("file:")) for f in names if f.endswith(end))


def test_the_disk_of_a_keyword_stream_is_bounded(spark, scratch, monkeypatch):
    """No shuffle outlives its job; the feed is packed; a text goes through the state's changes once, packed, and not again
    when its window closes; a batch takes no more state partitions than it fills."""
    texts = F.concat_ws(" ", *[F.concat(F.lit("keyword"), F.substring(F.md5(F.concat(F.col("id"), F.lit(f"-{i}"))), 1, 8)) for i in range(100)])
    docs = spark.range(600).select(F.col("id").alias("doc_id"), texts.alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source"))
    docs.write.parquet(f"{scratch}/documents.parquet")
    raw = docs.agg(F.sum(F.length("text"))).first()[0]
    made, named = [], stream_queries.shared_path
    monkeypatch.setattr(stream_queries, "shared_path", lambda *a: made.append(named(*a)) or made[-1])
    monkeypatch.setattr(stream_queries, "BATCH_PARTITIONS", 2, raising=False)
    key = "spark.sql.shuffle.partitions"
    before, files = spark.conf.get(key), shuffle_files(spark)
    spark.conf.set(key, "40")
    try:
        stored, query = stream_queries.keyword_stream(spark, scratch, text_queries.lexicon_table(spark), ["the"])
        assert spark.conf.get(key) == "40"
    finally:
        spark.conf.set(key, before)
    until = time.monotonic() + 5  # files are removed by another thread
    while shuffle_files(spark) - files and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - files
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == max(2, spark.sparkContext.defaultParallelism)
    feed, checkpoint = [next(p for p in made if f"/{name}-" in p) for name in ("feed", "ckpt")]
    assert bytes_under(checkpoint, ".changelog") < 0.9 * raw and bytes_under(feed) < 0.95 * raw
    assert stored.agg(F.sum("appearances")).first()[0] == 100 * docs.where("doc_id < 540").count()  # closed windows, whole


def test_hot_words_come_from_one_pass(spark):
    """Both the most frequent words and the number of all tokens are read from one count of the tokens."""
    from kestrel.functions.keywords import hot_surfaces

    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda w: (seen.add(1), w)[1])
    words = spark.range(4000).select(F.when(F.col("id") % 4 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id"))).alias("surface"))
    words = words.select(count("surface").alias("surface"))
    assert hot_surfaces(words, tasks=4) == ["hot"] and seen.value == 4000
    assert hot_surfaces(words.where("surface != 'hot'"), tasks=4) == []
