import datetime as dt
import json
import os

from pyspark.sql import functions as F

from kestrel.sources.streams import text_line_stream
from kestrel.streaming.jobs import keyword_sink_writer, run_to_end
from kestrel.streaming.sinks import FileBatchSink
from kestrel.streaming.windows import count_per_window, keyword_counts

BASE = dt.datetime(2024, 1, 1)


def _ts(seconds):
    return (BASE + dt.timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "+00:00"


def _message(i, seconds, text):
    return json.dumps({"data": {"id": str(i), "text": text}, "matching_rules": [], "ts": _ts(seconds)})


def test_window_edges(spark):
    df = spark.createDataFrame([(BASE + dt.timedelta(seconds=29.999), "a"), (BASE + dt.timedelta(seconds=30), "a")],
                               "ts timestamp, k string")
    rows = sorted(count_per_window(df, "ts", "k", "30 seconds").collect(), key=lambda r: r["window_start"])
    assert [(r["window_start"], r["window_end"]) for r in rows] == [
        (BASE, BASE + dt.timedelta(seconds=30)), (BASE + dt.timedelta(seconds=30), BASE + dt.timedelta(seconds=60))]


def test_batch_keyword_counts(spark):
    df = spark.createDataFrame([(BASE + dt.timedelta(seconds=5), "alpha beta alpha"),
                                (BASE + dt.timedelta(seconds=35), "beta"), (BASE, None)], "ts timestamp, text string")
    rows = {(r["window_start"].second, r["keyword"]): r["appearances"] for r in keyword_counts(df).collect()}
    assert rows == {(0, "alpha"): 2, (0, "beta"): 1, (30, "beta"): 1}


def _write_batch(folder, n, lines):
    path = os.path.join(folder, f"batch-{n:03d}.json")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    stamp = 1_700_000_000 + n * 10
    os.utime(path, (stamp, stamp))


def test_late_rows_fixed_batches_restart_and_replay(spark, scratch):
    feed = os.path.join(scratch, "feed")
    os.makedirs(feed)
    _write_batch(feed, 1, [_message(1, 5, "alpha beta alpha"), _message(2, 35, "beta")])
    _write_batch(feed, 2, [_message(3, 120, "gamma")])
    _write_batch(feed, 3, [_message(4, 10, "late"), _message(5, 300, "delta")])
    emitted = []
    store = FileBatchSink(os.path.join(scratch, "store"))

    def sink(batch_df, batch_id):
        rows = sorted((r["window_start"].strftime("%H:%M:%S"), r["keyword"], r["appearances"])
                      for r in batch_df.collect())
        emitted.append((batch_id, rows))
        store(batch_df, batch_id)

    ckpt = os.path.join(scratch, "ckpt")
    messages = text_line_stream(spark, feed, max_files_per_trigger=1)
    run_to_end(keyword_sink_writer(messages, sink, ckpt, "30 seconds", "30 seconds"))
    non_empty = [rows for _, rows in emitted if rows]
    assert [rows for _, rows in emitted][:2] == [[], []]
    assert non_empty[0] == [("00:00:00", "alpha", 2), ("00:00:00", "beta", 1), ("00:00:00", "late", 1),
                            ("00:00:30", "beta", 1)]
    assert non_empty[1:] == [[("00:02:00", "gamma", 1)]]

    # Restart from the same checkpoint with one more file: delta comes out once, nothing repeats.
    _write_batch(feed, 4, [_message(6, 360, "eps")])
    emitted.clear()
    run_to_end(keyword_sink_writer(text_line_stream(spark, feed, max_files_per_trigger=1), sink, ckpt,
                                   "30 seconds", "30 seconds"))
    assert [rows for _, rows in emitted if rows] == [[("00:05:00", "delta", 1)]]

    # Replay: the same batch id delivered again is stored once.
    last_id = emitted[-1][0]
    stored_before = store.read(spark).count()
    replay = spark.createDataFrame([(BASE, BASE, "x", 1)], "window_start timestamp, window_end timestamp, "
                                   "keyword string, appearances long")
    store(replay, last_id)
    store(replay, last_id)
    assert store.read(spark).filter(F.col("keyword") == "x").count() == 1
    assert store.read(spark).count() <= stored_before + 1


def test_table_lexicon_preaggregates_and_matches_list_lexicon(spark, capsys):
    lexicon = [("is", "動詞,自立,*,*", "be"), ("the", "連体詞,*,*,*", "the"), ("dog", "名詞,一般,*,*", "dog")]
    df = spark.createDataFrame([(BASE + dt.timedelta(seconds=s), t) for s, t in
                                [(1, "the dog is here"), (2, "the dog is the dog"), (40, "is it")]],
                               "ts timestamp, text string")
    from_list = keyword_counts(df, lexicon=lexicon)
    table = spark.createDataFrame(lexicon, "surface string, pos string, base_form string")
    from_table = keyword_counts(df, lexicon=table)
    rows = lambda d: sorted((r["window_start"].second, r["keyword"], r["appearances"]) for r in d.collect())
    assert rows(from_list) == rows(from_table) == [
        (0, "be", 2), (0, "dog", 3), (0, "here", 1), (30, "be", 1), (30, "it", 1)]
    from_table.explain()
    plan = capsys.readouterr().out
    assert plan.count("partial_count") >= 1 and "partial_sum" in plan


def test_stream_equals_batch_on_closed_windows(spark):
    """Q5 streaming vs its batch form: the same rows for every window the watermark closed."""
    from kestrel.plans import stream_queries, text_queries

    sf = "/root/testdata/sf0.001"
    streamed = stream_queries.q_keyword_counts_stream(spark, sf)
    batch = text_queries.q_keyword_counts_batch(spark, sf)
    last = text_queries.table(spark, sf, "documents").agg(F.max("doc_id")).collect()[0][0]
    limit = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=last - 30)
    closed = batch.filter(F.col("window_end") <= F.lit(limit).cast("timestamp_ntz"))
    key = lambda d: sorted(tuple(r) for r in d.select("window_start", "window_end", "keyword", "appearances").collect())
    assert key(streamed) == key(closed) and len(key(closed)) > 0


class _Database:
    """Tables in memory in the place of a database; ``fail`` makes the next reads or writes fail."""

    def __init__(self, monkeypatch):
        import kestrel.streaming.sinks as sinks

        self.tables, self.schemas, self.fail, self.writers = {}, {}, None, []
        monkeypatch.setattr(sinks, "read_jdbc", self.read)
        monkeypatch.setattr(sinks, "write_jdbc", self.write)

    def read(self, spark, url, table, properties=None, **_):
        if self.fail == "read":
            raise RuntimeError("connection lost")
        return spark.createDataFrame([tuple(r) for r in self.tables[table]], self.schemas[table])

    def write(self, df, url, table, properties=None, mode="append", num_partitions=None, **_):
        assert mode == "append"
        rows = df.collect()
        self.schemas.setdefault(table, df.schema)
        self.tables.setdefault(table, []).extend(rows)
        self.writers.append((table, num_partitions))
        if self.fail == table:
            raise RuntimeError("connection lost while writing")


def test_jdbc_batch_sink_stores_a_replayed_batch_once(spark, monkeypatch):
    import pytest

    from kestrel.streaming.sinks import JdbcBatchSink

    database = _Database(monkeypatch)
    sink = JdbcBatchSink("jdbc:none", "T")
    batch = spark.createDataFrame([("a", 1), ("b", 2)], "keyword string, appearances long")
    sink(batch, 0)
    sink(batch, 0)  # replay of a committed batch
    database.fail = "T"
    with pytest.raises(RuntimeError):
        sink(batch, 1)  # rows arrive, the commit does not
    database.fail = "read"
    with pytest.raises(RuntimeError):
        sink(batch, 0)  # a lost connection is an error, not an empty table
    database.fail = None
    sink(batch, 1)
    rows = sorted((r["keyword"], r["batch_id"]) for r in sink.committed_rows(spark).collect())
    assert rows == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]
    assert {n for table, n in database.writers if table == "T"} == {None}  # as parallel as the batch


def test_state_stays_bounded_by_the_watermark(spark, scratch):
    feed = os.path.join(scratch, "feed")
    os.makedirs(feed)
    # Six batches in event-time order, 30 s apart, each with 20 distinct keywords.
    for b in range(6):
        words = " ".join(f"k{b}x{i}" for i in range(20))
        _write_batch(feed, b, [_message(b * 10 + j, b * 30 + j, words) for j in range(5)])
    sink = FileBatchSink(os.path.join(scratch, "out"))
    query = run_to_end(keyword_sink_writer(text_line_stream(spark, feed, max_files_per_trigger=1), sink,
                                           os.path.join(scratch, "ckpt"), "30 seconds", "30 seconds"))
    state_rows = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(state_rows) <= 3 * 20          # a few open windows, never the whole history
    assert sink.read(spark).count() >= 4 * 20  # closed windows were emitted along the way


def test_state_holds_texts_not_words(spark, scratch):
    """A row of state per distinct text of an open window, however many words it has; repeated texts count each time."""
    feed = os.path.join(scratch, "feed")
    os.makedirs(feed)
    words = " ".join(f"k{i}" for i in range(200))
    for b in range(4):
        _write_batch(feed, b, [_message(b * 10 + j, b * 30 + j, words if j < 3 else f"{words} other") for j in range(5)])
    sink = FileBatchSink(os.path.join(scratch, "out"))
    query = run_to_end(keyword_sink_writer(text_line_stream(spark, feed, max_files_per_trigger=1), sink,
                                           os.path.join(scratch, "ckpt"), "30 seconds", "30 seconds"))
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 3 * 2
    rows = sink.read(spark).groupBy("window_start", "keyword").agg(F.count("*").alias("rows"), F.sum("appearances").alias("n")).collect()
    assert {(r["rows"], r["n"]) for r in rows if r["keyword"] != "other"} == {(1, 5)}
    assert {(r["rows"], r["n"]) for r in rows if r["keyword"] == "other"} == {(1, 2)}


def test_one_day_batch_is_written_by_many_tasks_and_can_be_compacted(spark, scratch):
    import glob

    from kestrel.streaming.sinks import WindowTableSink

    rows = [(BASE + dt.timedelta(days=d, seconds=s), BASE + dt.timedelta(days=d, seconds=s + 30), f"k{s}", 1)
            for d in range(2) for s in range(0, 3000, 30)]
    batch = spark.createDataFrame(rows, "window_start timestamp, window_end timestamp, keyword string, "
                                        "appearances long").repartition(16)
    sink = WindowTableSink(os.path.join(scratch, "t"))
    sink(batch, 7)
    sink(batch, 7)  # replay
    for day in ("2024-01-01", "2024-01-02"):
        files = glob.glob(os.path.join(scratch, "t", f"window_day={day}", "batch_id=7", "part-*"))
        assert len(files) > 4
    assert sink.read(spark).count() == len(rows)
    sink.compact(spark, os.path.join(scratch, "c"), "window_start", "keyword")
    assert len(glob.glob(os.path.join(scratch, "c", "window_day=2024-01-01", "part-*"))) < len(files)
    assert spark.read.parquet(os.path.join(scratch, "c")).count() == len(rows)


def test_batch_sink_read_raises_on_a_damaged_folder(spark, scratch):
    import pytest

    schema = spark.range(1).schema
    sink = FileBatchSink(os.path.join(scratch, "t"))
    assert sink.read(spark, schema=schema).count() == 0  # nothing written yet
    os.makedirs(os.path.join(scratch, "t", "batch_id=0"))
    with open(os.path.join(scratch, "t", "batch_id=0", "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        sink.read(spark, schema=schema).collect()


def test_stream_queries_on_a_directory_of_part_files(spark, scratch):
    """Tables stored as several part files: the stream queries see all of them."""
    from kestrel.plans import stream_queries, text_queries
    from kestrel.plans.tables import table

    sf = "/root/testdata/sf0.001"
    for name in ("events", "documents"):
        table(spark, sf, name).repartition(3).write.parquet(f"{scratch}/{name}.parquet")
    key = lambda d: sorted(tuple(r) for r in d.collect())
    assert key(stream_queries.q_window_counts_stream(spark, scratch)) == key(stream_queries.q_window_counts_stream(spark, sf))
    assert stream_queries.q_stream_foreach_batch(spark, scratch).count() == table(spark, sf, "events").count()
    assert text_queries.q_window_counts_batch(spark, scratch).count() > 0
    assert stream_queries.q_keyword_counts_stream(spark, scratch).count() == stream_queries.q_keyword_counts_stream(spark, sf).count()


def test_window_texts_meet_any_lexicon_alike(spark, scratch):
    """A lexicon prepared once and stored, broadcast by its size or too large for that, gives the rows of one prepared anew."""
    from kestrel.functions.keywords import stored_lexicon
    from kestrel.streaming.windows import count_window_texts

    rows = [(BASE + dt.timedelta(seconds=30 * w), BASE + dt.timedelta(seconds=30 * w + 30), f"the dog is w{i} http {i} über 犬", 1 + i % 2)
            for w in range(3) for i in range(50)]
    texts = spark.createDataFrame(rows, "start timestamp, end timestamp, text string, times long").selectExpr(
        "named_struct('start', start, 'end', end) AS window", "text", "times")
    lexicon = [("the", "連体詞,*,*,*", "the"), ("is", "動詞,自立,*,*", "be"), ("is", "名詞,一般", "is"), ("犬", "名詞,一般,*,*", "犬")]
    stored = stored_lexicon(spark, lexicon, os.path.join(scratch, "lexicon"))
    assert stored.count() == 3
    counted = lambda *a, **k: sorted(map(tuple, count_window_texts(texts, *a, **k).collect()))
    expected = counted(lexicon, hot_surfaces=["is"])
    assert {(r[2], r[3]) for r in expected if not r[2].startswith("w")} == {("be", 75), ("dog", 75), ("犬", 75)}
    key = "spark.sql.autoBroadcastJoinThreshold"
    for limit in ("10MB", "-1"):
        spark.conf.set(key, limit)
        try:
            assert counted(stored, hot_surfaces=["is"], one_reading=True) == expected
        finally:
            spark.conf.unset(key)
