import json
import os

from kestrel.functions.analyzers import analyzed_tokens
from kestrel.sources.streams import text_line_stream
from kestrel.streaming.jobs import await_all, start_keyword_job
from kestrel.streaming.sinks import FileBatchSink


def _line(i, second, text):
    return json.dumps({"data": {"id": str(i), "text": text}, "matching_rules": [{"id": 1, "tag": "t"}],
                       "ts": f"2024-01-01T00:{second // 60:02d}:{second % 60:02d}.000+00:00"})


def test_two_queries_one_source_with_rejects(spark, scratch):
    feed = os.path.join(scratch, "feed")
    os.makedirs(feed)
    with open(os.path.join(feed, "a.json"), "w") as f:
        f.write("\n".join([_line(1, 5, "alpha beta"), "not json", '{"data":{"id":"9"}}',
                           _line(2, 200, "gamma")]) + "\n")
    sink = FileBatchSink(os.path.join(scratch, "keywords"))
    rejects = os.path.join(scratch, "rejects")
    queries = start_keyword_job(spark, text_line_stream(spark, feed), sink, os.path.join(scratch, "ckpt"),
                                trigger={"availableNow": True}, rejects_path=rejects)
    assert [q.name for q in queries] == ["keywords to database", "texts to console", "rejected messages"]
    await_all(spark, queries, timeout=300)
    stored = sorted((r["keyword"], r["appearances"]) for r in sink.read(spark).collect())
    assert stored == [("alpha", 1), ("beta", 1)]  # the window of gamma is still open
    reasons = sorted((r["reason"], r["id"]) for r in spark.read.parquet(rejects).collect())
    assert reasons == [("malformed", None), ("no_text", "9")]
    for name in ("database-sink", "console", "rejects"):
        assert os.path.isdir(os.path.join(scratch, "ckpt", name))


def _toy_analyzer(text):
    # Splits on spaces; words ending in "ru" are verbs with themselves as base form, "wa" is a particle.
    for w in text.split():
        if w == "wa":
            yield w, "助詞,係助詞,*,*", w
        elif w.endswith("ru"):
            yield w, "動詞,自立,*,*", w[:-2] + "ru"
        else:
            yield w, "名詞,一般,*,*", w


def test_pluggable_analyzer(spark):
    df = spark.createDataFrame([(1, "inu wa hashiru https://t.co/x1 123"), (2, None)], "i int, text string")
    rows = [r["keyword"] for r in analyzed_tokens(df, "text", ["i"], _toy_analyzer,
                                                  ship_analyzer_module=True).collect()]
    assert rows == ["inu", "hashiru"]


def test_stream_with_lexicon(spark, scratch):
    from kestrel.streaming.jobs import keyword_sink_writer, run_to_end

    feed = os.path.join(scratch, "feed")
    os.makedirs(feed)
    with open(os.path.join(feed, "a.json"), "w") as f:
        f.write("\n".join([_line(1, 1, "dog is running"), _line(2, 2, "the dog"), _line(3, 100, "late")]) + "\n")
    lexicon = [("is", "動詞,自立,*,*", "be"), ("the", "連体詞,*,*,*", "the"), ("running", "動詞,自立,*,*", "run")]
    sink = FileBatchSink(os.path.join(scratch, "out"))
    run_to_end(keyword_sink_writer(text_line_stream(spark, feed), sink, os.path.join(scratch, "ckpt"),
                                   lexicon=lexicon))
    got = sorted((r["keyword"], r["appearances"]) for r in sink.read(spark).collect())
    assert got == [("be", 1), ("dog", 2), ("run", 1)]


def test_file_sink_window_table_equals_batch_sink(spark, scratch):
    from kestrel.streaming.jobs import keyword_sink_writer, run_to_end, window_table_writer

    feed = os.path.join(scratch, "feed")
    os.makedirs(feed)
    with open(os.path.join(feed, "a.json"), "w") as f:
        f.write("\n".join([_line(1, 1, "alpha beta"), _line(2, 40, "beta"), _line(3, 300, "gamma")]) + "\n")
    table = os.path.join(scratch, "table")
    run_to_end(window_table_writer(text_line_stream(spark, feed), table, os.path.join(scratch, "c1")))
    sink = FileBatchSink(os.path.join(scratch, "batches"))
    run_to_end(keyword_sink_writer(text_line_stream(spark, feed), sink, os.path.join(scratch, "c2")))
    rows = lambda df: sorted(tuple(r) for r in df.select("window_start", "keyword", "appearances").collect())
    stored = spark.read.parquet(table)
    assert "window_day" in stored.columns
    assert rows(stored) == rows(sink.read(spark)) and len(rows(stored)) == 3


def test_kafka_job_reaches_the_source(spark, scratch):
    """No Kafka connector here: the job is wired up to the point where Spark looks for it."""
    import pytest

    from kestrel import cli

    with pytest.raises(Exception, match="Failed to find data source: kafka"):
        cli.main(["keyword-stream", "--topic", "t", "--checkpoint-location", os.path.join(scratch, "c"),
                  "--url", "jdbc:none", "--table", "T", "--max-offsets-per-trigger", "1000"])


def test_stream_with_lexicon_table_is_salted(spark, scratch):
    from kestrel.streaming.jobs import keyword_sink_writer, run_to_end

    feed = os.path.join(scratch, "feed")
    os.makedirs(feed)
    with open(os.path.join(feed, "a.json"), "w") as f:
        f.write("\n".join([_line(1, 1, "dog is running " * 20), _line(2, 2, "the dog"), _line(3, 100, "late")]) + "\n")
    lexicon = [("is", "動詞,自立,*,*", "be"), ("the", "連体詞,*,*,*", "the"), ("running", "動詞,自立,*,*", "run")]
    table = spark.createDataFrame(lexicon, "surface string, pos string, base_form string")
    results = []
    for name, lex in (("list", lexicon), ("table", table)):
        sink = FileBatchSink(os.path.join(scratch, name))
        run_to_end(keyword_sink_writer(text_line_stream(spark, feed), sink, os.path.join(scratch, "c" + name),
                                       lexicon=lex))
        results.append(sorted((r["keyword"], r["appearances"]) for r in sink.read(spark).collect()))
    assert results[0] == results[1] == [("be", 20), ("dog", 21), ("run", 20)]


def test_count_keywords_on_a_stream_with_lexicon_table(spark, scratch):
    from kestrel.functions.keywords import count_keywords
    from kestrel.streaming.jobs import decoded_texts, run_to_end

    feed = os.path.join(scratch, "feed")
    os.makedirs(feed)
    with open(os.path.join(feed, "a.json"), "w") as f:
        f.write("\n".join([_line(1, 1, "dog is running"), _line(2, 2, "the dog is")]) + "\n")
    table = spark.createDataFrame([("is", "動詞,自立,*,*", "be"), ("the", "連体詞,*,*,*", "the")],
                                  "surface string, pos string, base_form string")
    texts, _ = decoded_texts(text_line_stream(spark, feed))
    counts = count_keywords(texts, "text", [], lexicon=table)
    writer = (counts.writeStream.format("memory").outputMode("complete").queryName("kw_stream_table")
              .option("checkpointLocation", os.path.join(scratch, "ckpt")))
    run_to_end(writer)
    got = sorted((r["keyword"], r["appearances"]) for r in spark.sql("SELECT * FROM kw_stream_table").collect())
    assert got == [("be", 2), ("dog", 2), ("running", 1)]
