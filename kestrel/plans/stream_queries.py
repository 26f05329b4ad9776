"""Registered streaming queries. A file stream stands in for the message topic; each query runs
to the end of its input (``availableNow``), writes through its sink into the shared folder, and
returns the stored table. Append mode emits only windows the watermark has closed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from kestrel.functions.keywords import explode_tokens, hot_surfaces
from kestrel.functions.messages import envelope_json, iso_stamp
from kestrel.plans.tables import table, text_table
from kestrel.plans.text_queries import (SQL_DOC_COUNTS, SQL_DOC_TS, doc_rules, doc_time, lexicon_table,
                                        sql_lexicon_keywords)
from kestrel.session import settings_of, shared_path, shuffles_dropped
from kestrel.sources.files import files_in_name_order, non_blank_lines
from kestrel.sinks.files import write_files
from kestrel.sources.streams import file_stream, table_stream, text_line_stream
from kestrel.streaming.jobs import (await_all, decoded_texts, keyword_sink_writer, rocksdb_state, run_to_end,
                                    start_keyword_job)
from kestrel.streaming.progress import ProgressTable
from kestrel.streaming.sinks import CommittedFileSink, FileBatchSink, WindowTableSink
from kestrel.streaming.windows import as_wall_clock, count_per_window

WINDOW_TABLE_SCHEMA = StructType([
    StructField("window_start", TimestampType()), StructField("window_end", TimestampType()),
    StructField("keyword", StringType()), StructField("appearances", LongType()),
])


#: a feed comes in at least so many files, in order of time, each of about FEED_BYTES of its table at most; a stream
#: takes one of them per micro-batch, so a batch, and the windows that it leaves open, do not grow with the feed
FEED_FILES, FEED_BYTES = 8, 64 << 20
#: the same for a stream that takes four files at once and keeps its state in memory
SMALL_FEED_BYTES = 8 << 20
#: partitions that a batch is dealt to at most, unless the cluster has more cores
BATCH_PARTITIONS = 48
#: a batch of the keyword stream is so many files, packed ones, which no two tasks can share
FEED_PARTS = 8


def feed_files(source: DataFrame, file_bytes: int) -> int:
    """How many files the feed of a stored table comes in."""
    return max(FEED_FILES, -(-int(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) // file_bytes))


def write_in_order(rows: DataFrame, time_col: str, path: str, fmt: str, files: int = FEED_FILES, keep_time: bool = True, **options) -> str:
    """``rows`` as files of ascending time, which a file stream takes one after another."""
    ordered = rows.repartitionByRange(files, time_col).sortWithinPartitions(time_col)
    write_files(ordered if keep_time else ordered.drop(time_col), path, fmt, **options)
    files_in_name_order(rows.sparkSession, path)
    return path


def write_document_feed(spark: SparkSession, sf_dir: str, blank_lines: bool = False, file_bytes: int | None = None,
                        parts: int = 1, **options) -> str:
    """Documents as a JSON-line feed in the shared folder (one envelope per line, in files of ascending
    time); optionally a blank keep-alive line after each French message. ``parts``: each file comes in so many."""
    docs = text_table(spark, sf_dir, "documents")
    line = envelope_json(F.col("doc_id"), F.col("text"), iso_stamp(doc_time()), doc_rules())
    with_blank = F.lit(blank_lines) & (F.col("lang") == "fr")
    lines = docs.select(doc_time().alias("ts"), F.explode(F.when(with_blank, F.array(line, F.lit(""))).otherwise(F.array(line)))
                        .alias("value"))
    files = feed_files(table(spark, sf_dir, "documents"), file_bytes or FEED_BYTES)
    return write_in_order(lines, "ts", shared_path(spark, "feed"), "text", files * parts, keep_time=False, **options)


def run_bounded(spark: SparkSession, writer: DataStreamWriter) -> StreamingQuery:
    """Run to the end of the input with the state in RocksDB, in no more partitions than a batch fills: batches stay as
    large as they are however many partitions the session has for its largest tables."""
    most = max(BATCH_PARTITIONS, spark.sparkContext.defaultParallelism)
    partitions = min(most, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # times as plain numbers cost less to write and to read than Spark's default, the 12 bytes of old readers
    stream = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}
    with rocksdb_state(spark), settings_of(spark, stream):
        return run_to_end(writer)


def keyword_stream(spark: SparkSession, sf_dir: str, lexicon: DataFrame | None = None,
                   hot_surfaces: list[str] | None = None) -> tuple[DataFrame, StreamingQuery]:
    """The stored window table of Q5, and the query that filled it, FEED_PARTS packed feed files per micro-batch."""
    with shuffles_dropped(spark):
        feed = write_document_feed(spark, sf_dir, parts=FEED_PARTS, compression="lz4")
        messages = text_line_stream(spark, feed, max_files_per_trigger=FEED_PARTS)
        sink = WindowTableSink(shared_path(spark, "keywords"))
        query = run_bounded(spark, keyword_sink_writer(messages, sink, shared_path(spark, "ckpt"), "30 seconds", "30 seconds",
                                                       lexicon=lexicon, hot_surfaces=hot_surfaces))
    stored = sink.read(spark, schema=WINDOW_TABLE_SCHEMA).select(*WINDOW_TABLE_SCHEMA.fieldNames())
    return as_wall_clock(stored, "window_start", "window_end"), query


def q_keyword_counts_stream(spark, sf_dir):
    """Q5: feed → decode → keywords → 30 s windows, 30 s watermark → replay-safe batch sink. The feed
    arrives in several micro-batches; state holds the open windows only."""
    return keyword_stream(spark, sf_dir)[0]


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_stream(spark, sf_dir, "events", table(spark, sf_dir, "events").schema)


def event_window_stream(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, StreamingQuery]:
    events = table(spark, sf_dir, "events").select("ts", "event_type")
    feed = write_in_order(events, "ts", shared_path(spark, "events-feed"), "parquet", feed_files(events, FEED_BYTES))
    counts = count_per_window(file_stream(spark, feed, events.schema, max_files_per_trigger=1), "ts", "event_type",
                              "30 minutes", delay="30 minutes")
    sink = FileBatchSink(shared_path(spark, "event-windows"))
    query = run_bounded(spark, counts.writeStream.outputMode("append").foreachBatch(sink)
                        .option("checkpointLocation", shared_path(spark, "ckpt")).queryName("event windows"))
    return as_wall_clock(sink.read(spark, schema=WINDOW_TABLE_SCHEMA), "window_start", "window_end"), query


def q_window_counts_stream(spark, sf_dir):
    """Events per (30 min window, event type) from a stream with a 30 min watermark, in several batches."""
    return event_window_stream(spark, sf_dir)[0]


def two_deliveries(spark: SparkSession, sf_dir: str, name: str, progress: ProgressTable | None = None) -> DataFrame:
    """Event windows of a feed in two deliveries, the second one late (every fifth event, of any time)."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    late = F.coalesce(F.col("event_id") % 5 == 0, F.lit(False))
    feed, checkpoint = shared_path(spark, "events-feed"), shared_path(spark, "ckpt")
    sink = FileBatchSink(shared_path(spark, "event-windows"))
    for delivery in (~late, late):
        write_files(events.filter(delivery), feed, "parquet", mode="append")
        counts = count_per_window(file_stream(spark, feed, events.schema), "ts", "event_type", "30 minutes",
                                  delay="30 minutes")
        query = run_to_end(counts.writeStream.outputMode("append").foreachBatch(sink)
                           .option("checkpointLocation", checkpoint).queryName(name))
        if progress:
            progress.wait_for(query)
    return as_wall_clock(sink.read(spark, schema=WINDOW_TABLE_SCHEMA), "window_start", "window_end")


def q_window_counts_late_rows(spark, sf_dir):
    """After the first delivery the watermark stands 30 minutes before its newest event; late rows of
    windows it has closed are dropped, the others are counted."""
    return two_deliveries(spark, sf_dir, "event windows with late rows")


def q_stream_progress(spark, sf_dir):
    """What the query of that name read and dropped as late, and its last watermark, from the table
    that its listener wrote."""
    name = "event windows in two deliveries"
    with ProgressTable(spark, shared_path(spark, "progress")) as progress:
        two_deliveries(spark, sf_dir, name, progress)
    batches = progress.read().filter(F.col("query") == name)
    return batches.groupBy("query").agg(
        F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"),
        F.max(F.col("watermark").cast("timestamp")).cast("timestamp_ntz").alias("watermark"))


def q_keyword_counts_stream_lexicon(spark, sf_dir):
    """Q5 with the part-of-speech rules: the keyword stream joined to a lexicon table (U1, F6-F8). Words that
    the documents hold very often are salted, the others meet one copy of their entry."""
    lexicon = lexicon_table(spark)
    with shuffles_dropped(spark):
        hot = hot_surfaces(explode_tokens(text_table(spark, sf_dir, "documents"), "text", []))
    return keyword_stream(spark, sf_dir, lexicon, hot)[0]


def q_concurrent_queries(spark, sf_dir):
    """The keyword query and the text query of the job run at once over one feed, each with its own
    checkpoint; the rows of both."""
    messages = text_line_stream(spark, write_document_feed(spark, sf_dir, file_bytes=SMALL_FEED_BYTES), max_files_per_trigger=4)
    sink, texts = WindowTableSink(shared_path(spark, "keywords")), shared_path(spark, "texts")
    started = start_keyword_job(spark, messages, sink, shared_path(spark, "ckpt"), trigger={"availableNow": True},
                                console=False, texts_path=texts)
    await_all(spark, started)
    keywords = as_wall_clock(sink.read(spark, schema=WINDOW_TABLE_SCHEMA), "window_start").select(
        F.lit("keywords").alias("result"), "window_start", F.col("keyword").alias("name"), F.col("appearances").alias("n"))
    return keywords.unionAll(spark.read.parquet(texts).select(
        F.lit("texts").alias("result"), F.lit(None).cast("timestamp_ntz").alias("window_start"), F.col("id").alias("name"),
        F.length("text").cast("long").alias("n")))


def q_committed_reads(spark, sf_dir):
    """Before every batch is stored, an earlier attempt at it dies with half of its rows written.
    Readers see committed attempts only."""
    sink = CommittedFileSink(shared_path(spark, "events-attempts"))

    def die_then_store(batch_df, batch_id):
        sink.write_attempt(batch_df.filter("event_id % 2 = 0"), batch_id)  # never committed
        sink(batch_df, batch_id)
        sink(batch_df, batch_id)  # replay of a committed batch

    events = table(spark, sf_dir, "events")
    feed = write_in_order(events, "ts", shared_path(spark, "events-feed"), "parquet", files=3)
    rows = file_stream(spark, feed, events.schema, max_files_per_trigger=1).select("event_id", "ts", "user_id", "event_type", "value")
    run_to_end(rows.writeStream.outputMode("append").foreachBatch(die_then_store)
               .option("checkpointLocation", shared_path(spark, "ckpt")).queryName("events in attempts"))
    return sink.read(spark)


def q_stream_foreach_batch(spark, sf_dir):
    """Every micro-batch is delivered twice with the same id (a replay); rows are stored once."""
    sink = FileBatchSink(shared_path(spark, "events-copy"))

    def deliver_twice(batch_df, batch_id):
        sink(batch_df, batch_id)
        sink(batch_df, batch_id)

    rows = events_stream(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value")
    writer = (rows.writeStream.outputMode("append").foreachBatch(deliver_twice)
              .option("checkpointLocation", shared_path(spark, "ckpt")).queryName("events copy"))
    run_to_end(writer)
    return sink.read(spark)


def q_stream_passthrough(spark, sf_dir):
    """Q6: feed (with blank keep-alive lines) → decoded text, as a stateless stream."""
    feed = write_document_feed(spark, sf_dir, blank_lines=True)
    texts, _ = decoded_texts(non_blank_lines(text_line_stream(spark, feed)))
    out = shared_path(spark, "texts")
    writer = (texts.select("id", "text").writeStream.format("parquet").outputMode("append")
              .option("path", out).option("checkpointLocation", shared_path(spark, "ckpt"))
              .queryName("texts"))
    run_to_end(writer)
    return spark.read.parquet(out)


QUERIES = {
    "keyword_counts_stream": q_keyword_counts_stream,
    "window_counts_stream": q_window_counts_stream,
    "window_counts_late_rows": q_window_counts_late_rows,
    "keyword_counts_stream_lexicon": q_keyword_counts_stream_lexicon,
    "stream_progress": q_stream_progress,
    "concurrent_queries": q_concurrent_queries,
    "committed_reads": q_committed_reads,
    "stream_foreach_batch": q_stream_foreach_batch,
    "stream_passthrough": q_stream_passthrough,
}

SQL_DOC_WINDOWS = f"SELECT time_bucket(INTERVAL 30 SECOND, {SQL_DOC_TS}) AS window_start, text FROM documents"

ORACLE = {
    # Only windows the watermark (latest event time minus the delay) has passed come out.
    "keyword_counts_stream": f"""
        WITH {SQL_DOC_COUNTS}
        SELECT * FROM c
        WHERE window_end <= (SELECT max({SQL_DOC_TS}) FROM documents) - INTERVAL 30 SECOND""",
    "window_counts_stream": """
        WITH c AS (
          SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS window_start,
                 time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS window_end,
                 event_type AS keyword, count(event_type) AS appearances
          FROM events GROUP BY ALL)
        SELECT * FROM c WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 30 MINUTE""",
    # The second delivery's rows count where the watermark after the first one has not closed their
    # window; what comes out in the end is what the final watermark has passed.
    "window_counts_late_rows": """
        WITH e AS (
          SELECT ts, event_type, coalesce(event_id % 5 = 0, false) AS late,
                 time_bucket(INTERVAL 30 MINUTE, ts) AS window_start,
                 time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS window_end FROM events),
        m AS (SELECT max(ts) FILTER (WHERE NOT late) - INTERVAL 30 MINUTE AS first_mark,
                     max(ts) - INTERVAL 30 MINUTE AS last_mark FROM e)
        SELECT window_start, window_end, event_type AS keyword, count(event_type) AS appearances
        FROM e, m WHERE (NOT late OR window_end > first_mark) AND window_end <= last_mark GROUP BY ALL""",
    "keyword_counts_stream_lexicon": f"""
        WITH k AS ({sql_lexicon_keywords("subclass", "window_start", SQL_DOC_WINDOWS)})
        SELECT window_start, window_start + INTERVAL 30 SECOND AS window_end, keyword, appearances FROM k
        WHERE window_start + INTERVAL 30 SECOND <= (SELECT max({SQL_DOC_TS}) FROM documents) - INTERVAL 30 SECOND""",
    # Late rows are counted where they reach the state: one per window and event type.
    "stream_progress": """
        WITH e AS (
          SELECT ts, event_type, coalesce(event_id % 5 = 0, false) AS late,
                 time_bucket(INTERVAL 30 MINUTE, ts) AS window_start FROM events),
        m AS (SELECT max(ts) FILTER (WHERE NOT late) - INTERVAL 30 MINUTE AS first_mark, max(ts) - INTERVAL 30 MINUTE AS last_mark FROM e)
        SELECT 'event windows in two deliveries' AS query, (SELECT count(*) FROM e) AS input_rows,
               (SELECT count(*) FROM (SELECT DISTINCT window_start, event_type FROM e, m
                                      WHERE late AND window_start + INTERVAL 30 MINUTE <= first_mark)) AS late_rows,
               -- progress reports give the watermark in milliseconds
               date_trunc('milliseconds', last_mark) AS watermark FROM m""",
    "concurrent_queries": f"""
        WITH {SQL_DOC_COUNTS}
        SELECT 'keywords' AS result, window_start, keyword AS name, appearances AS n FROM c
        WHERE window_end <= (SELECT max({SQL_DOC_TS}) FROM documents) - INTERVAL 30 SECOND
        UNION ALL SELECT 'texts', NULL, CAST(doc_id AS VARCHAR), length(text) FROM documents""",
    "committed_reads": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "stream_foreach_batch": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "stream_passthrough": "SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents",
}
