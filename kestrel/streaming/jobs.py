"""Streaming jobs (Q5, Q6): messages → keyword counts per window → micro-batch sink, and
messages → text → console, as two queries over one source definition (T6), each with its own
checkpoint (T5) and name (T8).

The state of the windowed count is bounded by the watermark: only windows not yet closed are
kept. Its partition count is fixed by ``spark.sql.shuffle.partitions`` when a checkpoint is first
created; size it for the cluster before the first start. For large state, the RocksDB state store
(``spark.sql.streaming.stateStore.providerClass``, see ``session.ROCKSDB_PROVIDER`` and
``session.cluster_settings``) keeps it off the JVM heap.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from kestrel.functions.keywords import stored_lexicon
from kestrel.functions.messages import decode_messages, split_rejects
from kestrel.session import ROCKSDB_PROVIDER, settings_of
from kestrel.sinks.console import console_stream_writer
from kestrel.sources.streams import payload_text
from kestrel.streaming.windows import count_window_texts, keyword_counts, texts_per_window

BatchSink = Callable[[DataFrame, int], None]

#: how long one of several queries is waited for before the next one is looked at
POLL_SECONDS = 0.2


#: state in RocksDB, committed by the changes of a batch. Every text of the feed goes through these changes, so they are
#: well compressed, and Spark need keep few batches' (it may drop those before older snapshots, one every ten batches; in
#: a run of 24 batches none had gone): a query goes on from its last batch, or the one before it. Without fallocate a partition takes the disk
#: that it fills, not some 4 MB more.
ROCKSDB_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.minBatchesToRetain": "2",
}


def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, off the JVM heap, and commit a batch by its changes alone;
    the session's own settings come back afterwards (a query keeps those it was started with)."""
    return settings_of(spark, ROCKSDB_SETTINGS)


def checkpoint_dir(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def decoded_texts(messages: DataFrame, need_time: bool = True) -> tuple[DataFrame, DataFrame]:
    """``value`` stream → (``ts, id, text`` rows with text, rejects). A message without a usable
    time is a reject, unless ``need_time`` is False (its text can still be shown)."""
    decoded = decode_messages(payload_text(messages), keep=["value"])
    kept, rejects = split_rejects(decoded, need_time=need_time)
    return kept.select("ts", "id", "text"), rejects


def with_trigger(writer: DataStreamWriter, trigger: dict | None) -> DataStreamWriter:
    """``trigger`` as keyword arguments of ``DataStreamWriter.trigger``; None keeps the default
    (T11: the next micro-batch starts when the previous one ends)."""
    return writer.trigger(**trigger) if trigger else writer


def keyword_sink_writer(messages: DataFrame, sink: BatchSink, checkpoint_base: str,
                        window: str = "30 seconds", watermark: str = "30 seconds", lexicon=None,
                        pos_mode: str = "subclass", trigger: dict | None = None,
                        query_name: str = "keywords to database", hot_surfaces: list[str] | None = None) -> DataStreamWriter:
    """``hot_surfaces``: words so frequent that their lexicon lookup is salted (see ``hot_surfaces`` in
    ``functions.keywords``, over an earlier day's texts). The windows' texts are kept in state until the watermark closes
    them; their keywords are counted on the way to the sink. The lexicon is stored beside the checkpoint when the writer
    is made, so no batch prepares it anew."""
    texts, _ = decoded_texts(messages)
    lex = None if lexicon is None else stored_lexicon(messages.sparkSession, lexicon, checkpoint_dir(checkpoint_base, "lexicon"))
    closed = texts_per_window(texts, "ts", "text", window, watermark)

    def count_and_store(batch_df: DataFrame, batch_id: int) -> None:
        sink(count_window_texts(batch_df, lex, pos_mode, hot_surfaces, one_reading=True), batch_id)

    writer = (closed.writeStream.outputMode("append").foreachBatch(count_and_store)
              .option("checkpointLocation", checkpoint_dir(checkpoint_base, "database-sink"))
              .queryName(query_name))
    return with_trigger(writer, trigger)


def text_console_writer(messages: DataFrame, checkpoint_base: str, num_output_rows: int = 128,
                        trigger: dict | None = None, query_name: str = "texts to console") -> DataStreamWriter:
    texts, _ = decoded_texts(messages, need_time=False)
    writer = console_stream_writer(texts.select("text"), checkpoint_dir(checkpoint_base, "console"),
                                   num_output_rows, query_name=query_name)
    return with_trigger(writer, trigger)


def text_table_writer(messages: DataFrame, path: str, checkpoint_base: str, trigger: dict | None = None,
                      query_name: str = "texts to table") -> DataStreamWriter:
    """Q6 with a table in the place of the console: id and text of every message that has a text."""
    texts, _ = decoded_texts(messages, need_time=False)
    writer = (texts.select("id", "text").writeStream.format("parquet").outputMode("append").option("path", path)
              .option("checkpointLocation", checkpoint_dir(checkpoint_base, "texts")).queryName(query_name))
    return with_trigger(writer, trigger)


def rejects_writer(messages: DataFrame, path: str, checkpoint_base: str,
                   trigger: dict | None = None) -> DataStreamWriter:
    """Messages without text or time, with the reason, to a file table (exactly once via the file sink log)."""
    _, rejects = decoded_texts(messages)
    writer = (rejects.writeStream.format("parquet").outputMode("append").option("path", path)
              .option("checkpointLocation", checkpoint_dir(checkpoint_base, "rejects"))
              .queryName("rejected messages"))
    return with_trigger(writer, trigger)


def start_keyword_job(spark: SparkSession, messages: DataFrame, sink: BatchSink, checkpoint_base: str,
                      window: str = "30 seconds", watermark: str = "30 seconds", num_output_rows: int = 128,
                      lexicon=None, pos_mode: str = "subclass", trigger: dict | None = None,
                      console: bool = True, rejects_path: str | None = None,
                      texts_path: str | None = None, hot_surfaces: list[str] | None = None) -> list[StreamingQuery]:
    """Start the keyword query, and the console, text table and rejects queries when asked for. All of
    them run at once over one source definition, each with its own checkpoint (T6); if one cannot be
    started, those already started are stopped."""
    writers = [keyword_sink_writer(messages, sink, checkpoint_base, window, watermark, lexicon, pos_mode, trigger,
                                   hot_surfaces=hot_surfaces)]
    if console:
        writers.append(text_console_writer(messages, checkpoint_base, num_output_rows, trigger))
    if texts_path:
        writers.append(text_table_writer(messages, texts_path, checkpoint_base, trigger))
    if rejects_path:
        writers.append(rejects_writer(messages, rejects_path, checkpoint_base, trigger))
    started: list[StreamingQuery] = []
    try:
        for writer in writers:
            started.append(writer.start())
    except Exception:
        for query in started:
            query.stop()
        raise
    return started


def await_all(spark: SparkSession, queries: list[StreamingQuery], timeout: float | None = None) -> bool:
    """Wait until every query ends or ``timeout`` seconds pass; returns whether all ended.

    The first failure of any query is raised at once and stops the others (T9), instead of
    going unnoticed while the job waits on another query. Only these queries are looked at, so what other
    queries of the session do neither ends nor prolongs the wait.
    """
    deadline = None if timeout is None else time.monotonic() + timeout
    pending = list(queries)
    while pending:
        for q in list(pending):
            left = POLL_SECONDS if deadline is None else min(POLL_SECONDS, max(0.01, deadline - time.monotonic()))
            try:
                ended = q.awaitTermination(left)
            except Exception:
                for other in queries:
                    if other.isActive:
                        other.stop()
                raise
            if ended:
                pending.remove(q)
        if deadline is not None and time.monotonic() >= deadline:
            break
    return not pending


def run_to_end(writer: DataStreamWriter, timeout: float | None = None) -> StreamingQuery:
    """Process everything available now, then stop. ``timeout`` seconds, if given, bound the wait."""
    query = writer.trigger(availableNow=True).start()
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {query.name} did not finish in {timeout} s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def run_keyword_job(spark: SparkSession, bootstrap_servers: str, topic: str, sink: BatchSink,
                    checkpoint_location: str, window: str = "30 seconds", watermark: str = "30 seconds",
                    num_output_rows: int = 128, lexicon=None, pos_mode: str = "subclass",
                    starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                    trigger: dict | None = None, rejects_path: str | None = None,
                    timeout: float | None = None, console: bool = True, hot_surfaces: list[str] | None = None,
                    **kafka_options) -> list[StreamingQuery]:
    """Q5 + Q6 as one job: subscribe to ``topic``, count keywords per window into ``sink``
    (e.g. ``JdbcBatchSink``), print texts, and wait; a failure of either query ends the job.

    Each query reads the topic on its own (two reads of every record); ``console=False`` keeps
    only the keyword query for production runs.
    """
    from kestrel.sources.streams import kafka_stream

    messages = kafka_stream(spark, bootstrap_servers, topic, starting_offsets, fail_on_data_loss,
                            **kafka_options)
    started = start_keyword_job(spark, messages, sink, checkpoint_location, window, watermark,
                                num_output_rows, lexicon, pos_mode, trigger, console, rejects_path,
                                hot_surfaces=hot_surfaces)
    await_all(spark, started, timeout)
    return started


def window_table_writer(messages: DataFrame, path: str, checkpoint_base: str, window: str = "30 seconds",
                        watermark: str = "30 seconds", lexicon=None, pos_mode: str = "subclass",
                        trigger: dict | None = None) -> DataStreamWriter:
    """Closed windows appended to a parquet table partitioned by ``window_day`` through Spark's
    file sink, whose metadata log makes each micro-batch land exactly once (no ``foreachBatch``
    needed). Readers must read the table through that log: ``spark.read.parquet(path)``."""
    from kestrel.streaming.windows import with_window_day

    texts, _ = decoded_texts(messages)
    counts = with_window_day(keyword_counts(texts, "ts", "text", window, watermark, lexicon, pos_mode))
    writer = (counts.writeStream.format("parquet").outputMode("append").partitionBy("window_day")
              .option("path", path)
              .option("checkpointLocation", checkpoint_dir(checkpoint_base, "window-table"))
              .queryName("keywords to table"))
    return with_trigger(writer, trigger)
