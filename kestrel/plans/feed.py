"""Q11: a JSON-line feed stamped with its arrival time and published keyed by message id.

Batch form reads files of lines; stream form reads new files as they land. Both drop blank
keep-alive lines, add ``ts``, and write ``(key, value)`` records to a Kafka topic (K6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kestrel.functions.messages import stamp_feed_lines
from kestrel.sinks.kafka import kafka_stream_writer, write_kafka
from kestrel.sources.files import non_blank_lines, read_json_lines
from kestrel.sources.streams import text_line_stream


def stamped_feed(lines: DataFrame) -> DataFrame:
    """Publishable records only; ``feed_rejects`` has the other lines."""
    return stamp_feed_lines(non_blank_lines(lines)).filter(F.col("value").isNotNull()).select("key", "value")


def feed_rejects(lines: DataFrame) -> DataFrame:
    """Lines that are neither blank nor one JSON object."""
    return stamp_feed_lines(non_blank_lines(lines)).filter(F.col("value").isNull()).select("raw")


def publish_feed_files(spark: SparkSession, path: str, bootstrap_servers: str, topic: str,
                       rejects_path: str | None = None, **kafka_options) -> DataFrame:
    lines = read_json_lines(spark, path)
    records = stamped_feed(lines)
    write_kafka(records, bootstrap_servers, topic, **kafka_options)
    if rejects_path:
        feed_rejects(lines).write.text(rejects_path)
    return records


def publish_feed_stream(spark: SparkSession, path: str, bootstrap_servers: str, topic: str,
                        checkpoint: str, **kafka_options) -> StreamingQuery:
    records = stamped_feed(text_line_stream(spark, path))
    return kafka_stream_writer(records, bootstrap_servers, topic, checkpoint, **kafka_options).start()
