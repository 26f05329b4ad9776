"""Unbounded sources.

The message source is a parameter: Kafka on a cluster, or a file stream that stands in for it
(tests, replays). Both end in the same shape, a ``value`` column, so every transform after the
source is shared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from kestrel.sources.files import is_directory, table_path


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str,
                 starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                 max_offsets_per_trigger: int | None = None, **kafka_options) -> DataFrame:
    """Subscribe to one topic (T10: start at latest, tolerate lost offsets by default).

    Needs the ``spark-sql-kafka`` package on the classpath. Kafka partitions map to Spark
    partitions; ``minPartitions`` in ``kafka_options`` splits large topic partitions further.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for key, value in kafka_options.items():
        reader = reader.option(key, value)
    return reader.load()


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None,
                **options) -> DataFrame:
    """A file-source stream. A streaming file source needs the schema up front."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def table_stream(spark: SparkSession, base_dir: str, name: str, schema: StructType, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A named table of a dataset directory as a stream: the part files of a directory table, or
    the one file of a single-file table."""
    path = table_path(base_dir, name, fmt)
    if is_directory(spark, path):
        return file_stream(spark, path, schema, fmt, max_files_per_trigger=max_files_per_trigger)
    return file_stream(spark, base_dir, schema, fmt, glob=f"{name}.{fmt}", max_files_per_trigger=max_files_per_trigger)


def text_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-line files as a stream of text lines in ``value``: the stand-in for a message topic."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def payload_text(messages: DataFrame, column: str = "value") -> DataFrame:
    """Message payload as text (S5, C2, P5): binary Kafka values are UTF-8 decoded, text passes."""
    return messages.selectExpr(f"CAST(`{column}` AS STRING) AS value")
