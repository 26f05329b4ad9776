"""Keyed message sink (K6).

Kafka needs the ``spark-sql-kafka`` package on the classpath; the DataFrame handed over has the
Kafka shape (``key``, ``value`` strings), so everything up to the write is testable without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def sasl_plain_options(username: str, password: str, mechanism: str = "PLAIN") -> dict:
    """Connection options for a SASL_SSL broker with user and password."""
    quoted = [value.replace("\\", "\\\\").replace('"', '\\"') for value in (username, password)]
    jaas = ('org.apache.kafka.common.security.plain.PlainLoginModule required '
            f'username="{quoted[0]}" password="{quoted[1]}";')
    return {"kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": mechanism,
            "kafka.sasl.jaas.config": jaas}


def write_kafka(records: DataFrame, bootstrap_servers: str, topic: str, **kafka_options) -> None:
    """Batch write of ``(key, value)`` records to one topic."""
    writer = (records.select("key", "value").write.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("topic", topic))
    for key, value in kafka_options.items():
        writer = writer.option(key, value)
    writer.save()


def kafka_stream_writer(records: DataFrame, bootstrap_servers: str, topic: str,
                        checkpoint: str, **kafka_options) -> DataStreamWriter:
    """Streaming write of ``(key, value)`` records; the caller starts it."""
    writer = (records.select("key", "value").writeStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("topic", topic)
              .option("checkpointLocation", checkpoint))
    for key, value in kafka_options.items():
        writer = writer.option(key, value)
    return writer
