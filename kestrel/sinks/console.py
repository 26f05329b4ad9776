"""Console sink for streams (K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def console_stream_writer(df: DataFrame, checkpoint: str, num_rows: int = 128,
                          truncate: bool = False, query_name: str | None = None) -> DataStreamWriter:
    """Print each micro-batch, untruncated, at most ``num_rows`` rows."""
    writer = (df.writeStream.format("console").outputMode("append")
              .option("truncate", str(truncate).lower())
              .option("numRows", str(num_rows))
              .option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    return writer
