"""File sinks (K1, K2) and result preview (K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame

DEFAULT_FORMAT = "json"


def write_files(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, mode: str = "overwrite",
                partition_by: list[str] | None = None, **options) -> None:
    """Write in any format Spark knows by name (json, csv, parquet, orc, text...).

    The row order of a sorted DataFrame is kept within and across the part files.
    """
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save(path)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows, as a DataFrame; the caller decides whether to show them."""
    return df.limit(n)
