"""File sources: CSV with header (S1), a directory of named tables (S2), JSON-line feeds.

Paths are passed straight to Spark, so any Hadoop file-system URI works (S3): ``s3a://``,
``abfss://``, ``gs://``, ``oci://``... Credentials belong in ``spark.hadoop.*`` settings.
"""

from __future__ import annotations

import hashlib
import re
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _file_status(spark: SparkSession, path: str):
    """Hadoop's view of a path: (file system, path), for any URI Spark can read."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_status(spark, path)
    return fs.exists(hadoop_path)


def is_directory(spark: SparkSession, path: str) -> bool:
    """Whether the path is a directory; a missing path is an error."""
    fs, hadoop_path = _file_status(spark, path)
    return fs.getFileStatus(hadoop_path).isDirectory()


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a partition column, as text and in order, from the names of a stored table's folders:
    one listing of one level, of as many entries as there are values. No file is listed or read."""
    fs, hadoop_path = _file_status(spark, path)
    folder = re.compile(rf"{re.escape(column)}=(.+)")
    names = (status.getPath().getName() for status in fs.listStatus(hadoop_path) if status.isDirectory())
    return sorted(m[1] for name in names if (m := folder.fullmatch(name)) and m[1] != "__HIVE_DEFAULT_PARTITION__")


def read_partitions(spark: SparkSession, path: str, column: str, values: list[str], fmt: str = "parquet") -> DataFrame:
    """The rows of some values of a partition column: only their folders are listed and read."""
    base = path.rstrip("/")
    return spark.read.format(fmt).option("basePath", base).load([f"{base}/{column}={v}" for v in values])


def write_small_file(spark: SparkSession, path: str, text: str) -> None:
    """A text as one file, written whole through Hadoop's file system (a marker, not data)."""
    fs, hadoop_path = _file_status(spark, path)
    out = fs.create(hadoop_path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def input_version(spark: SparkSession, path: str) -> str:
    """A name for what a file or folder holds now: from the names, sizes and times of its files."""
    fs, hadoop_path = _file_status(spark, path)
    files, digest = fs.listFiles(hadoop_path, True), 0
    while files.hasNext():
        f = files.next()
        text = f"{f.getPath()} {f.getLen()} {f.getModificationTime()}"
        digest ^= int.from_bytes(hashlib.sha256(text.encode()).digest(), "big")
    return f"{digest:064x}"


def files_in_name_order(spark: SparkSession, path: str) -> int:
    """Give the files of a folder times that rise in the order of their names, a second apart, so that a
    file stream takes them in that order; returns how many there are. For folders written by one sorted
    job, whose files are named in order (a file system that keeps no times is an error)."""
    fs, hadoop_path = _file_status(spark, path)
    files = sorted((f.getPath() for f in fs.listStatus(hadoop_path) if f.getPath().getName().startswith("part-")), key=lambda f: f.getName())
    last = int(time.time() * 1000)
    for place, f in enumerate(files):
        fs.setTimes(f, last - 1000 * (len(files) - place), -1)
    return len(files)


def ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(position, line): the lines of the text files of a folder, or of one file, numbered from 0 through
    the files in the order of their names. Every split counts its lines, and only those counts are put
    in order, so the lines stay distributed."""
    # the number is given before anything else touches the rows; within a split it rises by one a line
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("number"))
    splits = lines.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("number").alias("first"))
    before = F.sum("n").over(Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1))  # a row per split
    splits = splits.withColumn("before", F.coalesce(before, F.lit(0))).drop("n")
    return lines.join(splits, ["file", "start"]).select((F.col("before") + F.col("number") - F.col("first")).alias("position"), "line")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, **options) -> DataFrame:
    """CSV scan with a header row.

    With an explicit ``schema`` the file is read once. Without one, types are inferred, which
    costs an extra pass over the input; ``samplingRatio`` in ``options`` bounds that pass on
    large inputs.
    """
    reader = spark.read.format("csv").option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def table_path(base_dir: str, name: str, fmt: str = "parquet") -> str:
    """A dataset directory holds each relation under a fixed file name: ``<dir>/<name>.<fmt>``."""
    return f"{base_dir.rstrip('/')}/{name}.{fmt}"


def read_table(spark: SparkSession, base_dir: str, name: str, fmt: str = "parquet",
               schema: StructType | str | None = None, **options) -> DataFrame:
    """One named relation of a dataset directory, in any format Spark reads."""
    path = table_path(base_dir, name, fmt)
    if fmt == "csv":
        return read_csv(spark, path, schema=schema, **options)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def non_blank_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Keep-alive lines of a feed are empty or whitespace; drop them."""
    return lines.filter(F.col(column).rlike(r"\S"))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """A JSON-line feed as raw text lines without the blank ones; decoding is a separate step."""
    return non_blank_lines(spark.read.text(path))
