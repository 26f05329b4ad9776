"""Micro-batch sinks for ``foreachBatch`` that store a replayed batch once.

Spark may hand the same ``batch_id`` to the sink again after a failure (the batch ran, the commit
was not recorded). These sinks make that harmless:

* ``FileBatchSink`` writes batch N to its own folders ``batch_id=N`` with dynamic partition
  overwrite, so a replay replaces the earlier attempt, partial or complete. The folders read
  back as one table partitioned by ``batch_id`` (and any time partition columns).
* ``CommittedFileSink`` writes each attempt to a folder of its own and commits it with a small file;
  readers see committed attempts only.
* ``JdbcBatchSink`` writes a batch from all its partitions, marked with the batch id and an attempt
  of its own, and then one row (batch id, attempt) to a commit table. A batch whose id is committed is
  skipped; rows of an attempt that was never committed are left out by ``committed_rows``. The
  commit check is a filtered query pushed to the database, on a table of one row per batch.

A failing read is an error in all: it never counts as "nothing stored".
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.sinks.jdbc import write_jdbc
from kestrel.sources.files import path_exists, write_small_file
from kestrel.sources.jdbc import read_jdbc
from kestrel.streaming.windows import with_window_day


class FileBatchSink:
    """Writes micro-batch N under ``batch_id=N`` (inside optional ``partition_by`` folders, e.g.
    a day of event time) with dynamic partition overwrite: a replayed batch replaces exactly the
    folders its first attempt wrote, and readers can prune on the partition columns.

    The batch is written from the partitions it has; ``max_records_per_file`` bounds a file's size,
    not the number of writing tasks. With short triggers, ``compact`` rewrites old batches as few files.
    """

    def __init__(self, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                 max_records_per_file: int | None = None, **options):
        self.path = path.rstrip("/")
        self.fmt = fmt
        self.partition_by = list(partition_by or [])
        self.options = dict(options)
        if max_records_per_file:
            self.options["maxRecordsPerFile"] = str(max_records_per_file)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        writer = (batch_df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
                  .write.format(self.fmt).mode("overwrite")
                  .option("partitionOverwriteMode", "dynamic")
                  .partitionBy(*self.partition_by, "batch_id"))
        for key, value in self.options.items():
            writer = writer.option(key, value)
        writer.save(self.path)

    def read(self, spark, drop_batch_id: bool = True, schema=None) -> DataFrame:
        """All stored batches as one table; empty (with ``schema``) before the first batch, when
        there is no folder yet. Any other failure to read is raised."""
        if schema is not None and not path_exists(spark, self.path):
            return spark.createDataFrame([], schema)
        df = spark.read.format(self.fmt).load(self.path)
        return df.drop("batch_id") if drop_batch_id else df

    def compact(self, spark, target: str, *order: str) -> None:
        """The stored rows, without batch ids, written to ``target`` as files of a task's size each
        (``order`` names the columns that cluster them)."""
        rows = self.read(spark)
        clustered = rows.repartitionByRange(*order).sortWithinPartitions(*order) if order else rows.coalesce(
            max(1, rows.sparkSession.sparkContext.defaultParallelism))
        clustered.write.format(self.fmt).partitionBy(*self.partition_by).save(target)


class WindowTableSink(FileBatchSink):
    """A window table ``(window_start, window_end, keyword, appearances)`` stored by day of the
    window start, so the reports read only the days they need. A one-day batch is written by all the
    tasks that hold its rows."""

    def __init__(self, path: str, fmt: str = "parquet", max_records_per_file: int | None = None, **options):
        super().__init__(path, fmt, partition_by=["window_day"], max_records_per_file=max_records_per_file, **options)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        super().__call__(with_window_day(batch_df), batch_id)


class CommittedFileSink:
    """Micro-batches as attempts, for file systems without a folder overwrite to rely on: every attempt at
    batch N writes a folder of its own, ``rows/batch_id=N/attempt=...``, and is committed by one small file,
    ``commits/N``, that names it. A committed batch is not written again. ``read`` returns the rows of
    committed attempts only; what a dead attempt left behind, whole or in part, is never seen.

    A commit file counts only with its whole line, so one cut short by a crash commits nothing. A stream has
    one driver, so no two attempts at a batch run at once.
    """

    def __init__(self, path: str, fmt: str = "parquet", **options):
        self.path, self.fmt, self.options = path.rstrip("/"), fmt, options
        self.rows, self.commits = f"{self.path}/rows", f"{self.path}/commits"

    def write_attempt(self, batch_df: DataFrame, batch_id: int) -> str:
        attempt = f"a{uuid.uuid4().hex}"
        batch_df.write.format(self.fmt).options(**self.options).save(f"{self.rows}/batch_id={batch_id}/attempt={attempt}")
        return attempt

    def committed(self, spark) -> DataFrame:
        """(batch_id, attempt) of every commit."""
        if not path_exists(spark, self.commits):
            return spark.createDataFrame([], "batch_id long, attempt string")
        lines = spark.read.text(self.commits).where(F.col("value").rlike("^[0-9]+ a[0-9a-f]{32};$"))
        parts = F.split(F.rtrim("value", F.lit(";")), " ")
        return lines.select(parts[0].cast("long").alias("batch_id"), parts[1].alias("attempt"))

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        if not self.committed(spark).filter(F.col("batch_id") == batch_id).isEmpty():
            return
        attempt = self.write_attempt(batch_df, batch_id)
        write_small_file(spark, f"{self.commits}/{batch_id}", f"{batch_id} {attempt};\n")

    def read(self, spark, schema=None) -> DataFrame:
        """The rows of committed attempts; empty (with ``schema``) before the first one."""
        if schema is not None and not path_exists(spark, self.rows):
            return spark.createDataFrame([], schema)
        rows = spark.read.format(self.fmt).load(self.rows).withColumn("batch_id", F.col("batch_id").cast("long"))
        # the partition columns of the join let Spark skip the folders of other attempts
        return rows.join(self.committed(spark), ["batch_id", "attempt"], "left_semi").drop("batch_id", "attempt")


class JdbcBatchSink:
    """See the module's text. ``num_partitions`` bounds the connections that write at once (None:
    one for each partition of the batch); ``table`` gets the columns ``batch_id`` and ``attempt``."""

    def __init__(self, url: str, table: str, properties: dict | None = None,
                 id_column: str = "batch_id", batchsize: int = 4096,
                 isolation_level: str = "READ_COMMITTED", num_partitions: int | None = None,
                 commit_table: str | None = None):
        self.url, self.table, self.properties = url, table, dict(properties or {})
        self.id_column, self.batchsize, self.isolation_level = id_column, batchsize, isolation_level
        self.num_partitions = num_partitions
        self.commit_table = commit_table or f"{table}_COMMITS"

    def _commits(self, spark, rows: list) -> DataFrame:
        return spark.createDataFrame(rows, f"{self.id_column} bigint, attempt string")

    def _append(self, df: DataFrame, table: str, num_partitions: int | None) -> None:
        write_jdbc(df, self.url, table, self.properties, mode="append", batchsize=self.batchsize,
                   isolation_level=self.isolation_level, num_partitions=num_partitions)

    def already_stored(self, spark, batch_id: int) -> bool:
        # Appending no rows creates the commit table if it is missing and changes nothing otherwise,
        # so a read that fails afterwards is a real failure.
        self._append(self._commits(spark, []), self.commit_table, 1)
        commits = read_jdbc(spark, self.url, self.commit_table, self.properties)
        return not commits.filter(F.col(self.id_column) == batch_id).isEmpty()

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        if self.already_stored(spark, batch_id):
            return
        attempt = uuid.uuid4().hex
        rows = batch_df.withColumn(self.id_column, F.lit(batch_id).cast("bigint")).withColumn("attempt", F.lit(attempt))
        self._append(rows, self.table, self.num_partitions)
        self._append(self._commits(spark, [(batch_id, attempt)]), self.commit_table, 1)

    def committed_rows(self, spark) -> DataFrame:
        """The stored rows of committed attempts (the first one of each batch)."""
        first = read_jdbc(spark, self.url, self.commit_table, self.properties).groupBy(self.id_column).agg(
            F.min("attempt").alias("attempt"))
        rows = read_jdbc(spark, self.url, self.table, self.properties)
        return rows.join(first, [self.id_column, "attempt"], "left_semi").drop("attempt")
