"""Reports over the windowed keyword table ``(window_start, window_end, keyword, appearances)``
(Q7-Q10). Times are shown on a clock ``shift_hours`` ahead of UTC (9 for Japan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.formatting import iso_text, shift_hours
from kestrel.operators.aggregates import rows_at_max, span, top_k
from kestrel.operators.expand import repeat_by_weight, weight_chunks
from kestrel.sources.files import partition_values, read_partitions

LOCAL_CLOCK_HOURS = 9


class KeywordTable:
    """A stored keyword table partitioned by ``window_day`` (the day of the window start). The days come from
    one listing of its folders, so a report lists and reads the files of the days that it needs only."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.days = partition_values(spark, path, "window_day")

    def all(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def newest_day(self) -> DataFrame:
        """The rows of the newest day, which hold the newest window."""
        return self._of(self.days[-1:])

    def edge_days(self) -> DataFrame:
        """The rows of the first and the last day, which hold the first start and the last end."""
        return self._of(sorted({*self.days[:1], *self.days[-1:]}))

    def _of(self, days: list[str]) -> DataFrame:
        return read_partitions(self.spark, self.path, "window_day", days) if days else self.all()


def newest_window_rows(counts: DataFrame) -> DataFrame:
    """Rows of the newest window (of a stored table, pass its newest day)."""
    return rows_at_max(counts, "window_end")


def latest_window_ranking(counts: DataFrame, shift: int = LOCAL_CLOCK_HOURS) -> DataFrame:
    """Q7: keywords of the newest window by appearances (ties by keyword), end on the local clock."""
    newest = newest_window_rows(counts)
    return (newest.select(shift_hours(F.col("window_end"), shift).alias("window_end_local"),
                          "keyword", "appearances")
            .orderBy(F.col("appearances").desc(), F.col("keyword")))


def latest_window_bag(counts: DataFrame, shift: int = LOCAL_CLOCK_HOURS) -> DataFrame:
    """Q8: each keyword of the newest window repeated ``appearances`` times, one row each: the
    input of a word cloud, kept distributed."""
    newest = newest_window_rows(counts)
    weighted = newest.select(shift_hours(F.col("window_end"), shift).alias("window_end_local"),
                             "keyword", "appearances")
    return repeat_by_weight(weighted, "appearances")


def bag_text_pieces(counts: DataFrame, shift: int = LOCAL_CLOCK_HOURS) -> DataFrame:
    """The newest window's word bag as space-joined text pieces (C13), each a bounded number of
    repetitions of one keyword. Joining all pieces with spaces gives the word-cloud text; no single
    row or task holds all of it, however hot a keyword is."""
    newest = newest_window_rows(counts)
    weighted = newest.select(shift_hours(F.col("window_end"), shift).alias("window_end_local"),
                             "keyword", "appearances")
    return weight_chunks(weighted, "appearances").select(
        "window_end_local", "keyword",
        F.array_join(F.array_repeat(F.col("keyword"), F.col("chunk").cast("int")), " ").alias("piece"))


def alltime_span(counts: DataFrame, shift: int = LOCAL_CLOCK_HOURS) -> DataFrame:
    """Q9: first window start and last window end on the local clock, with a caption line."""
    s = span(counts, "window_start", "window_end", "first_start", "last_end")
    first = shift_hours(F.col("first_start"), shift)
    last = shift_hours(F.col("last_end"), shift)
    return s.select(first.alias("first_start_local"), last.alias("last_end_local"),
                    F.concat(F.lit("From "), iso_text(first), F.lit(" To "), iso_text(last)).alias("caption"))


def alltime_top(counts: DataFrame, k: int = 100) -> DataFrame:
    """Q10: the k keywords with the most appearances over all windows."""
    return top_k(counts, "keyword", "appearances", k, "total")
