"""Counts per tumbling event-time window (T1-T4, A8), the same plan for tables and streams.

Windows are epoch-aligned, start inclusive, end exclusive. With a watermark delay, a streaming
query in append mode emits a window once, after the watermark has passed its end, and drops rows
of windows already closed. Without a delay (a table) every window is counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from kestrel.functions.keywords import classify, explode_tokens, lexicon_frame

OUTPUT_COLUMNS = ("window_start", "window_end", "keyword", "appearances")


def as_event_time(df: DataFrame, ts_col: str) -> DataFrame:
    """Watermarks need an instant (``timestamp``); a wall-clock ``timestamp_ntz`` is read as UTC
    (the session time zone must be UTC)."""
    dtype = df.schema[ts_col].dataType
    if isinstance(dtype, TimestampType):
        return df
    if isinstance(dtype, TimestampNTZType):
        return df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return df.withColumn(ts_col, F.to_timestamp(F.col(ts_col)))


def count_per_window(df: DataFrame, ts_col: str, key_col: str, width: str = "30 seconds",
                     delay: str | None = None, key_name: str = "keyword",
                     count_name: str = "appearances") -> DataFrame:
    """Rows per (window, key) with NULL keys not counted (A8); ``delay`` sets the watermark."""
    rows = as_event_time(df.select(F.col(ts_col), F.col(key_col).alias(key_name)), ts_col)
    if delay is not None:
        rows = rows.withWatermark(ts_col, delay)
    counts = rows.groupBy(F.window(F.col(ts_col), width).alias("window"), F.col(key_name)) \
        .agg(F.count(F.col(key_name)).alias(count_name))
    return counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                         key_name, count_name)


def keyword_counts(df: DataFrame, ts_col: str = "ts", text_col: str = "text", width: str = "30 seconds",
                   delay: str | None = None, lexicon=None, pos_mode: str = "subclass",
                   hot_surfaces: list[str] | None = None) -> DataFrame:
    """Q5: keyword appearances per (window, keyword) from texts with an event time.

    Tokens are exploded and checked per row, then the lexicon (if any) is joined, then counted.
    The count runs a partial aggregate before the shuffle, so a frequent keyword reaches the
    exchange once per task. ``hot_surfaces`` names the words that a stream salts. Rows with NULL text are skipped (see ``split_rejects``).
    """
    rows = as_event_time(df.filter(F.col(text_col).isNotNull()), ts_col)
    if delay is not None:
        rows = rows.withWatermark(ts_col, delay)
    lex = None if lexicon is None else lexicon_frame(df.sparkSession, lexicon)
    # No AQE in a stream to split a hot word's partition: the tokens of the words named as hot meet the
    # lexicon salted.
    salt = "_token" if lex is not None and df.isStreaming else None
    tokens = explode_tokens(rows, text_col, [ts_col], salt_name=salt)
    if lex is not None and not salt:
        # Count each surface per window first, so the join sees one row per (window, surface) and
        # never a hot word's raw rows.
        per_surface = tokens.groupBy(F.window(F.col(ts_col), width).alias("window"), "surface") \
            .agg(F.count("*").alias("n"))
        counts = classify(per_surface, lex, pos_mode=pos_mode) \
            .groupBy("window", "keyword").agg(F.sum("n").alias("appearances"))
    else:
        keywords = classify(tokens, lex, pos_mode=pos_mode, salt_col=salt, hot=hot_surfaces)
        counts = keywords.groupBy(F.window(F.col(ts_col), width).alias("window"), "keyword") \
            .agg(F.count("keyword").alias("appearances"))
    return counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                         "keyword", "appearances")


def texts_per_window(df: DataFrame, ts_col: str = "ts", text_col: str = "text", width: str = "30 seconds",
                     delay: str | None = None) -> DataFrame:
    """The stateful half of Q5 on a stream: the distinct texts of each window, and ``times``, how often each came.
    State holds a row per text of an open window, where counted keywords would take a row per word of it. Texts are told
    apart by their SHA-256: the key of a row, which is written again when its window closes, does not hold the text."""
    rows = as_event_time(df.filter(F.col(text_col).isNotNull()), ts_col)
    if delay is not None:
        rows = rows.withWatermark(ts_col, delay)
    counts = rows.groupBy(F.window(F.col(ts_col), width).alias("window"), F.unhex(F.sha2(F.col(text_col), 256)).alias("_sha")) \
        .agg(F.first(text_col).alias("text"), F.count(F.lit(1)).alias("times"))
    return counts.select("window", "text", "times")


def count_window_texts(texts: DataFrame, lexicon=None, pos_mode: str = "subclass", hot_surfaces: list[str] | None = None,
                       one_reading: bool = False) -> DataFrame:
    """The other half, on the closed windows of a micro-batch: the rows of ``keyword_counts`` from those of
    ``texts_per_window``. A window is emitted once and as a whole, so its counts are final. A batch of a stream has no
    AQE either: the words named as hot meet the lexicon salted. ``one_reading``: the lexicon is a DataFrame with one entry
    per surface, as ``lexicon_frame`` and ``stored_lexicon`` give it."""
    lex = lexicon if lexicon is None or one_reading else lexicon_frame(texts.sparkSession, lexicon)
    salt = "_token" if lex is not None else None
    tokens = explode_tokens(texts, "text", ["window", "times"], salt_name=salt)
    counts = classify(tokens, lex, pos_mode=pos_mode, salt_col=salt, hot=hot_surfaces) \
        .groupBy("window", "keyword").agg(F.sum("times").alias("appearances"))
    return counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                         "keyword", "appearances")


def as_wall_clock(df: DataFrame, *cols: str) -> DataFrame:
    """Window bounds as ``timestamp_ntz`` (UTC wall clock), the type of the input tables."""
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def with_window_day(counts: DataFrame) -> DataFrame:
    """Adds ``window_day`` (the UTC date of the window start), the partition column of a stored
    window table: the newest window always lies in the newest day."""
    return counts.withColumn("window_day", F.to_date(F.col("window_start")))
