"""Tables written between steps, and connected components by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import shared_path

#: tables of at most so many rows of two keys (16 bytes each) are broadcast; larger ones are joined by shuffle
BROADCAST_ROWS = 500_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, which has that number of rows, to be broadcast if they are few."""
    return F.broadcast(df) if rows <= most else df


def components(sides: DataFrame, most: int) -> DataFrame:
    """(key, label): the least key of the connected component of each vertex of the edges (a, b), which are
    written, each in both directions; there are ``most`` vertices at the utmost. Rounds of minimum labels of
    neighbours, and of the labels' labels, until no edge has two labels."""
    labels = stored(sides.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("key"), F.least("a", "b").alias("label")), "labels")

    def named(key: str, label: str) -> DataFrame:
        return sized(labels.select(F.col("key").alias(key), F.col("label").alias(label)), most)  # a row per vertex at most

    while True:
        ends = sides.where("a < b").join(named("a", "x"), "a").join(named("b", "y"), "b")
        if ends.where("x <> y").isEmpty():
            return labels
        near = sides.join(named("b", "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = near.join(named("a", "old"), "a").select(F.col("a").alias("key"), F.least("old", "near").alias("x"))
        labels = stored(lower.join(named("x", "y"), "x").join(named("y", "label"), "y").select("key", "label"), "labels")
