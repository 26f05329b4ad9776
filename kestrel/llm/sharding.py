"""Sharding by balanced label propagation under row quotas.

Documents with equal texts are linked. Every linked document starts in a shard of its own hash; in
each round the documents of a group move towards the shard that holds most of their links, as far as
that shard's quota has room. A round works on cells, the number of rows of a group in a shard, so it
handles at most one row per group and shard, and a group of a third of all rows is 24 of them. Moves
into a shard that is asked for more than its room are accepted in part. Documents without links
come last and fill every shard to its quota, so that counts are at most one apart (the law ``rows``).

Places within a shard come from counts per (shard, salt) and row numbers within these, so no task
gets a whole shard or a whole group.

Defined cases: a null text counts as empty; null and empty texts are linked; rows that repeat are
linked rows; a null id is placed like any other; fewer rows than shards leave some shards empty; ties go
to the smaller shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import named
from kestrel.session import shared_path

SHARDS = 24
ROUNDS = 16
#: rounds end when they move less than this share of the linked rows
STILL = 0.001
#: a move is large if it is more than the room's share of one in so many
LARGE = 50
#: a shard with less than this share of its quota left counts as full
FULL = 0.02


def stored(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chance(*columns) -> Column:
    """A number in [0, 1) from a hash of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / (1 << 30)


def numbered(rows: DataFrame, group: str, salts: int) -> DataFrame:
    """``rows`` (with a unique column ``row``) and ``place``: 0, 1, ... within each group."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    counts = salted.groupBy(group, "salt").count()
    before = Window.partitionBy(group).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy(group, "salt").orderBy("row")) - 1
    return salted.join(starts, [group, "salt"]).withColumn("place", F.col("start") + within).drop("salt", "start")


def by_shard(values: list[int], shard: Column | str) -> Column:
    """The value of a shard, from a list with one value per shard."""
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), (F.col(shard) if isinstance(shard, str) else shard).cast("int") + 1)


def propagate(cells: DataFrame, quotas: list[int]) -> DataFrame:
    """(key, shard, n) after the rounds."""
    shards = len(quotas)
    total = cells.agg(F.sum("n")).first()[0] or 0
    for turn in range(ROUNDS):
        load = [0] * shards
        for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect():
            load[r["shard"]] = r["n"]
        room = [q - n if q - n >= FULL * q else 0 for q, n in zip(quotas, load)]
        open_cells = cells.withColumn("room", by_shard(room, "shard"))
        # the shard with most of a group's rows, among those with room; a full one keeps what it has
        best = F.max(F.when(F.col("room") > 0, F.struct("n", (-F.col("shard")).alias("minus")))).alias("best")
        wish = open_cells.groupBy("key").agg(best).where("best is not null").select("key", (-F.col("best.minus")).alias("target"), F.col("best.n").alias("most"))
        moves = open_cells.join(wish, "key").where((F.col("shard") != F.col("target")) & ((F.col("room") > 0) | (F.col("n") < F.col("most"))))
        roomy = by_shard(room, "target")
        moves = stored(moves.select("key", "shard", "target", "n", (F.col("n") * LARGE > roomy).alias("large")), "moves")
        asked = {(r["target"], r["large"]): r["n"] for r in moves.groupBy("target", "large").agg(F.sum("n").alias("n")).collect()}
        if not asked:
            break
        # small moves are taken as a whole or not at all, by chance, in proportion to the room; large
        # ones (a bounded number for a shard) the smallest first, so that stray rows come home
        small, large = [0.0] * shards, [0] * shards
        for t in range(shards):
            few, many = asked.get((t, False), 0), asked.get((t, True), 0)
            large[t] = min(many, int(room[t] * many / max(1, many + few, room[t])) if few + many > room[t] else many)
            small[t] = min(1.0, 0.98 * (room[t] - large[t]) / few) if few else 0.0
        part = F.element_at(F.array(*[F.lit(float(x)) for x in small]), F.col("target") + 1)
        whole = F.when(chance("key", "shard", F.lit(turn)) < part, F.col("n")).otherwise(0)
        before = Window.partitionBy("target").orderBy("n", "key", "shard").rowsBetween(Window.unboundedPreceding, -1)
        left = by_shard(large, "target") - F.coalesce(F.sum("n").over(before), F.lit(0))
        big = moves.where("large").withColumn("taken", F.greatest(F.lit(0), F.least("n", left)).cast("long"))
        moves = big.unionAll(moves.where("not large").withColumn("taken", whole.cast("long")))
        moves = stored(moves.where("taken > 0"), "taken")
        moved = moves.agg(F.sum("taken")).first()[0] or 0
        change = cells.unionAll(moves.select("key", "shard", (-F.col("taken")).alias("n")))
        change = change.unionAll(moves.select("key", F.col("target").alias("shard"), F.col("taken").alias("n")))
        cells = stored(change.groupBy("key", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "cells")
        if moved < STILL * total:
            break
    return cells


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id column, size (UTF-8 bytes + 8), text_crc32, shard and slot."""
    spark = docs.sparkSession
    salts = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    data = F.coalesce(named(text_col).cast("string"), F.lit("")).cast("binary")
    rows = stored(docs.select(
        named(id_col).alias("id"), (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("crc"),
        F.unhex(F.md5(data)).alias("key"), F.monotonically_increasing_id().alias("row")), "items")
    total = rows.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    linked = rows.groupBy("key").count().where("count > 1")
    linked = stored(rows.select("row", "key").join(linked.select("key"), "key"), "linked")
    begin = F.pmod(F.xxhash64("row", F.lit("shard")), F.lit(shards)).cast("int")
    cells = stored(linked.groupBy("key", begin.alias("shard")).agg(F.count(F.lit(1)).alias("n")), "cells")
    cells = propagate(cells, quotas)

    # the rows of a group, numbered, fill its cells in the order of shards
    order = Window.partitionBy("key").orderBy("shard")
    ends = cells.select("key", "shard", F.sum("n").over(order).alias("end"))
    ends = ends.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("end", "shard"))).alias("cells"))  # one per shard at most
    placed = numbered(linked, "key", salts).join(ends, "key")
    cell = F.element_at(F.filter("cells", lambda c: c["end"] > F.col("place")), 1)
    placed = placed.select("row", cell["shard"].alias("shard"))

    # all rows, numbered within their shard; those without links, and those beyond a quota, are the pool
    everyone = stored(rows.drop("key").join(placed, "row", "left").withColumn("shard", F.coalesce("shard", F.lit(shards))), "shards")
    load = [0] * (shards + 1)
    for r in everyone.groupBy("shard").count().collect():
        load[r["shard"]] = r["count"]
    kept = [min(n, q) for n, q in zip(load, quotas)]
    beyond = [n - k for n, k in zip(load, kept)]
    released = [load[shards] + sum(beyond[:s]) for s in range(shards)] + [0]  # number in the pool of a shard's first row beyond its quota
    want = [q - k for q, k in zip(quotas, kept)]
    fills = [sum(want[:s]) for s in range(shards)]
    all_rows = numbered(everyone, "shard", salts)
    stays = F.col("place") < by_shard([*kept, 0], "shard")
    pool = by_shard(released, "shard") + F.col("place") - by_shard([*kept, 0], "shard")
    all_rows = all_rows.withColumn("pool", F.when(~stays, pool))
    filled = (F.size(F.filter(F.array(*[F.lit(int(f)).cast("long") for f in fills]), lambda f: f <= F.col("pool"))) - 1).cast("int")
    all_rows = all_rows.withColumn("final", F.when(stays, F.col("shard")).otherwise(filled).cast("int"))
    slot = F.when(stays, F.col("place")).otherwise(by_shard(kept, "final") + F.col("pool") - by_shard(fills, "final"))
    return all_rows.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.col("final").alias("shard"),
                           slot.cast("long").alias("slot"))
