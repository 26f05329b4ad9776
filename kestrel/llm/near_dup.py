"""Near-duplicate documents: consistent weighted samples of TF-IDF shingles, banded, and verified by
weighted Jaccard similarity.

Nodes are different texts, by a 128-bit hash; exact copies share a node from the start, so a group
of copies costs one node. Each node's samples give ``BANDS`` band keys of ``ROWS`` samples; nodes with a
common band key are candidates, and the nodes of a key are a group, joined inside tasks as ``group_join``
says: by the first bands, then by all, then between the blocks of large groups. In a task the samples of
each two members that are not yet in one class are compared; a pair that the samples put clearly under
the threshold is dropped, the others are verified by the weighted Jaccard similarity of the whole texts,
for one member against all others at a time. No bucket is cut short, and pairs do not leave the task.

All joins between tables are by hash keys; a side is broadcast only when its counted rows are few. Tables
that later steps read again are written to the folder of ``spark.checkpoint.dir``, so a lost executor costs
only its running tasks.

Defined cases: null and empty texts count as equal texts; a text without words is a near copy of
equal texts only; rows that repeat are members of one class; a null doc_id takes part, and a class
without any other id has a null class_id; ties go to the smaller key; an empty table gives an empty
result.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.arrow_text import map_texts, named, pieces, text_column, worker_memo
from kestrel.llm.graph import sized, stored
from kestrel.llm.group_join import GroupJoin, shared_members
from kestrel.llm.shingles import Sampler, Weights, common_shingles, text_shingles

THRESHOLD = 0.8
BANDS, ROWS = 14, 4
#: pairs whose share of equal samples is this far below the threshold are not verified (its standard
#: error is 0.053 for a similarity of 0.8)
MARGIN = 0.28
#: bands of the first round of joins
FIRST_BANDS = 2
#: a matrix of weights has so many bytes
MATRIX_BYTES = 32 << 20


def text_key(text: Column) -> Column:
    """A 128-bit name of a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def nonempty(shingles: list, weights: Weights):
    """(numbers of the texts with shingles, their shingles and weights one after another, starts)."""
    some = [i for i, (found, _) in enumerate(shingles) if len(found)]
    if not some:
        return some, None, None, None
    found = np.concatenate([shingles[i][0] for i in some])
    weight = np.concatenate([weights.of(*shingles[i]) for i in some])
    starts = np.cumsum([0] + [len(shingles[i][0]) for i in some[:-1]])
    return some, found, weight, starts


class Matcher:
    """Near-duplicate search over one table of rows with a text and its ``text_key``, ``key``."""

    def __init__(self, rows: DataFrame, text_col: str):
        self.rows, self.text_col = rows, text_col
        self.spark: SparkSession = rows.sparkSession
        # frequencies are those among different texts, so copies of one text do not make it common
        different = stored(rows.select("key", named(text_col).alias("text")).dropDuplicates(["key"]).select("text"), "different")
        self.common = common_shingles(different, "text")
        self.total = different.count()
        self.shared = self.spark.sparkContext.broadcast((self.common, self.total))
        self.memo = f"shingles-{uuid.uuid4()}"

    def signed(self, keep: list[str]) -> DataFrame:
        """The columns of ``keep`` and ``signature``: the samples as bytes, null without words."""
        shared, memo = self.shared, self.memo

        def make(texts: pa.Array):
            weights, sampler = worker_memo(memo, lambda: (Weights(*shared.value), Sampler(BANDS * ROWS)))
            some, found, weight, starts = nonempty(text_shingles(texts), weights)
            out: list[bytes | None] = [None] * len(texts)
            if some:
                for i, sample in zip(some, sampler.samples(found, weight, starts)):
                    out[i] = sample.tobytes()
            return [out]

        return map_texts(self.rows, self.text_col, keep, make, "signature binary")

    def classes(self, nodes: DataFrame) -> DataFrame:
        """(key, label) of every node that shares a band with another one; ``nodes`` has key and signature."""
        width = 4 * ROWS
        bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                            lambda b: F.xxhash64(b, F.substring(F.col("signature"), 1 + b * width, F.lit(width))))
        nodes = stored(nodes.where("signature is not null"), "nodes")
        buckets = nodes.select("key", F.posexplode(bands).alias("band", "token"))
        members = shared_members(buckets)
        keys = stored(members.select("key").distinct(), "keys")
        n_keys = keys.count()
        if not n_keys:
            return keys.select("key", F.col("key").alias("label"))
        few = sized(keys, n_keys)
        texts = self.rows.select("key", named(self.text_col).alias("text")).join(few, "key", "left_semi").dropDuplicates(["key"])
        texts = stored(texts.join(nodes.join(few, "key", "left_semi"), "key"), "texts")
        shared, memo = self.shared, self.memo

        def connect(rows: pa.RecordBatch, before: np.ndarray) -> np.ndarray:
            weights, _ = worker_memo(memo, lambda: (Weights(*shared.value), Sampler(BANDS * ROWS)))
            column = text_column(rows, "text")
            shingles = [s for a, b in pieces(column) for s in text_shingles(column.slice(a, b - a))]
            samples = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint32).reshape(len(before), BANDS * ROWS)
            return join_group([(found, weights.of(found, n)) for found, n in shingles], samples, before)

        rounds = [members.where(F.col("band") < FIRST_BANDS), members.where(F.col("band") >= FIRST_BANDS)]
        return GroupJoin(rounds, keys, n_keys, texts, connect).labels()


def join_group(sets: list[tuple[np.ndarray, np.ndarray]], samples: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """New labels of a group's texts (shingles and weights, none empty): those equal in ``labels``, or that
    verified pairs connect, are equal."""
    labels, n = labels.copy(), len(sets)
    found, inverse, holders = np.unique(np.concatenate([s[0] for s in sets]), return_inverse=True, return_counts=True)
    bounds = np.concatenate([[0], np.cumsum([len(s[0]) for s in sets])])
    several = holders > 1  # the others add nothing to any smaller weight
    dense = np.cumsum(several) - 1
    rows, weights = [], []
    for (_, weight), a, b in zip(sets, bounds[:-1].tolist(), bounds[1:].tolist()):
        at = inverse[a:b]
        rows.append(dense[at[several[at]]])
        weights.append(weight[several[at]])
    total = np.array([s[1].sum() for s in sets])
    least_alike = (THRESHOLD - MARGIN) * samples.shape[1]
    width = max(1, MATRIX_BYTES // (8 * max(1, int(several.sum()))))
    for first in range(0, n, width):
        last = min(first + width, n)
        held = np.zeros((int(several.sum()), last - first))
        for x in range(first, last):
            held[rows[x], x - first] = weights[x]
        for y in range(first + 1, n):
            upto = min(y, last)
            near = np.flatnonzero(labels[first:upto] != labels[y])
            near = near[(samples[first + near] == samples[y]).sum(1) >= least_alike]
            if not len(near):
                continue
            least = np.minimum(held[rows[y]][:, near], weights[y][:, None]).sum(0)
            good = near[least / (total[first + near] + total[y] - least) >= THRESHOLD]
            if len(good):
                same = np.unique(np.append(labels[first + good], labels[y]))
                labels[np.isin(labels, same)] = same[0]
    return labels


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id column, class_id (the least id of its class), class_size (rows of the class)
    and copies (rows with an equal text)."""
    plain = docs.select(named(id_col).alias("id"), named(text_col).cast("string").alias("text"))
    return classified(plain).select(F.col("id").alias(id_col), F.col("class_id"), "class_size", "copies")


def classified(plain: DataFrame, extra: list[str] = []) -> DataFrame:  # noqa: B006
    """For rows with id, text and the columns of ``extra``: id, extra, class_id, class_size, copies, label."""
    matcher = Matcher(plain.withColumn("key", text_key(F.col("text"))), "text")
    rows = stored(matcher.signed(["id", *extra, "key"]), "signed")
    nodes = rows.select("key", "signature").dropDuplicates(["key"])
    labels = stored(matcher.classes(nodes), "classes")
    each = rows.groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    each = each.join(sized(labels, labels.count()), "key", "left").withColumn("label", F.coalesce("label", "key"))
    each = stored(each, "nodes")
    several = each.groupBy("label").agg(F.count(F.lit(1)).alias("texts"), F.min("least").alias("class_id"), F.sum("copies").alias("class_size"))
    several = stored(several.where("texts > 1").drop("texts"), "several")
    each = each.join(sized(several, several.count()), "label", "left").select(
        "key", "label", F.when(F.col("class_size").isNull(), F.col("least")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", "copies").alias("class_size"), "copies")
    return rows.drop("signature").join(each, "key").select("id", *extra, "class_id", "class_size", "copies", "label")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, unchanged: that with the least id (a null id comes last), then the least
    hash of the row. Of rows that are equal in every column one stays."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text, key = names[docs.columns.index(text_col)], names[docs.columns.index(id_col)]
    hashed = [n for n in names if not isinstance(plain.schema[n].dataType, (T.MapType, T.VariantType))]
    row = F.xxhash64(*hashed)
    found = stored(classified(plain.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"), row.alias("row")),
                              ["row"]), "classes")
    best = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row")).alias("best")
    first = found.groupBy("label").agg(best).select("label", "best.id", "best.row")
    chosen = found.select("label", "id", "row").join(first.withColumnsRenamed({"id": "first_id", "row": "first_row"}), "label")
    stays = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("row") == F.col("first_row"))
    gone = stored(chosen.where(~stays).select("id", "row").distinct(), "gone")
    twice = stored(chosen.where(stays).groupBy("id", "row").count().where("count > 1").select("id", "row"), "twice")

    small = lambda keys: sized(keys, keys.count())
    marked = plain.withColumn("row", row)
    on = lambda keys: (marked[key].eqNullSafe(keys["id"])) & (marked["row"] == keys["row"])
    left = marked.join(small(gone), on(gone), "left_anti")
    if twice.isEmpty():
        return left.select(*names).toDF(*docs.columns)
    on = lambda keys: (left[key].eqNullSafe(keys["id"])) & (left["row"] == keys["row"])
    once = left.join(small(twice), on(twice), "left_anti").select(*names)
    rest = left.join(small(twice), on(twice), "left_semi").dropDuplicates([key, "row"]).select(*names)
    return once.unionAll(rest).toDF(*docs.columns)
