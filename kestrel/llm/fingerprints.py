"""Document fingerprints by locally consistent parsing.

A text's bytes are parsed into phrases, phrases into longer phrases, and so on. At each level, runs of
one symbol are joined, then deterministic coin tossing replaces each symbol by the place and value
of the lowest bit in which it differs from its left neighbour; a few rounds leave six labels,
neighbours still different, and a phrase begins at each local maximum. A phrase's name is a hash of
its symbols. Where a phrase begins depends on a few symbols around it only, so equal substrings get
equal names, wherever they stand, but for the phrases at their rims.

The fingerprint is a name of the whole text and a sketch of its phrases from level ``LEVEL`` on (about
30 bytes long, and longer ones): ``BINS`` bins by hash, each with 8 bits of the least name in
it. The share of agreeing bins estimates the share of common phrases.

Neighbours in the order of ids meet in a range-partitioned sort, which moves each text once. The last
row of a partition and the first one of the next go through a second, small step.

Defined cases: a null text counts as empty; empty texts have no phrases and are alike; equal texts
have equal fingerprints; rows are ordered by id (null first), then by text; a single row is its own
next row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.arrow_text import PIECE_BYTES, byte_view, named, ship_package, text_column
from kestrel.llm.byte_words import mix, window_hashes
from kestrel.llm.byte_words import _BASE, _INVERSE, _powers
from kestrel.session import shared_path

LEVEL = 3
BINS = 64
EMPTY = 0x100


def toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing: twice the lowest place where a symbol differs from its left
    neighbour, plus its bit there; a text's first symbol counts as different in place 0."""
    left = np.empty_like(x)
    left[1:] = x[:-1]
    left[first] = ~x[first]
    differ = x ^ left
    lowest = differ & (~differ + x.dtype.type(1))
    place = np.bitwise_count(lowest - x.dtype.type(1))
    bit = (x & lowest) != 0
    return (place << 1) | bit


def phrase_starts(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the phrases of symbols begin; ``first`` are the texts' first symbols. No symbol equals
    its left neighbour in the same text."""
    labels = toss(x, first)
    for _ in range(2 if x.dtype == np.uint8 else 3):  # 256 or 2**64 symbols: down to six labels
        labels = toss(labels, first)
    start = np.zeros(len(x), bool)
    start[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    start[first[first > 0] - 1] = False  # a text's last symbol has no right neighbour
    start[first] = True
    return np.flatnonzero(start)


def parse(x: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(names of the phrases, offsets of the texts in them) of one level."""
    if not len(x):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    new = np.empty(len(x), bool)
    new[0], new[1:] = True, x[1:] != x[:-1]
    new[first] = True
    at = np.flatnonzero(new)
    # a run of one symbol counts as one: its length is in the phrase's name, not in where it begins
    starts = at[phrase_starts(x[at], np.searchsorted(at, first))]
    n = len(x)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=total[1:])
    ends = np.append(starts[1:], n)
    names = mix((total[ends] - total[starts]) * _powers(_INVERSE, n)[starts] + np.uint64(0xD6E8FEB86659FD93))
    return names, np.searchsorted(starts, offsets)


def fingerprints(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(names of the whole texts, sketches: texts x BINS, EMPTY where a bin has no phrase)."""
    n = len(texts)
    flat = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    x, level, least = flat, 0, np.full(n * BINS, np.iinfo(np.uint64).max)
    roots = np.zeros(n, np.uint64)
    while len(x):
        x, offsets = parse(x, offsets)
        level += 1
        lengths = np.diff(offsets)
        if level >= LEVEL:
            doc = np.repeat(np.arange(n), lengths)
            named_level = mix(x + np.uint64(level))
            np.minimum.at(least, doc * BINS + (named_level >> np.uint64(58)).astype(np.int64), named_level & np.uint64((1 << 58) - 1))
            done = lengths == 1  # a text of one phrase is finished: this is its name
            roots[done] = x[offsets[:-1][done]]
            if done.any():
                keep = np.repeat(~done, lengths)
                x, offsets = x[keep], np.concatenate([[0], np.cumsum(np.where(done, 0, lengths))])
    sketch = np.where(least == np.iinfo(np.uint64).max, EMPTY, least & np.uint64(0xFF)).astype(np.int64)
    return roots, sketch.reshape(n, BINS)


_HEX = [f"{b:02x}" for b in range(256)] + [".."]


def written(roots: np.ndarray, sketches: np.ndarray) -> list[str]:
    return [f"{root:016x}:" + "".join([_HEX[b] for b in sketch]) for root, sketch in zip(roots.tolist(), sketches.tolist())]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of agreeing bins among those that are not empty on both sides, less chance agreement."""
    used = (a != EMPTY) | (b != EMPTY)
    n = used.sum(1)
    share = ((a == b) & used).sum(1) / np.maximum(n, 1)
    return np.where(n == 0, 1.0, np.maximum(0.0, (share - 1 / 256) / (1 - 1 / 256)))


def compared(texts: list[str], following: list[str]) -> list:
    """n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each text, given
    the next one."""
    edited = [t[:len(t) - len(t) // 2] + f[:len(t) // 2] for t, f in zip(texts, following)]
    chain = all(a is b for a, b in zip(texts[1:], following))
    own, changed = [t.encode() for t in texts], [e.encode() for e in edited]
    after = [following[-1].encode()] if chain else [f.encode() for f in following]
    n = len(texts)
    roots, sketches = fingerprints(own + changed + after)
    mine, theirs = sketches[:n], np.concatenate([sketches[1:n], sketches[2 * n:]]) if chain else sketches[2 * n:]
    return [[len(t) for t in texts], [hashlib.sha256(e).hexdigest() for e in changed],
            written(roots[:n], mine), written(roots[n:2 * n], sketches[n:2 * n]),
            likeness(mine, sketches[n:2 * n]), likeness(mine, theirs)]


RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Per row: the id column, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next; the edited text has the last half of its characters replaced by the next row's first."""
    spark = docs.sparkSession
    ship_package(spark)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(named(id_col).alias("id"), F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"))
    # the beginning of the text splits the rows of a hot id, in the order of whole texts
    rows = rows.repartitionByRange(partitions, F.col("id"), F.substring("text", 1, 64)).sortWithinPartitions("id", "text")
    made = T.StructType.fromDDL(RESULT).fields
    rim = [T.StructField("part", T.LongType()), T.StructField("rim", T.StringType()), T.StructField("text", T.StringType())]
    schema = T.StructType([rows.schema["id"], *made, *rim])

    def batch_of(ids, values, part=None, rim=None, texts=None):
        n = len(ids)
        nulls = lambda kind: pa.nulls(n, kind)
        kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        columns = [nulls(k) for k in kinds] if values is None else [pa.array(v, k) for v, k in zip(values, kinds)]
        rims = [nulls(pa.int64()), nulls(pa.string()), nulls(pa.string())] if rim is None else [
            pa.array([part] * n, pa.int64()), pa.array(rim, pa.string()), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays([ids, *columns, *rims], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held_id, held = None, None
        for batch in batches:
            ids, texts = batch.column("id"), text_column(batch, "text")
            _, offsets = byte_view(texts)
            if held is None and len(texts):
                yield batch_of(ids.slice(0, 1), None, part, ["first"], [texts[0].as_py()])
            at = 0
            while at < len(texts):
                stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES // 2, side="right")) - 1)
                some = texts.slice(at, stop - at).to_pylist()
                chosen = ids.slice(at, stop - at)
                if held is not None:
                    some = [held, *some]
                    chosen = pa.concat_arrays([held_id, chosen])
                if len(some) > 1:
                    yield batch_of(chosen.slice(0, len(some) - 1), compared(some[:-1], some[1:]))
                held_id, held = chosen.slice(len(some) - 1, 1), some[-1]
                at = stop
        if held is not None:
            yield batch_of(held_id, None, part, ["last"], [held])

    path = shared_path(spark, "fingerprints")
    rows.mapInArrow(run, schema).write.parquet(path)
    stored = spark.read.schema(schema).parquet(path)

    # the rims: one row for each partition on either side, whatever the number of rows
    rims = stored.where(F.col("rim").isNotNull())
    parts = rims.where("rim = 'first'").select("part")
    order = Window.orderBy("part")
    following = parts.select("part", F.coalesce(F.lead("part").over(order), F.min("part").over(Window.partitionBy())).alias("next"))
    last = rims.where("rim = 'last'").select("id", "part", "text").join(following, "part")
    first = rims.where("rim = 'first'").select(F.col("part").alias("next"), F.col("text").alias("following"))
    pairs = last.join(first, "next").select("id", "text", "following")
    pair_schema = T.StructType([rows.schema["id"], *made])

    def run_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        for batch in batches:
            texts, following = text_column(batch, "text").to_pylist(), text_column(batch, "following").to_pylist()
            for k in range(len(texts)):
                values = compared(texts[k:k + 1], following[k:k + 1])
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(k, 1), *[pa.array(v, t) for v, t in zip(values, kinds)]],
                                                 names=pair_schema.names)

    whole = stored.where(F.col("rim").isNull()).select(*pair_schema.names).unionAll(pairs.mapInArrow(run_pairs, pair_schema))
    return whole.withColumnRenamed("id", id_col)
