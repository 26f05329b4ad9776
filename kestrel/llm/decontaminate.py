"""Benchmark decontamination: windows of a benchmark's words looked up in training texts.

The words of every benchmark item give windows of ``WINDOW`` consecutive words (an item of fewer
words is one window). Spark derives the windows, and their hashes are broadcast as a sorted array
behind a bitmap. Each document's windows are hashed from its bytes; a hash that is found is
verified against the words themselves, so a chance match never counts. A document word inside any
occurrence of a window is hit.

Size bound: a broadcast block holds at most ``BLOCK_WINDOWS`` windows. A larger benchmark is dealt
over several blocks by hash, and the documents pass over one block after another, with their
matches so far as a column; no window is left out.

Defined cases: a null or empty text has no words, no hits and is clean; items without words match
nothing; items with equal windows are all reported; an item_id that repeats is reported once;
a null item_id is not reported but its windows count; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import bisect
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import byte_view, map_texts, named, worker_memo
from kestrel.llm.byte_words import LOWER, window_hashes, window_places, word_bounds, word_hashes

WINDOW = 13
BLOCK_WINDOWS = 1_000_000
CONTAMINATED_SHARE = 20  # hit words times this reach the number of words

_BITS = 20


class Pieces:
    """Words of some texts, ready for windows of any width."""

    def __init__(self, texts: pa.Array):
        self.flat, self.offsets = byte_view(texts)
        self.starts, self.ends, self.of_text = word_bounds(self.flat, self.offsets)
        self.hashes = word_hashes(self.flat, self.starts, self.ends)

    def phrase(self, place: int, width: int) -> bytes:
        """The lower-case words of a window, joined by spaces."""
        return b" ".join([LOWER[self.flat[a:b]].tobytes() for a, b in
                          zip(self.starts[place:place + width], self.ends[place:place + width])])


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """One row per different window: hash, width, phrase, and the items that hold it."""
    def make(texts: pa.Array):
        words = Pieces(texts)
        out = []
        for first, last in zip(words.of_text[:-1].tolist(), words.of_text[1:].tolist()):
            width = min(window, last - first)
            hashes = window_hashes(words.hashes[first:last], width).view(np.int64).tolist() if width else []
            out.append([(h, width, words.phrase(first + k, width)) for k, h in enumerate(hashes)])
        return [out]

    found = map_texts(benchmark, text_col, [id_col], make, "w array<struct<hash: long, width: int, phrase: binary>>")
    return (found.select(named(id_col).cast("string").alias("item"), F.explode("w").alias("w"))
            .groupBy("w.hash", "w.width", "w.phrase").agg(F.sort_array(F.collect_set("item")).alias("items")))


class Block:
    """Windows of one broadcast block, by width."""

    def __init__(self, rows: Sequence[tuple[int, int, bytes, list[str]]]):
        self.items = {}
        hashes: dict[int, list[int]] = {}
        for h, width, phrase, items in rows:
            self.items[width, bytes(phrase)] = items
            hashes.setdefault(width, []).append(h)
        self.hashes = {}
        for width, values in hashes.items():
            sorted_hashes = np.unique(np.array(values, np.int64).view(np.uint64))
            seen = np.zeros(1 << _BITS, bool)
            seen[sorted_hashes >> np.uint64(64 - _BITS)] = True
            self.hashes[width] = sorted_hashes, seen

    def matches(self, words: Pieces):
        """(place, width, items) of every window of the block that the texts hold."""
        for width, (known, seen) in self.hashes.items():
            hashes = window_hashes(words.hashes, width)
            places = np.flatnonzero(seen[hashes >> np.uint64(64 - _BITS)])
            at = np.minimum(np.searchsorted(known, hashes[places]), len(known) - 1)
            places = places[known[at] == hashes[places]]
            if len(places):
                places = places[window_places(words.of_text, width)[places]]
            for place in places.tolist():
                if (items := self.items.get((width, words.phrase(place, width)))) is not None:
                    yield place, width, items


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = out[-1][0], end
        else:
            out.append((start, end))
    return out


RESULT = ("n_words long, spans array<struct<start: long, end: long>>, items array<string>, "
          "char_spans array<struct<start: long, end: long>>")


def scan_texts(texts: pa.Array, block: Block) -> list[list]:
    """Per text: number of words, hit spans in words, matching items, hit spans in UTF-8 bytes."""
    words = Pieces(texts)
    n_words = np.diff(words.of_text)
    spans: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    starts = words.of_text.tolist()
    for place, width, found in block.matches(words):
        doc = bisect.bisect_right(starts, place) - 1
        spans.setdefault(doc, []).append((place - starts[doc], place - starts[doc] + width))
        items.setdefault(doc, set()).update(x for x in found if x is not None)
    unions = [covered(spans.get(k, [])) for k in range(len(texts))]
    in_bytes = [[(int(words.starts[starts[k] + a] - words.offsets[k]), int(words.ends[starts[k] + b - 1] - words.offsets[k]))
                 for a, b in union] for k, union in enumerate(unions)]
    return [n_words.tolist(), unions, [sorted(items.get(k, ())) for k in range(len(texts))], in_bytes]


def blocks_of(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, window: int) -> list:
    """The benchmark's windows as broadcast blocks of bounded size (at least one, maybe empty)."""
    spark = docs.sparkSession
    windows = benchmark_windows(benchmark, item_col, item_text_col, window).persist()
    try:
        n = max(1, -(-windows.count() // BLOCK_WINDOWS))
        out = []
        for k in range(n):
            rows = windows.where(F.pmod(F.xxhash64("hash"), F.lit(n)) == k).collect()
            out.append((f"benchmark-{uuid.uuid4()}", spark.sparkContext.broadcast(
                [(r["hash"], r["width"], bytes(r["phrase"]), r["items"]) for r in rows])))
        return out
    finally:
        windows.unpersist()


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
            keep: Sequence[str] | None = None) -> DataFrame:
    """Per row: the id column (or the columns of ``keep``), n_words, spans (hit words, end
    exclusive), items (matching item ids as sorted strings), char_spans (hit UTF-8 bytes)."""
    keep = [id_col] if keep is None else list(keep)
    blocks = blocks_of(docs, benchmark, item_col, item_text_col, window)
    if len(blocks) == 1:
        (key, shared), = blocks
        return map_texts(docs, text_col, keep,
                         lambda texts: scan_texts(texts, worker_memo(key, lambda: Block(shared.value))), RESULT)
    # More windows than one block may hold: each block in a pass of its own, with the rows' matches
    # so far; the written pass in between keeps only one block at a time in a worker.
    ids = [f"k{i}" for i in range(len(keep))]
    state = docs.select(*[named(c).alias(k) for c, k in zip(keep, ids)], named(text_col).cast("string").alias("text"))
    so_far: list[str] = []
    for key, shared in blocks:
        found = map_texts(state, "text", [*ids, "text", *so_far],
                          lambda texts, key=key, shared=shared: scan_texts(texts, worker_memo(key, lambda: Block(shared.value))),
                          RESULT)
        lists = [F.concat(f"so_far_{c}", c) if so_far else F.col(c) for c in LISTS]
        so_far = [f"so_far_{c}" for c in LISTS]
        done = found.select(*ids, "text", "n_words", *[x.alias(c) for x, c in zip(lists, so_far)]).checkpoint()
        state = done.drop("n_words")
    merged = done.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "n_words", union_of("so_far_spans").alias("spans"),
        F.array_sort(F.array_distinct("so_far_items")).alias("items"), union_of("so_far_char_spans").alias("char_spans"))
    return merged


LISTS = ["spans", "items", "char_spans"]


def union_of(column: str):
    """Overlapping or touching spans joined, in order."""
    step = lambda made, s: F.when(
        (F.size(made) > 0) & (s["start"] <= F.element_at(made, -1)["end"]),
        F.concat(F.slice(made, 1, F.size(made) - 1),
                 F.array(F.struct(F.element_at(made, -1)["start"].alias("start"),
                                  F.greatest(F.element_at(made, -1)["end"], s["end"]).alias("end"))))
    ).otherwise(F.concat(made, F.array(s)))
    empty = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return F.aggregate(F.array_sort(column), empty, step)


def n_hit(spans: str = "spans"):
    return F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contaminated(hit, n_words):
    """The rule: some word is hit, and at least one word in twenty."""
    return (hit > 0) & (hit * CONTAMINATED_SHARE >= n_words)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                        item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows whose text is not contaminated, unchanged; the others go."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text = names[docs.columns.index(text_col)]
    found = matches(plain, benchmark, text_col=text, item_col=item_col, item_text_col=item_text_col, keep=names)
    kept = found.where(~contaminated(n_hit(), F.col("n_words"))).select(*names)
    return kept.toDF(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The id column and the text without its hit words (what stands between two hit words of one
    span goes with them)."""
    found = matches(docs, benchmark, id_col, text_col, item_col, item_text_col, keep=[id_col, text_col])
    data = F.encode(F.coalesce(named(text_col), F.lit("")), "UTF-8")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.col("char_spans.end"))
    starts = F.concat(F.col("char_spans.start"), F.array(F.octet_length(data).cast("long")))
    parts = F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")),
                        lambda p: F.decode(F.substring(data, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")), "UTF-8"))
    return found.select(named(id_col), F.when(named(text_col).isNotNull(), F.array_join(parts, "")).alias(text_col))
