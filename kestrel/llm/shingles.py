"""Weighted word shingles of texts, and consistent weighted samples of them.

A text's shingles are its runs of ``WIDTH`` consecutive lower-case words (all its words, if there
are fewer), as 64-bit hashes. A shingle weighs (1 + ln tf) * idf. The idf is 1 up to a document
frequency of ``COMMON`` of all rows and falls with the logarithm of the frequency to ``FLOOR`` for
a shingle of every row, so only common shingles need a stored frequency: there are at most
(mean shingles per text) / COMMON of those, whatever the number of rows. The rows counted here are
the caller's different texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import byte_view, named, pieces, ship_package, text_column
from kestrel.llm.byte_words import mix, window_hashes, word_bounds, word_hashes

WIDTH = 5
COMMON = 0.02
FLOOR = 0.5
#: a block of rows is counted at once; it ends at so many rows or shingles
BLOCK_ROWS, BLOCK_SHINGLES = 2000, 4_000_000


def text_shingles(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: its distinct shingles, ascending, and how often each occurs."""
    flat, offsets = byte_view(texts)
    starts, ends, of_text = word_bounds(flat, offsets)
    words = word_hashes(flat, starts, ends)
    windows = window_hashes(words, WIDTH)
    out = []
    for first, last in zip(of_text[:-1].tolist(), of_text[1:].tolist()):
        if last - first >= WIDTH:
            out.append(np.unique(windows[first:last - WIDTH + 1], return_counts=True))
        elif last > first:
            out.append((window_hashes(words[first:last], last - first), np.ones(1, np.int64)))
        else:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    return out


def _block_counts(block: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in at least COMMON / 2 of a block's rows, and in how many."""
    found, n = np.unique(np.concatenate(block), return_counts=True)
    often = n >= max(1, math.ceil(COMMON / 2 * len(block)))
    return found[often], n[often]


def common_shingles(rows: DataFrame, text_col: str) -> dict[int, int]:
    """Document frequency of every shingle that at least COMMON of the rows hold.

    Two passes. A shingle of that frequency is in COMMON / 2 of the rows even when the blocks where
    it is rarer than that are left out, so the sums of the first pass name all of them and not many
    more; the second pass counts those exactly.
    """
    spark = rows.sparkSession
    ship_package(spark)
    texts = rows.select(named(text_col).cast("string").alias("text"))
    total = texts.count()
    if not total:
        return {}

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[np.ndarray] = []
        size = 0

        def result():
            found, n = _block_counts(block)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["shingle", "n"])

        for batch in batches:
            texts = text_column(batch, "text")
            for start, stop in pieces(texts):
                for found, _ in text_shingles(texts.slice(start, stop - start)):
                    block.append(found)
                    size += len(found)
                    if len(block) >= BLOCK_ROWS or size >= BLOCK_SHINGLES:
                        yield result()
                        block, size = [], 0
        if block:
            yield result()

    sums = texts.mapInArrow(local, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    names = np.sort(np.array([r["shingle"] for r in sums.where(F.col("n") >= COMMON / 2 * total).select("shingle").collect()],
                             np.int64).view(np.uint64))
    if not len(names):
        return {}
    shared = spark.sparkContext.broadcast(names)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        n = np.zeros(len(known), np.int64)
        for batch in batches:
            texts = text_column(batch, "text")
            for start, stop in pieces(texts):
                for found, _ in text_shingles(texts.slice(start, stop - start)):
                    at = np.minimum(np.searchsorted(found, known), max(len(found) - 1, 0))
                    if len(found):
                        n += found[at] == known
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(known[at].view(np.int64)), pa.array(n[at])], names=["shingle", "n"])

    counts = texts.mapInArrow(exact, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    return {r["shingle"]: r["n"] for r in counts.where(F.col("n") >= COMMON * total).collect()}


class Weights:
    """Weights of shingles, given the frequencies of the common ones and the number of rows."""

    def __init__(self, common: dict[int, int], total: int):
        self.names = np.array(sorted(common), np.int64).view(np.uint64)
        order = np.argsort(self.names)
        df = np.array([common[k] for k in sorted(common)], float)[order]
        self.names = self.names[order]
        span = math.log(1 / COMMON)
        self.idf = 1 - (1 - FLOOR) * np.log(np.maximum(df / (COMMON * max(total, 1)), 1)) / span

    def of(self, found: np.ndarray, n: np.ndarray) -> np.ndarray:
        weights = 1 + np.log(n) if len(n) and n.max() > 1 else np.ones(len(n))
        if len(self.names) and len(found):
            at = np.minimum(np.searchsorted(self.names, found), len(self.names) - 1)
            weights = np.where(self.names[at] == found, weights * self.idf[at], weights)
        return weights


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller weights over the sum of the larger ones (0 if both texts have none)."""
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    both = a[0][at] == b[0] if len(a[0]) else np.zeros(len(b[0]), bool)
    least = np.minimum(a[1][at[both]], b[1][both]).sum()
    most = a[1].sum() + b[1].sum() - least
    return float(least / most) if most else 0.0


class Sampler:
    """Improved consistent weighted sampling with ``n`` samples.

    Each sample's variates r, c (Gamma 2) and beta (uniform) of a shingle come from a table of
    2**16 triples, drawn by 16 bits of the shingle's hash for that sample; equal draws are told
    apart by the hash's other bits. For a weight of 1 the sampled t is 0 and ln a is known
    beforehand, so most shingles cost one look-up.
    """

    def __init__(self, n: int, seed: int = 20):
        rng = np.random.default_rng(seed)
        self.salts = rng.integers(0, 1 << 63, n, np.uint64)
        self.factors = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
        size = 1 << 16
        self.r, self.ln_c, self.beta = rng.gamma(2, 1, size), np.log(rng.gamma(2, 1, size)), rng.random(size)
        ln_a = self.ln_c + self.r * self.beta - self.r
        self.sorted = np.sort(ln_a)
        self.rank = np.searchsorted(self.sorted, ln_a).astype(np.uint64) << np.uint64(48)

    def samples(self, found: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Samples of several texts: their shingles one after another, ``starts`` of each (none
        empty). Two texts agree in a sample with the probability of their weighted Jaccard."""
        low = np.uint64((1 << 48) - 1)
        other = np.flatnonzero(weights != 1)
        ln_w = np.log(weights[other])
        out = np.empty((len(starts), len(self.salts)), np.uint32)
        for k, (salt, factor) in enumerate(zip(self.salts, self.factors)):
            x = found ^ salt
            x *= factor
            x ^= x >> np.uint64(29)
            draw = x >> np.uint64(48)
            key = self.rank[draw]
            key |= x & low
            if len(other):
                i = draw[other]
                r, beta = self.r[i], self.beta[i]
                t = np.floor(ln_w / r + beta)
                ln_a = self.ln_c[i] - r * (t - beta) - r
                rank = np.minimum(np.searchsorted(self.sorted, ln_a), (1 << 16) - 1).astype(np.uint64)
                same = t.astype(np.int64).view(np.uint64)
                named_t = np.where(t == 0, x[other], mix(x[other] + same * np.uint64(0x9E3779B97F4A7C15))) & low
                key[other] = rank << np.uint64(48) | named_t
            out[:, k] = np.minimum.reduceat(key, starts) & np.uint64(0xFFFFFFFF)
        return out
