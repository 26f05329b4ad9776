"""Language identification by error-correcting output codes.

Each language has a codeword of bits. For each bit a binary classifier on byte trigrams tells the
languages whose bit is 1 from the others: its weight of a trigram is the logarithm of the ratio of
the trigram's shares on the two sides, each language counting alike. A text's margin for a bit is
the mean weight of its trigrams times ``GAIN``. Decoding takes the codeword with the least
total logistic loss of the margins; the losses give a score, and a text whose two best codewords
are close is flagged as ambiguous.

Counts come from all training rows: each task counts its trigrams per language, and Spark adds up
the counts. The result, one row per language and trigram bucket, does not grow with the rows.

Defined cases: a null text, or one without any letter, is ``und`` with score 0 and not ambiguous;
rows with a null text or a null language train nothing; one language is always predicted with
score 1; without training rows every text is ``und``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import byte_view, map_texts, named, pieces, ship_package, text_column, worker_memo
from kestrel.llm.byte_words import LOWER

BUCKET_BITS = 15
GAIN = 6.0
SMOOTHING = 0.5
AMBIGUOUS = 0.8  # a best score below this is flagged
EXHAUSTIVE = 6  # languages up to which every split of them is a bit

_LETTERS = LOWER.copy()
_LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def trigrams(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of all texts, and the text of each; runs of one space only, other
    ASCII characters than letters count as space."""
    data = _LETTERS[flat]
    n = len(data)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    if n:
        keep = np.ones(n, bool)
        keep[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20)
        data, doc = data[keep], doc[keep]
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    wide = data.astype(np.uint32)
    code = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)
    inside = doc[2:] == doc[:-2]
    return bucket[inside].astype(np.int64), doc[2:][inside]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, of -1 and 1
    weights: np.ndarray  # buckets x bits


def codewords(n: int) -> np.ndarray:
    """n codewords: every split of a few languages, else rows of a Hadamard matrix."""
    if n <= EXHAUSTIVE:
        columns = [(1, *rest) for rest in product((1, -1), repeat=max(0, n - 1)) if -1 in rest]
        return np.array(columns, float).reshape(-1, n).T
    size = 8
    while size < 2 * n:
        size *= 2
    k = np.arange(size)
    code = 1.0 - 2.0 * (np.bitwise_count(k[:, None] & k[None, :]) & 1)
    code = code[1:n + 1]
    return code[:, np.abs(code.sum(0)) < n]


def fit(training: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Train on all rows with a text and a language."""
    rows = training.select(named(lang_col).cast("string").alias("lang"), named(text_col).cast("string").alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = text_column(batch, "text"), np.array(batch.column("lang").to_pylist(), object)
            for start, stop in pieces(texts):
                bucket, doc = trigrams(*byte_view(texts.slice(start, stop - start)))
                names, number = np.unique(langs[start:stop].astype(str), return_inverse=True)
                found = np.bincount((number[doc] << BUCKET_BITS) + bucket, minlength=len(names) << BUCKET_BITS)
                for name, counts in zip(names.tolist(), found.reshape(len(names), -1)):
                    totals[name] = totals[name] + counts if name in totals else counts
        for name, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())],
                names=["lang", "bucket", "n"])

    ship_package(training.sparkSession)
    counted = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    tables = counted.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("t"))  # 2**15 entries a language at most
    counts: dict[str, np.ndarray] = {}
    for row in tables.toLocalIterator():
        table = np.zeros(1 << BUCKET_BITS)
        for bucket, n in row["t"]:
            table[bucket] = n
        counts[row["lang"]] = table
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((0, 0)), np.zeros((1 << BUCKET_BITS, 0)))
    shares = np.stack([(counts[x] + SMOOTHING) / (counts[x] + SMOOTHING).sum() for x in languages])
    code = codewords(len(languages))
    bits = [np.log(shares[code[:, b] > 0].mean(0)) - np.log(shares[code[:, b] < 0].mean(0)) for b in range(code.shape[1])]
    weights = np.stack(bits, axis=1) if bits else np.zeros((1 << BUCKET_BITS, 0))
    return Model(languages, code, weights.astype(np.float32))


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the best language, its score) per row of margins: the loss of each codeword is the
    sum of its bits' logistic losses, and scores are the shares of exp(-loss)."""
    loss = np.logaddexp(0, -margins[:, None, :] * model.code[None, :, :]).sum(2)
    likely = np.exp(loss.min(1, keepdims=True) - loss)
    return loss.argmin(1), likely.max(1) / likely.sum(1)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id column, lang_pred, score, ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = f"language-{uuid.uuid4()}"
    bits = model.code.shape[1] if model.languages else 0
    languages = model.languages

    def make(texts: pa.Array):
        if not languages:
            return [["und"] * len(texts), [0.0] * len(texts), [False] * len(texts)]
        made = worker_memo(key, lambda: shared.value)
        bucket, doc = trigrams(*byte_view(texts))
        n = np.maximum(np.bincount(doc, minlength=len(texts)), 1)
        margins = np.empty((len(texts), bits))
        for b in range(bits):
            margins[:, b] = np.bincount(doc, made.weights[bucket, b], len(texts)) * GAIN / n
        best, score = decode(made, margins)
        return [[languages[k] for k in best], score.tolist(), (score < AMBIGUOUS).tolist()]

    letters = F.coalesce(named(text_col).rlike(r"\p{L}"), F.lit(False)).alias("__letters")
    rows = docs.select(named(id_col), letters, named(text_col).alias("__whole"))
    found = map_texts(rows, "__whole", [id_col, "__letters"], make, "lang_pred string, score double, ambiguous boolean")
    und = ~F.col("__letters")
    return found.select(named(id_col), F.when(und, "und").otherwise(F.col("lang_pred")).alias("lang_pred"),
                        F.when(und, 0.0).otherwise(F.col("score")).alias("score"),
                        F.when(und, False).otherwise(F.col("ambiguous")).alias("ambiguous"))
