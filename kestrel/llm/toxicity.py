"""Toxicity scores by a factorization machine over hashed terms.

A text's features are the words it holds and the words' beginnings, hashed to ``2**TERM_BITS``
terms, each present or absent.
The machine adds a weight per term and, for each pair of terms, the dot product of their factor
vectors, so that a pair (an insult and a mention of a group, say) can count although neither term
does. Weights and factors are shrunk towards zero at each step, which leaves terms without
evidence at exactly zero; long texts gather no noise that way.

Training uses a bounded sample of labelled rows: at most about ``TRAIN_ROWS`` of them, half for
each label if there are as many, drawn by a hash of doc_id. The labels are drawn before they meet
the documents, so the join broadcasts a table of that bounded size and no text is shuffled. Terms in
``MIN_ROWS`` different training texts are screened, on their own and in pairs: used are terms whose
share of toxic texts is ``MIN_Z`` standard errors off the sample's (in a half/half sample
four texts of one label are enough), and both terms of each pair whose texts' labels are not
explained by its two terms, however even the labels of each term alone. All else works on every row
and whole texts.

Defined cases: a null or empty text scores the intercept; a doc_id that is labelled twice is toxic
if any label says so; rows with a null label or a null doc_id train nothing, but are scored; equal
training texts count once; without labels of both classes the score is the share of toxic labels
(0 if there are none).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import byte_view, map_texts, named, worker_memo
from kestrel.llm.byte_words import mix, word_bounds, word_hashes

TERM_BITS = 20
#: lengths in bytes of the word beginnings that are terms of their own
STEMS = (4, 5, 6, 7)
FACTORS = 4
TRAIN_ROWS = 16_000
MIN_ROWS = 3
MIN_Z = 2.0
#: a pair is used if chance gives e**-PAIR_ODDS such pairs, or fewer, among all that are screened
PAIR_ODDS = 3.0
EPOCHS = 60
BATCH = 256
RATE = 0.2
SHRINK = 2e-4


def text_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms of all words, and the text of each: the word, and its first bytes where it is
    longer, so that a stem is known whatever follows it."""
    flat, offsets = byte_view(texts)
    starts, ends, of_text = word_bounds(flat, offsets)
    doc = np.repeat(np.arange(len(texts)), np.diff(of_text))
    hashes, docs = [word_hashes(flat, starts, ends)], [doc]
    for length in STEMS:
        longer = np.flatnonzero(ends - starts > length)
        hashes.append(mix(word_hashes(flat, starts[longer], starts[longer] + length) + np.uint64(length)))
        docs.append(doc[longer])
    return (np.concatenate(hashes) >> np.uint64(64 - TERM_BITS)).astype(np.int64), np.concatenate(docs)


def distinct_terms(texts: pa.Array) -> list[np.ndarray]:
    """The distinct terms of each text, ascending."""
    terms, docs = text_terms(texts)
    pairs = np.unique(docs << TERM_BITS | terms)
    cuts = np.searchsorted(pairs, np.arange(len(texts) + 1) << TERM_BITS)
    terms = (pairs & ((1 << TERM_BITS) - 1)).astype(np.int32)
    return [terms[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


@dataclass
class Model:
    """intercept; the used terms, ascending; their weights and factors."""
    intercept: float
    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray


def row_sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    if values.ndim == 1:
        return np.bincount(rows, values, n)
    return np.stack([np.bincount(rows, v, n) for v in values.T], axis=1)


def margins(terms, rows, n, intercept, weights, factors):
    """The machine's sum per row, and the factor sums that its gradient needs."""
    own = factors[terms]
    sums = row_sums(own, rows, n)
    pairs = 0.5 * ((sums ** 2).sum(1) - row_sums((own ** 2).sum(1), rows, n))
    return intercept + row_sums(weights[terms], rows, n) + pairs, sums, own


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Kullback-Leibler divergence of coins with shares p and q; q is neither 0 nor 1."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * np.log(p / q), 0) + np.where(p < 1, (1 - p) * np.log((1 - p) / (1 - q)), 0)


def paired_terms(lists: list[np.ndarray], y: np.ndarray, seen: np.ndarray, toxic: np.ndarray,
                 used: np.ndarray) -> np.ndarray:
    """Terms of pairs whose share of toxic texts is off what the two terms give by adding their own
    log odds. A share of n texts this far off has a probability of at most exp(-n * divergence).
    Pairs of used terms need no screen, and a pair needs the texts of one label that reach the bound
    against the sample's share."""
    share = y.mean()
    screened = int((seen >= MIN_ROWS).sum())
    bound = np.log(max(screened, 2) ** 2 / 2) + PAIR_ODDS
    bad_least, clean_least = (max(MIN_ROWS, int(np.ceil(bound / -np.log(x)))) for x in (share, 1 - share))
    often = np.flatnonzero((toxic >= bad_least) | (seen - toxic >= clean_least))
    if not len(often):
        return often
    # terms of the same texts, as a word and its beginnings, are screened as one
    marks, of_texts = np.random.default_rng(7).integers(0, 1 << 63, len(lists), np.uint64), np.zeros(1 << TERM_BITS, np.uint64)
    for mark, terms in zip(marks, lists):
        of_texts[terms] += mark
    _, first, group = np.unique(of_texts[often], return_index=True, return_inverse=True)
    number = np.full(1 << TERM_BITS, -1, np.int32)
    number[often[first]] = np.arange(len(first))
    rows = [(k := number[terms])[k >= 0] for terms in lists]
    size, bad_size = seen[often[first]], toxic[often[first]]
    ends = np.cumsum(size)
    # the texts of each term, ascending, term after term
    rows_of, place = np.empty(int(ends[-1]), np.int32), ends - size
    for i, terms in enumerate(rows):
        rows_of[place[terms]] = i
        place[terms] += 1
    smooth = (bad_size + share) / (size + 1)
    odds = np.log(smooth / (1 - smooth))
    known = np.isin(often[first], used)
    found = np.zeros(len(first), bool)

    def counts(own):
        out = np.zeros(len(first), np.int64)
        for at in range(0, len(own), 8 * BATCH):
            out += np.bincount(np.concatenate([rows[i] for i in own[at:at + 8 * BATCH]]), minlength=len(first))
        return out

    for a in np.flatnonzero(~known).tolist():
        own = rows_of[ends[a - 1] if a else 0:ends[a]]
        bad = counts(own[y[own] == 1])
        n = bad + counts(own[y[own] == 0])
        # a term that is there whenever the other is tells no more than that one
        b = np.flatnonzero((bad >= bad_least) | (n - bad >= clean_least))
        b = b[(n[b] < size[a]) & (n[b] < size[b])]
        expected = logistic(odds[a] + odds[b] - np.log(share / (1 - share)))
        off = b[n[b] * divergence(bad[b] / n[b], expected) >= bound]
        if len(off):
            found[off] = found[a] = True
    return often[found[group]]


def train(samples: list[tuple[bytes, int]], prior: tuple[int, int]) -> Model:
    """Fit to (terms as int32 bytes, label) rows. ``prior``: labelled rows of class 0 and 1 that the
    sample stands for."""
    labels_of: dict[bytes, int] = {}
    for terms, label in samples:
        labels_of[terms] = max(label, labels_of.get(terms, 0))
    rows = sorted(labels_of.items())
    y = np.array([label for _, label in rows], float)
    total = sum(prior)
    if not len(y) or y.min() == y.max():
        share = min(max(prior[1] / total if total else 0.0, 1e-6), 1 - 1e-6)
        return Model(float(np.log(share / (1 - share))), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)))
    lists = [np.frombuffer(terms, np.int32) for terms, _ in rows]
    seen = np.bincount(np.concatenate(lists), minlength=1 << TERM_BITS)
    toxic = np.bincount(np.concatenate([terms for terms, label in zip(lists, y) if label]), minlength=1 << TERM_BITS)
    share = y.mean()
    z = (toxic - seen * share) / np.sqrt(np.maximum(seen, 1) * share * (1 - share))
    used = np.flatnonzero((seen >= MIN_ROWS) & (np.abs(z) >= MIN_Z))
    used = np.union1d(used, paired_terms(lists, y, seen, toxic, used))
    number = np.full(1 << TERM_BITS, -1, np.int32)
    number[used] = np.arange(len(used))
    lists = [(k := number[terms])[k >= 0] for terms in lists]
    del samples, labels_of, rows  # the terms of all words are not needed any more

    rng = np.random.default_rng(7)
    weights, factors = np.zeros(len(used)), rng.normal(0, 0.01, (len(used), FACTORS))
    intercept, seen0 = float(np.log(y.mean() / (1 - y.mean()))), 1.0
    seen_w, seen_f = np.full(len(used), 1e-2), np.full(len(used), 1e-2)
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), BATCH):
            chosen = order[at:at + BATCH]
            terms = np.concatenate([lists[i] for i in chosen])
            of = np.repeat(np.arange(len(chosen)), [len(lists[i]) for i in chosen])
            m, sums, own = margins(terms, of, len(chosen), intercept, weights, factors)
            wrong = (logistic(m) - y[chosen]) / len(chosen)
            seen0 += wrong.sum() ** 2
            intercept -= RATE * wrong.sum() / np.sqrt(seen0)
            hit, back = np.unique(terms, return_inverse=True)
            g = np.bincount(back, wrong[of], len(hit))
            seen_w[hit] += g ** 2
            step = RATE / np.sqrt(seen_w[hit])
            w = weights[hit] - step * g
            weights[hit] = np.sign(w) * np.maximum(np.abs(w) - step * SHRINK, 0)
            g = row_sums(wrong[of, None] * (sums[of] - own), back, len(hit))
            seen_f[hit] += (g ** 2).mean(1)
            step = (RATE / np.sqrt(seen_f[hit]))[:, None]
            f = factors[hit] - step * g
            length = np.sqrt((f ** 2).sum(1, keepdims=True)) + 1e-12
            factors[hit] = f * np.maximum(1 - step * SHRINK / length, 0)
    # the sample's share of toxic rows, put back to that of all labelled rows
    drawn = np.array([np.sum(y == 0), np.sum(y == 1)], float)
    intercept += float(np.log(prior[1] / prior[0]) - np.log(drawn[1] / drawn[0]))
    keep = (weights != 0) | (factors != 0).any(1)
    return Model(intercept, used[keep], weights[keep], factors[keep])


def hash_part(column: Column) -> Column:
    """A number in [0, 1) from a hash of the id."""
    return F.pmod(F.xxhash64(column.cast("string"), F.lit("toxicity sample")), F.lit(1 << 30)) / (1 << 30)


def fit(docs: DataFrame, labels: DataFrame, trains: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> Model:
    """Train on a bounded sample of the labelled rows; ``trains`` is a condition on the id column."""
    marked = labels.select(named(id_col).alias("id"), named(label_col).cast("int").alias("label"))
    marked = marked.where(F.col("id").isNotNull() & F.col("label").isin(0, 1))
    marked = marked.groupBy("id").agg(F.max("label").alias("label"))
    if trains is not None:
        marked = marked.where(trains)
    count = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    total = sum(count.values())
    if not total:
        return train([], (0, 0))
    half = train_rows / 2
    room = {c: max(half, train_rows - count.get(1 - c, 0)) for c in (0, 1)}
    part = F.lit(0.0)
    for c in (0, 1):
        part = F.when(F.col("label") == c, min(1.0, room[c] / max(1, count.get(c, 0)))).otherwise(part)
    sample = marked.where(hash_part(F.col("id")) < part)  # about train_rows rows: safe to broadcast
    texts = docs.select(named(id_col).alias("id"), named(text_col).alias("text")).join(F.broadcast(sample), "id")

    def make(pieces: pa.Array):
        return [[terms.tobytes() for terms in distinct_terms(pieces)]]

    rows = map_texts(texts, "text", ["label"], make, "terms binary").collect()
    # taken out one by one, so that the driver holds the terms once, and not at all when they are numbered
    return train([(bytes(r["terms"]), r["label"]) for r in (rows.pop() for _ in range(len(rows)))], (count.get(0, 0), count.get(1, 0)))


class Scorer(NamedTuple):
    model: Model
    row_of: np.ndarray

    def scores(self, texts: pa.Array) -> np.ndarray:
        terms, docs = text_terms(texts)
        rows = self.row_of[terms]
        used = np.flatnonzero(rows >= 0)
        n, width = len(texts), max(1, len(self.model.terms))
        once = np.unique(docs[used] * width + rows[used])  # a term counts once in a text
        m, _, _ = margins(once % width, once // width, n, self.model.intercept, self.model.weights, self.model.factors)
        return logistic(m)


def scorer(model: Model) -> Scorer:
    row_of = np.full(1 << TERM_BITS, -1, np.int32)
    row_of[model.terms] = np.arange(len(model.terms))
    return Scorer(model, row_of)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` (all by default) and ``score``, the probability of a toxic text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 2**TERM_BITS terms
    key = f"toxicity-{uuid.uuid4()}"
    keep = docs.columns if keep is None else keep
    return map_texts(docs, text_col, keep,
                     lambda texts: [pa.array(worker_memo(key, lambda: scorer(shared.value)).scores(texts))], "score double")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that score below the threshold, unchanged."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    found = score(docs.toDF(*names), model, names[docs.columns.index(text_col)], names)
    return found.where(F.col("score") < threshold).select(*names).toDF(*docs.columns)
