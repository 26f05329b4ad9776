"""Language-model scores: prediction by partial matching over bytes, beside a token unigram score.

The trie holds the counts of every byte after every context of ``ORDER`` bytes in the training
texts, without a bound on their number; shorter contexts are its sums. A byte seen in the longest known
context costs its share there; otherwise the escape is paid (method C: number of different bytes seen,
over that number plus the context's count) and the next shorter context is asked, without the bytes
that the longer one had already seen (symbol exclusion), down to a uniform choice among bytes never seen.
A text's end is a symbol of its own.

Since the bytes of a longer context are among those of its suffix, what a byte costs follows from few
sums: those of the contexts on its path, and for each context what is left of its suffix's counts without
the context's bytes. They are group-bys and joins of the tables of the orders, on keys of which none is
hot (a context has at most 256 bytes, a byte string at most 256 longer ones); tables of orders 0 and 1
have at most 256 and 65,536 rows and are broadcast. The costs of the ``HOT_GRAMS`` most frequent
strings of ORDER + 1 bytes are broadcast as a hash table, so that scoring such a byte is one look-up; all
other strings of a text, known to the training or not, meet their costs in a shuffle join, once per text.

The unigram score needs the training count of every token, without a bound on their number: the at
most ``HOT_TOKENS`` most frequent ones are broadcast, and all others meet their counts in a shuffle
join, per text and token. Tokens are told apart by 64-bit hashes.

Defined cases: null and empty texts are scored as their end alone; rows with a null id train
(their remainder is unknown) unless the caller's condition says otherwise; repeated rows are scored one
by one; without training rows a byte costs log10(256) and the unigram score is 0 per token.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import byte_view, map_texts, named, pieces, ship_package, text_column, worker_memo
from kestrel.llm.byte_words import TOKEN, word_bounds, word_hashes
from kestrel.llm.graph import stored
from kestrel.session import shared_path

ORDER = 4
END = 0xFF  # no UTF-8 text holds this byte: it stands before a text, ORDER times, and ends it
HOT_TOKENS = 1 << 18
HOT_GRAMS = 1 << 20
#: different tokens or strings that a task counts before it passes them on
BLOCK_TOKENS = 2_000_000
#: bytes whose strings are built at once
BLOCK_BYTES = 1 << 20

TOKENS, GRAMS, ENDS = 0, 1, 2


def grams(flat: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The string of ORDER context bytes and the byte itself, as a number, for every byte and end of the
    texts in turn (a text of n bytes has n + 1), in blocks."""
    n, texts = len(flat), len(offsets) - 1
    lengths = np.diff(offsets)
    data = np.full(n + ORDER * texts + 1, END, np.uint8)
    data[np.arange(n) + np.repeat(ORDER * np.arange(1, texts + 1), lengths)] = flat
    first = np.concatenate([[0], np.cumsum(lengths + 1)])  # number of each text's first symbol
    for start in range(0, n + texts, BLOCK_BYTES):
        stop = min(start + BLOCK_BYTES, n + texts)
        text = np.searchsorted(first, np.arange(start, stop), side="right") - 1
        at = np.arange(start, stop) + (ORDER - 1) * text + ORDER
        codes = data[at - ORDER].astype(np.int64)
        for back in range(ORDER - 1, -1, -1):
            codes <<= 8
            codes |= data[at - back]
        yield codes


class Counts:
    """Counts of names, merged in blocks of bounded size."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, names: np.ndarray) -> None:
        self.parts.append(np.unique(names, return_counts=True))
        self.size += len(self.parts[-1][0])

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        names = np.concatenate([a for a, _ in self.parts])
        found, back = np.unique(names, return_inverse=True)
        return found, np.bincount(back, np.concatenate([b for _, b in self.parts]), len(found)).astype(np.int64)

    def full(self) -> tuple[np.ndarray, np.ndarray] | None:
        """The counts so far, which are then forgotten, if even merged ones are many."""
        if self.size >= BLOCK_TOKENS:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])
            if self.size >= BLOCK_TOKENS // 2:
                out, self.parts, self.size = self.parts[0], [], 0
                return out
        return None


def gather(training: DataFrame, text_col: str) -> DataFrame:
    """(kind, name, n): counts of tokens (by hash), of byte strings, and of ends."""
    ship_package(training.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {TOKENS: Counts(), GRAMS: Counts()}
        texts_seen = 0

        def rows(kind, names, n):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(names), kind, np.int32)), pa.array(names.astype(np.int64)), pa.array(n.astype(np.int64))],
                names=["kind", "name", "n"])

        for batch in batches:
            texts = text_column(batch, "text")
            for start, stop in pieces(texts):
                flat, offsets = byte_view(texts.slice(start, stop - start))
                texts_seen += stop - start
                for codes in grams(flat, offsets):
                    counts[GRAMS].add(codes)
                starts, ends, _ = word_bounds(flat, offsets, TOKEN)
                counts[TOKENS].add(word_hashes(flat, starts, ends).view(np.int64))
                for kind, own in counts.items():
                    block = own.full()
                    if block:
                        yield rows(kind, *block)
        for kind, own in counts.items():
            if own.parts:
                yield rows(kind, *own.merged())
        yield rows(ENDS, np.zeros(1), np.array([texts_seen]))

    texts = training.select(named(text_col).cast("string").alias("text"))
    counted = texts.mapInArrow(count, "kind int, name long, n long")
    return counted.groupBy("kind", "name").agg(F.sum("n").alias("n"))


def low_bytes(code: Column, n: int) -> Column:
    return code.bitwiseAND(F.lit((1 << 8 * n) - 1).cast("long"))


class Orders:
    """Tables of the trie: for each order the counts of its strings, (name, n), and its contexts,
    (name, total, types, rest_total, rest_types): count and number of the bytes seen after it, and the same of
    its suffix without those bytes."""

    def __init__(self, longest: DataFrame):
        self.strings: list[DataFrame] = [longest]
        for order in range(ORDER - 1, -1, -1):
            last = self.strings[0]
            shorter = last.groupBy(low_bytes(F.col("name"), order + 1).alias("name")).agg(F.sum("n").alias("n"))
            self.strings.insert(0, stored(shorter, f"lm-order-{order}"))
        self.contexts: list[DataFrame] = []
        for order, own in enumerate(self.strings):
            if order:
                lower = self.few(self.strings[order - 1].select(F.col("name").alias("low"), F.col("n").alias("taken")), order - 1)
                own = own.withColumn("low", low_bytes(F.col("name"), order)).join(lower, "low")
            else:
                own = own.withColumn("taken", F.lit(0))
            sums = own.groupBy(F.shiftright("name", 8).alias("name")).agg(
                F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"), F.sum("taken").alias("taken"))
            if order:
                suffix = self.few(self.contexts[order - 1].select(F.col("name").alias("low"), F.col("total").alias("all"), F.col("types").alias("kinds")),
                                  order - 2)
                sums = sums.withColumn("low", low_bytes(F.col("name"), order - 1)).join(suffix, "low").select(
                    "name", "total", "types", (F.col("all") - F.col("taken")).alias("rest_total"), (F.col("kinds") - F.col("types")).alias("rest_types"))
            else:
                sums = sums.select("name", "total", "types", F.lit(0).alias("rest_total"), F.lit(0).alias("rest_types"))
            self.contexts.append(stored(sums, f"lm-contexts-{order}"))
        self.never = 256 - self.strings[0].count()

    @staticmethod
    def few(table: DataFrame, order: int) -> DataFrame:
        """To be broadcast if it holds strings of at most two bytes."""
        return F.broadcast(table) if order <= 1 else table

    def costs(self, names: DataFrame) -> DataFrame:
        """(name, cost) of distinct strings of ORDER + 1 bytes: log10 P of the last byte after the others."""
        rows = names
        for order in range(ORDER + 1):
            string, context = self.strings[order], self.contexts[order]
            rows = rows.withColumn("s", low_bytes(F.col("name"), order + 1)).withColumn("c", low_bytes(F.shiftright("name", 8), order))
            string = string.select(F.col("name").alias("s"), F.col("n").alias(f"n{order}"))
            context = context.select(F.col("name").alias("c"), *[F.col(x).alias(f"{x}{order}") for x in ("total", "types", "rest_total", "rest_types")])
            rows = rows.join(self.few(string, order), "s", "left").join(self.few(context, order - 1), "c", "left").drop("s", "c")
        cost = F.log10(F.lit(1 / max(self.never, 1)))
        for order in range(ORDER + 1):
            total, types = F.col(f"total{order}"), F.col(f"types{order}")
            if order < ORDER:  # where the longer context is known, its bytes are excluded
                longer = F.col(f"total{order + 1}").isNotNull()
                total = F.when(longer, F.col(f"rest_total{order + 1}")).otherwise(total)
                types = F.when(longer, F.col(f"rest_types{order + 1}")).otherwise(types)
            seen = F.col(f"n{order}").isNotNull()
            here = F.when(F.col(f"total{order}").isNull() | (~seen & (types == 0)), 0.0).otherwise(
                F.log10(F.when(seen, F.col(f"n{order}")).otherwise(types) / (total + types)))
            cost = here + F.when(seen, 0.0).otherwise(cost)
        return rows.select("name", cost.alias("cost"))


@dataclass
class Model:
    """The most frequent byte strings with their costs, and the most frequent tokens with their counts, both
    by ascending name; totals."""
    grams: tuple[np.ndarray, np.ndarray]
    hot: tuple[np.ndarray, np.ndarray]
    ends: int
    tokens: int
    distinct: int


@dataclass
class Tables:
    """Counts of all tokens (name, n), and the trie's tables."""
    tokens: DataFrame
    orders: Orders


class HashTable:
    """Values of distinct numbers, looked up for many at once (open addressing)."""

    def __init__(self, names: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(names) - 1).bit_length())
        self.names, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.float32)
        left, at = np.arange(len(names)), self.start(names)
        while len(left):
            free = self.names[at] == -1
            self.names[at[free]] = names[left[free]]
            here = self.names[at] == names[left]
            self.values[at[here]] = values[left[here]]
            left, at = left[~here], (at[~here] + 1) & (len(self.names) - 1)

    def start(self, names: np.ndarray) -> np.ndarray:
        return ((names.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, 0 if there is none; whether there is one)."""
        at = self.start(names)
        have = self.names[at]
        known = have == names
        values = np.where(known, self.values[at], np.float32(0))
        left = np.flatnonzero(~known & (have != -1))
        at = at[left]
        while len(left):
            at = (at + 1) & (len(self.names) - 1)
            have = self.names[at]
            here = have == names[left]
            values[left[here]], known[left[here]] = self.values[at[here]], True
            more = ~here & (have != -1)
            left, at = left[more], at[more]
        return values, known


class Scorer:
    def __init__(self, model: Model):
        self.table = HashTable(*model.grams)
        self.names, n = model.hot
        self.hot_logs = np.log10(n + 0.5)
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self.names.view(np.uint64) >> np.uint64(42)] = True

    def trie(self, flat: np.ndarray, offsets: np.ndarray):
        """Per text: the cost of its broadcast strings, and the other ones with their numbers."""
        texts = len(offsets) - 1
        first = np.concatenate([[0], np.cumsum(np.diff(offsets) + 1)])
        costs, start = np.zeros(texts), 0
        cold: list[tuple[np.ndarray, np.ndarray]] = []
        for codes in grams(flat, offsets):
            values, known = self.table.find(codes)
            text = np.searchsorted(first, np.arange(start, start + len(codes)), side="right") - 1
            costs += np.bincount(text, values, texts)
            cold.append((text[~known], codes[~known]))
            start += len(codes)
        owner = np.concatenate([t for t, _ in cold]) if cold else np.zeros(0, np.int64)
        names = np.concatenate([c for _, c in cold]) if cold else np.zeros(0, np.int64)
        cuts = np.searchsorted(owner, np.arange(texts + 1))
        return costs, [np.unique(names[a:b], return_counts=True) for a, b in zip(cuts[:-1], cuts[1:])]

    def scores(self, texts: pa.Array):
        flat, offsets = byte_view(texts)
        ppm, strings = self.trie(flat, offsets)
        starts, ends, of_word = word_bounds(flat, offsets, TOKEN)
        names = word_hashes(flat, starts, ends)
        n_tokens = np.diff(of_word)
        doc = np.repeat(np.arange(len(texts)), n_tokens)
        hot = self.seen[names >> np.uint64(42)]
        names = names.view(np.int64)
        at = np.zeros(len(names), np.int64)
        if len(self.names):
            maybe = np.flatnonzero(hot)
            at[maybe] = np.minimum(np.searchsorted(self.names, names[maybe]), len(self.names) - 1)
            hot[maybe] = self.names[at[maybe]] == names[maybe]
        known = np.bincount(doc[hot], minlength=len(texts))
        logs = np.bincount(doc[hot], self.hot_logs[at[hot]], len(texts)).astype(np.float64)
        cold = names[~hot]
        cuts = np.searchsorted(doc[~hot], np.arange(len(texts) + 1))
        rare = [np.unique(cold[a:b], return_counts=True) for a, b in zip(cuts[:-1], cuts[1:])]
        return n_tokens, known, logs, ppm, [x for x, _ in rare], [n for _, n in rare], [x for x, _ in strings], [n for _, n in strings]


def least_count(counts: DataFrame, room: int) -> int:
    """The least count that at most ``room`` names reach."""
    least = 1 << 62
    for n, many in ((r["n"], r["count"]) for r in counts.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator()):
        room -= many
        if room < 0:
            break
        least = n
    return least


def fit(training: DataFrame, text_col: str = "text") -> tuple[Model, Tables]:
    """The model, and the tables for what it does not hold."""
    spark = training.sparkSession
    path = shared_path(spark, "lm-counts")
    gather(training, text_col).write.partitionBy("kind").parquet(path)
    counts = spark.read.schema("name long, n long, kind int").parquet(path)
    tokens, strings = (counts.where(F.col("kind") == kind).select("name", "n") for kind in (TOKENS, GRAMS))
    total, distinct = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("n")).first()
    ends = sum(r["n"] for r in counts.where(F.col("kind") == ENDS).collect())
    orders = Orders(strings)
    hot = tokens.where(F.col("n") >= least_count(tokens, HOT_TOKENS)).orderBy("name").toArrow()
    frequent = strings.where(F.col("n") >= least_count(strings, HOT_GRAMS))
    context = orders.contexts[ORDER].select(F.col("name").alias("c"), (F.col("total") + F.col("types")).alias("whole"))
    known = frequent.join(context, F.shiftright(frequent["name"], 8) == context["c"]).select(
        "name", F.log10(F.col("n") / F.col("whole")).cast("float").alias("cost")).toArrow()
    column = lambda t, name: t.column(name).to_numpy()
    return Model((column(known, "name"), column(known, "cost")), (column(hot, "name"), column(hot, "n")), ends,
                 total + ends, distinct + (ends > 0)), Tables(tokens, orders)


def score(docs: DataFrame, model: Model, tables: Tables, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns of ``keep``, n_tokens, n_known, train_tokens, base_score and score (log10)."""
    spark = docs.sparkSession
    shared, memo = spark.sparkContext.broadcast(model), f"lm-{uuid.uuid4()}"

    def make(texts: pa.Array):
        n_tokens, known, logs, ppm, *rest = worker_memo(memo, lambda: Scorer(shared.value)).scores(texts)
        lists = lambda parts: pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum([len(x) for x in parts])]), pa.int32()),
            pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)))
        return [pa.array(n_tokens), pa.array(known), pa.array(logs), pa.array(ppm), *map(lists, rest)]

    kept = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*[named(c).alias(k) for c, k in zip(keep, kept)], named(text_col).cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    found = map_texts(rows, "text", [*kept, "row"], make, "n long, known long, logs double, score double, "
                      "rare array<long>, rare_n array<long>, strings array<long>, strings_n array<long>")
    scored = stored(found, "lm-rows")
    each = lambda names: scored.select("row", F.explode(F.arrays_zip(F.col(names).alias("name"), F.col(f"{names}_n").alias("many"))).alias("t")).select(
        "row", "t.name", "t.many")

    rare = each("rare").join(tables.tokens, "name", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("many")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("many") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5))).alias("rare_logs"))
    strings = each("strings")
    costs = stored(tables.orders.costs(strings.select("name").distinct()), "lm-costs")
    strings = strings.join(costs, "name").groupBy("row").agg(F.sum(F.col("many") * F.col("cost")).alias("rare_score"))
    whole = scored.drop("rare", "rare_n", "strings", "strings_n").join(rare, "row", "left").join(strings, "row", "left")
    base = float(np.log10(model.tokens + 0.5 * (model.distinct + 1)))
    end = float(np.log10(model.ends + 0.5))
    n_tokens = F.col("n") + 1
    return whole.select(
        *[F.col(k).alias(c) for c, k in zip(keep, kept)], n_tokens.alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + int(model.ends > 0)).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) + end - n_tokens * base).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"))
