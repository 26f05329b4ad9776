"""Jaccard self join of documents' sets of word n-grams, by prefix trees.

A document's set holds its distinct 4-word shingles as 64-bit hashes. All sets are written in one
global order, rare shingles first: by the counts of their words, so that shingles of rare words come
first; shingles that many rows hold come last, by their counted rows. (The order changes the work, never
the result, so its counts need not be exact: they are summed up over blocks of rows, and words or shingles
that stand out in no block count as rare.) Two sets of similarity 0.85 or more then share one of their first
shingles, of which a set of n has n - ceil(0.85 n) + 1. So the texts that hold a shingle in front make up a
group, and the groups are joined on their own, each by a prefix tree of its sets:

* The sets, in lexicographic order of their shingles' places, are the leaves of the tree; sets that
  begin alike share the nodes of their common beginning.
* The tree is walked from the top. A node carries the overlap of its shingles with every other set of
  the group, counted once for all sets below. A subtree is left when no set can reach the required
  overlap even if all the remaining shingles below match, or when all sets that still could are already
  in one component with the sets below.
* A leaf's overlaps are exact; they are the links.

Before that, candidates are narrowed down without texts. A member of a group stays only if another
member may reach the required overlap with all the shingles behind the common one, and if the two sets'
sketches allow it: a sketch has a bit for the parity of the shingles of each hash value, so two sets differ in at
least as many shingles as their sketches do in bits. Then the shingles in front alone are joined: the texts that may be similar by what they share in front and by what is left
behind make up families. Each family goes to one task with its texts, once; a family of more than ``GROUP``
texts is joined by its tokens. ``group_join`` says in which rounds groups are joined, so that large ones are
split and no pair that is not yet connected is left out.

Equal texts are one text from the start. Tables that later steps read again are written to the folder of
``spark.checkpoint.dir``.

Defined cases: a text without words (or null) has an empty set and is linked with nothing, not even with
its copies; a text of one to three words has one shingle, all its words; rows with equal texts and a
word are linked; a null id takes part, and a component without any other id has a null component_id;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import group_join
from kestrel.llm.arrow_text import byte_view, map_texts, named, pieces, ship_package, text_column, worker_memo
from kestrel.llm.byte_words import TOKEN, window_hashes, word_bounds, word_hashes
from kestrel.llm.graph import BROADCAST_ROWS, sized, stored
from kestrel.llm.group_join import GroupJoin, shared_members
from kestrel.llm.near_dup import text_key

WIDTH = 4
#: two sets link at an overlap of SIMILAR hundredths of their union
SIMILAR = 85
#: shingles in this share of a block's rows are put last in the order, and words of this share of a block's
#: words count by their frequency. There are at most (mean shingles per text) / (OFTEN / 2) and
#: 1 / (WORD_SHARE / 2) of them, whatever the number of rows.
OFTEN, WORD_SHARE = 0.005, 0.00002
BLOCK_ROWS, BLOCK_SHINGLES = 4000, 4_000_000
WORDS, SHINGLES, ROWS, ALL_WORDS = 0, 1, 2, 3
#: groups of texts without their texts may be so many times as large as others
FRONTS = 3
#: a matrix of overlaps has so many bytes
MATRIX_BYTES = 32 << 20
#: a sketch has 64 bits at least, and so many times as many at most; tokens of more rows are not narrowed by sketches
SKETCH_WORDS, SKETCH_ROWS = 32, 20_000


def text_sets(texts: pa.Array, rarity: Rarity | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """The distinct shingles of each text, ascending, and the rarity of each (without one, the words'
    hashes of the text instead)."""
    flat, offsets = byte_view(texts)
    starts, ends, of_text = word_bounds(flat, offsets, TOKEN)
    words = word_hashes(flat, starts, ends)
    windows = window_hashes(words, WIDTH)
    if rarity:
        sums = np.concatenate([[0], np.cumsum(rarity.of(words))])
    out = []
    for first, last in zip(of_text[:-1].tolist(), of_text[1:].tolist()):
        if last - first >= WIDTH:
            found, at = np.unique(windows[first:last - WIDTH + 1], return_index=True)
            size = WIDTH
        elif last > first:
            # fewer words make another kind of shingle: its number of words is part of its hash
            size = last - first
            found, at = window_hashes(words[first:last], size) ^ np.uint64(size), np.zeros(1, np.int64)
        else:
            found, at, size = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        out.append((found, sums[first + at + size] - sums[first + at] if rarity else words[first:last]))
    return out


class Rarity:
    """How rare a word is, as a whole number: thousands of its negative decimal logarithm of frequency. All
    words that stand out nowhere are equally rare."""

    def __init__(self, counts: dict[int, int], total: int):
        self.names = np.array(sorted(counts), np.int64).view(np.uint64)
        order = np.argsort(self.names)
        n = np.array([counts[k] for k in sorted(counts)], float)[order]
        self.names = self.names[order]
        least = int(-1000 * math.log10(WORD_SHARE / 4))
        self.values = np.append(np.minimum(np.round(-1000 * np.log10(n / max(total, 1))), least).astype(np.int64), least)

    def of(self, words: np.ndarray) -> np.ndarray:
        if not len(self.names):
            return np.full(len(words), self.values[-1])
        at = np.minimum(np.searchsorted(self.names, words), len(self.names) - 1)
        return self.values[np.where(self.names[at] == words, at, len(self.names))]


def frequencies(docs: DataFrame, text_col: str) -> tuple[dict[int, int], dict[int, int], int]:
    """(shingles that stand out in blocks of rows, with their rows there; words that stand out in blocks, with
    their counts there; number of all words), from one pass over all texts."""
    ship_package(docs.sparkSession)
    texts = docs.select(named(text_col).cast("string").alias("text"))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[np.ndarray] = []
        words: list[np.ndarray] = []
        size = 0

        def result():
            found, n = np.unique(np.concatenate(block), return_counts=True)
            often = n >= max(2, math.ceil(OFTEN / 2 * len(block)))
            every = np.concatenate(words)
            known, many = np.unique(every, return_counts=True)
            usual = many >= max(2, math.ceil(WORD_SHARE / 2 * len(every)))
            kinds = np.repeat([SHINGLES, WORDS, ROWS, ALL_WORDS], [often.sum(), usual.sum(), 1, 1]).astype(np.int32)
            names = np.concatenate([found[often].view(np.int64), known[usual].view(np.int64), [0, 0]])
            return pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(names), pa.array(
                np.concatenate([n[often], many[usual], [len(block), len(every)]]))], names=["kind", "name", "n"])

        for batch in batches:
            column = text_column(batch, "text")
            for start, stop in pieces(column):
                for found, own in text_sets(column.slice(start, stop - start)):
                    block.append(found)
                    words.append(own)
                    size += len(own)
                    if len(block) >= BLOCK_ROWS or size >= BLOCK_SHINGLES:
                        yield result()
                        block, words, size = [], [], 0
        if block:
            yield result()

    sums = stored(texts.mapInArrow(local, "kind int, name long, n long").groupBy("kind", "name").agg(F.sum("n").alias("n")), "frequencies")
    totals = {r["kind"]: r["n"] for r in sums.where(F.col("kind") >= ROWS).collect()}
    least = {SHINGLES: max(2, OFTEN / 2 * totals.get(ROWS, 0)), WORDS: max(2, WORD_SHARE / 2 * totals.get(ALL_WORDS, 0))}
    shingles, words = ({r["name"]: r["n"] for r in sums.where((F.col("kind") == kind) & (F.col("n") >= least[kind])).collect()}
                       for kind in (SHINGLES, WORDS))
    return shingles, words, totals.get(ALL_WORDS, 0)


class Order:
    """The global order of shingles: by counted rows, if those are many, then rare ones first, then by hash."""

    def __init__(self, counts: dict[int, int]):
        names = np.array(list(counts), np.int64).view(np.uint64)
        order = np.argsort(names)
        self.names = names[order]
        self.places = np.minimum(np.log2(1.0 + np.array(list(counts.values()))[order]), 15).astype(np.int64)

    def codes(self, found: np.ndarray, rarity: np.ndarray) -> np.ndarray:
        """A number per shingle that rises in the global order: 31 bits (counted rows, rarity, part of the hash)
        that are enough to compare texts by, and 32 more of the hash. Shingles of one number are told apart
        by their hashes; that is needed only for their order, since a shared number makes candidates, no links."""
        rows = np.zeros(len(found), np.int64)
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, found), len(self.names) - 1)
            rows = np.where(self.names[at] == found, self.places[at], 0)
        high = rows << 27 | (16383 - (rarity >> 1)) << 13 | (found >> np.uint64(51)).view(np.int64)
        return high << 32 | (found & np.uint64(0xFFFFFFFF)).view(np.int64)

    def sorted(self, found: np.ndarray, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions that put shingles into the global order, their codes in that order)."""
        codes = self.codes(found, rarity)
        at = np.lexsort((found, codes))
        return at, codes[at]


def in_front(n: int) -> int:
    """How many of the first shingles of a set of n are enough to meet every similar set."""
    return n - (SIMILAR * n + 99) // 100 + 1 if n else 0


def sketch(found: np.ndarray) -> bytes:
    """The parities of a set's shingles by 64 or more values of their hash, about half as many as shingles or more.
    Half of a sketch's words, added to the other half without carry, is the sketch of half the length."""
    bits = 64
    while 2 * bits < len(found) and bits < 64 * SKETCH_WORDS:
        bits *= 2
    at = (found * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.int64) & (bits - 1)
    return np.packbits(np.bincount(at, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


class Sketches:
    """The sketches of rows, each at its own length and at all shorter ones."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        flat, offsets = byte_view(column)
        lengths = np.diff(offsets) // 8
        self.level = np.log2(lengths).astype(np.int64)  # 2 ** level words
        self.rows, self.at = {}, {}
        longer, above = np.zeros(0, np.int64), None
        for level in range(int(self.level.max(initial=0)), -1, -1):
            own = np.flatnonzero(self.level == level)
            words = flat[offsets[own][:, None] + np.arange(8 << level)].view(np.uint64)
            if above is not None:
                words = np.concatenate([words, above[:, :1 << level] ^ above[:, 1 << level:]])
            longer, above = np.concatenate([own, longer]), words
            self.rows[level], self.at[level] = words, np.full(len(self.level), -1)
            self.at[level][longer] = np.arange(len(longer))

    def differ(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """In how many bits the sketches of rows x differ from those of rows y, pair by pair."""
        level, out = np.minimum(self.level[x], self.level[y]), np.zeros(len(x), np.int64)
        for one in np.unique(level).tolist():
            for part in np.array_split(np.flatnonzero(level == one), 1 + (len(x) << one) // (1 << 20)):
                both = self.rows[one][self.at[one][x[part]]] ^ self.rows[one][self.at[one][y[part]]]
                out[part] = np.bitwise_count(both).sum(1, dtype=np.int64)
        return out


def with_partner(token: np.ndarray, n: np.ndarray, at: np.ndarray, sketches: Sketches) -> np.ndarray:
    """Whether each row (in the order of token and n) has another one of its token that it may be similar to."""
    kept, rest = np.zeros(len(n), bool), n - at
    first, step = np.arange(len(n)), 0
    while len(first):
        step += 1
        first = first[first + step < len(n)]
        other = first + step
        # larger ones are too large for this row from here on
        first = first[(token[first] == token[other]) & (SIMILAR * n[other] <= 100 * n[first])]
        x, y = first, first + step
        both = n[x] + n[y]
        open_ = ~(kept[x] & kept[y]) & ((100 + SIMILAR) * np.minimum(rest[x], rest[y]) >= SIMILAR * both)
        x, y, both = x[open_], y[open_], both[open_]
        least = -(-SIMILAR * both // (100 + SIMILAR))
        good = sketches.differ(x, y) <= both - 2 * least
        kept[x[good]] = kept[y[good]] = True
    return kept


def join_group(sets: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, order: Order) -> np.ndarray:
    """New labels of the sets of a group (shingles, none empty, and their rarities): sets that were equal in
    ``labels``, or that links connect, are equal."""
    labels = labels.copy()
    n = len(sets)
    sizes = np.array([len(s) for s, _ in sets])
    found, at, inverse, holders = np.unique(np.concatenate([s for s, _ in sets]), return_index=True, return_inverse=True, return_counts=True)
    place = np.empty(len(found), np.int64)
    place[order.sorted(found, np.concatenate([r for _, r in sets])[at])[0]] = np.arange(len(found))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    rows = [np.sort(place[inverse[a:b]]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    by = sorted(range(n), key=lambda i: rows[i].astype(">u4").tobytes())
    rows, sizes, labels = [rows[i] for i in by], sizes[by], labels[by]
    shared = np.empty(n, np.int64)  # places that a set begins with as the one before it does
    shared[0] = 0
    for i in range(1, n):
        least = min(sizes[i - 1], sizes[i])
        differ = np.flatnonzero(rows[i - 1][:least] != rows[i][:least])
        shared[i] = differ[0] if len(differ) else least
    several = np.empty(len(found), bool)  # shingles of two sets or more, by place
    several[place] = holders > 1
    dense = np.cumsum(several) - 1
    rows_of = [(dense[r[several[r]]], np.concatenate([[0], np.cumsum(several[r])])) for r in rows]
    width = max(1, MATRIX_BYTES // max(1, int(several.sum())))
    for first in range(0, n, width):
        last = min(first + width, n)
        holds = np.zeros((int(several.sum()), last - first), np.uint8)
        for x in range(first, last):
            holds[rows_of[x][0], x - first] = 1
        labels = walk(rows_of, sizes, shared, labels, holds, first)
    out = np.empty(n, labels.dtype)
    out[by] = labels
    return out


def walk(rows_of: list, sizes: np.ndarray, shared: np.ndarray, labels: np.ndarray, holds: np.ndarray, first: int) -> np.ndarray:
    """Labels after the links of the sets numbered from ``first`` (the columns of ``holds``) with the
    sets before or among them (every pair meets once, below the later one of the two)."""
    n, width = len(sizes), holds.shape[1]
    own = np.arange(first, first + width)
    own_sizes = sizes[own]
    # sets low to high share their first places up to depth, which overlap the columns by over
    todo = [(first, n - 1, 0, np.zeros(width, np.int64))] if n > 1 else []
    while todo:
        low, high, depth, over = todo.pop()
        upto = int(shared[low + 1:high + 1].min()) if high > low else int(sizes[low])
        if upto > depth:
            dense, begun = rows_of[low]
            part = dense[begun[depth]:begun[upto]]
            if len(part):
                over = over + holds[part].sum(0, dtype=np.int64)
        longest = int(sizes[low:high + 1].max())
        near = (100 + SIMILAR) * (over + longest - upto) >= SIMILAR * (own_sizes + longest)
        near &= own < high
        if not near.any():
            continue
        below, theirs = labels[low:high + 1], labels[own[near]]
        if (below == below[0]).all() and (theirs == below[0]).all():
            continue
        if high > low:
            cuts = [low, *(low + 1 + np.flatnonzero(shared[low + 1:high + 1] == upto)).tolist(), high + 1]
            todo += [(a, b - 1, upto, over) for a, b in zip(cuts[:-1], cuts[1:])]
        else:
            same = np.unique(np.append(theirs, below))
            labels[np.isin(labels, same)] = same[0]
    return labels


def ordered(found: tuple[dict[int, int], dict[int, int], int]) -> tuple[Order, Rarity]:
    shingles, words, total = found
    return Order(shingles), Rarity(words, total)


class MovedOnce(GroupJoin):
    """A group join whose rows are large beside its tasks: few tasks go to the rows, so that the rows move
    once, to their tasks, and not before that to their keys."""

    def placed(self, tasks: DataFrame, labels: DataFrame, most: int | None) -> DataFrame:
        if most is None or most > BROADCAST_ROWS:
            tasks = stored(tasks, "tasks")
            most = tasks.count()
        return self.rows.join(sized(tasks, most), "key").join(sized(labels, self.n_keys), "key")


class Joiner:
    """The join over one table of rows with a text, ``key`` (the text's ``text_key``) and ``id``."""

    def __init__(self, rows: DataFrame):
        self.rows, self.spark = rows, rows.sparkSession
        self.shared = self.spark.sparkContext.broadcast(frequencies(rows, "text"))
        self.memo = f"ngrams-{uuid.uuid4()}"

    def signed(self) -> DataFrame:
        """id, key, n_shingles, front (the codes of the set's first shingles in the global order), and its sketch."""
        shared, memo = self.shared, self.memo

        def make(texts: pa.Array):
            order, rarity = worker_memo(memo, lambda: ordered(shared.value))
            sets = text_sets(texts, rarity)
            fronts = [order.sorted(found, rare)[1][:in_front(len(found))] for found, rare in sets]
            return [pa.array([len(s) for s, _ in sets], pa.int64()), pa.array(fronts, pa.list_(pa.int64())),
                    pa.array([sketch(s) for s, _ in sets], pa.binary())]

        return map_texts(self.rows, "text", ["id", "key"], make, "n_shingles long, front array<long>, sketch binary")

    def labels(self, signed: DataFrame) -> DataFrame:
        """(key, label) of every text that may be similar to another one; texts go by numbers in between."""
        nodes = signed.where("n_shingles > 0").select(F.col("key").alias("name"), "n_shingles", "front", "sketch").dropDuplicates(["name"])
        nodes = stored(nodes.withColumn("key", F.monotonically_increasing_id()), "nodes")
        members = stored(narrowed(stored(possible(nodes), "possible"), nodes), "narrowed")
        keys, n_keys = self.counted(members)
        if not n_keys:
            return signed.select("key", F.col("key").alias("label")).where("false")
        short = F.transform("front", lambda x: F.shiftright(x, 32).cast("int")).alias("front")
        heads = nodes.select("key", "n_shingles", short).join(sized(keys, n_keys), "key", "left_semi")
        families = MovedOnce([members.where("at = 0"), members], keys, n_keys, stored(heads, "heads"), connect_fronts,
                             FRONTS * group_join.GROUP).labels()

        # families of a task's size meet once, as a whole; larger ones by their tokens, which are each family's own
        sizes = families.groupBy("label").count().where("count > 1")
        sizes = stored(families.join(sizes, "label").select("key", "label", "count"), "families")
        small = sizes.where(F.col("count") <= group_join.GROUP).select(F.xxhash64("label").alias("token"), "key")
        large = members.join(sized(sizes.where(F.col("count") > group_join.GROUP), n_keys), "key").select(
            F.xxhash64("token", "label").alias("token"), "key", "at")
        large = shared_members(large)
        keys, n_keys = self.counted(sizes)
        names = stored(nodes.select("key", "name").join(sized(keys, n_keys), "key", "left_semi"), "names")
        texts = self.rows.select(F.col("key").alias("name"), "text").join(sized(names, n_keys), "name").dropDuplicates(["name"])
        texts = stored(texts.select("key", "text"), "texts")
        shared, memo = self.shared, self.memo

        def connect(rows: pa.RecordBatch, before: np.ndarray) -> np.ndarray:
            (order, rarity), column = worker_memo(memo, lambda: ordered(shared.value)), text_column(rows, "text")
            return join_group([s for a, b in pieces(column) for s in text_sets(column.slice(a, b - a), rarity)], before, order)

        # no family is in both parts of the first round
        labels = MovedOnce([small.unionAll(large.where("at = 0").select("token", "key")), large], keys, n_keys, texts, connect).labels()
        of = names.select(F.col("key").alias("label"), F.col("name").alias("label_name"))
        labels = labels.join(sized(names, n_keys), "key").join(sized(of, n_keys), "label")
        return labels.select(F.col("name").alias("key"), F.col("label_name").alias("label"))

    @staticmethod
    def counted(members: DataFrame) -> tuple[DataFrame, int]:
        keys = stored(members.select("key").distinct(), "keys")
        return keys, keys.count()


def possible(nodes: DataFrame) -> DataFrame:
    """(token, key, n, at, size): the shingles in front of each text (with the set's size, the shingle's place and texts)
    that another text has in front, too, and may be similar to if it is the first shingle that the two share:
    all shingles from there on together must be enough. Tokens of more than GROUP rows are kept whole."""
    # one long for size and place, since every shingle in front of every text is shuffled here
    place = F.shiftleft("n_shingles", 32).bitwiseOR(F.col("at").cast("long"))
    fronts = nodes.select("key", "n_shingles", F.posexplode("front").alias("at", "token")).select("token", "key", place.alias("place"))
    counts = fronts.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = stored(fronts.join(counts, "token"), "rows")  # read twice
    n, at = lambda r: F.shiftright(r["place"], 32), lambda r: r["place"].bitwiseAND(F.lit((1 << 32) - 1))
    rest = lambda r: n(r) - at(r)
    enough = lambda x, y: (100 + SIMILAR) * F.least(rest(x), rest(y)) >= SIMILAR * (n(x) + n(y))
    few = rows.where(F.col("size") <= group_join.GROUP).groupBy("token").agg(
        F.first("size").alias("size"), F.collect_list(F.struct("key", "place")).alias("rows"))
    kept = F.filter("rows", lambda x: F.exists("rows", lambda y: (x["key"] != y["key"]) & enough(x, y)))
    few = few.select("token", "size", F.explode(kept).alias("r")).select("token", "r.key", "r.place", "size")
    every = few.unionAll(rows.where(F.col("size") > group_join.GROUP).select("token", "key", "place", "size"))
    return every.select("token", "key", n(every).alias("n"), at(every).cast("int").alias("at"), "size")


def narrowed(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(token, key, at): the members that another member of their token may be similar to by sizes, places and
    sketches. Tokens of more than SKETCH_ROWS rows are kept whole."""
    ship_package(members.sparkSession)
    few = members.where(F.col("size") <= SKETCH_ROWS).join(nodes.select("key", "sketch"), "key").select("token", "key", "n", "at", "sketch")
    few = few.repartition("token").sortWithinPartitions("token", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(table: pa.Table) -> pa.RecordBatch:
            whole = table.combine_chunks().to_batches()[0]
            token, n, at = (whole.column(c).to_numpy().astype(np.int64) for c in ("token", "n", "at"))
            return whole.select(["token", "key", "at"]).filter(pa.array(with_partner(token, n, at, Sketches(whole.column("sketch")))))

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) >= SKETCH_ROWS:
                names = batch.column("token").to_numpy()
                cut = int(np.argmax(names == names[-1]))  # where the last token begins
                if cut or held[-2:-1] and held[-2].column("token")[-1].as_py() != names[0]:
                    ready = [*held[:-1], batch.slice(0, cut)]
                    yield result(pa.Table.from_batches(ready))
                    held = [batch.slice(cut)]
        if held:
            yield result(pa.Table.from_batches(held))

    few = few.mapInArrow(run, "token long, key long, at int")
    return few.unionAll(members.where(F.col("size") > SKETCH_ROWS).select("token", "key", "at"))


def connect_fronts(rows: pa.RecordBatch, labels: np.ndarray) -> np.ndarray:
    """New labels of a group's texts: those equal in ``labels``, and those that may be similar as far as their
    first shingles tell (what they share in front, and all that is left behind), are equal."""
    labels, sizes = labels.copy(), rows.column("n_shingles").to_numpy()
    fronts = [f.values.to_numpy() for f in rows.column("front")]
    n, lasts = len(fronts), np.array([f[-1] for f in fronts])
    # rows of a set that stand before the last one in front of another
    before = np.stack([np.searchsorted(f, lasts, side="left") for f in fronts])
    found, inverse, holders = np.unique(np.concatenate(fronts), return_inverse=True, return_counts=True)
    several = holders > 1
    dense = np.cumsum(several) - 1
    bounds = np.concatenate([[0], np.cumsum([len(f) for f in fronts])])
    own = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        at = inverse[a:b]
        own.append(np.unique(dense[at[several[at]]], return_counts=True))
    width = max(1, MATRIX_BYTES // (4 * max(1, int(several.sum()))))
    for first in range(0, n, width):
        last = min(first + width, n)
        held = np.zeros((int(several.sum()), last - first), np.int32)
        for x in range(first, last):
            held[own[x][0], x - first] = own[x][1]
        for y in range(first + 1, n):
            upto = min(y, last)
            near = np.flatnonzero(labels[first:upto] != labels[y])
            if not len(near):
                continue
            x = first + near
            shared = np.minimum(held[own[y][0]][:, near], own[y][1][:, None]).sum(0)
            most = shared + np.minimum(sizes[x] - before[x, y], sizes[y] - before[y, x])
            good = x[(100 + SIMILAR) * most >= SIMILAR * (sizes[x] + sizes[y])]
            if len(good):
                same = np.unique(np.append(labels[good], labels[y]))
                labels[np.isin(labels, same)] = same[0]
    return labels


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id column, n_shingles (the size of its set) and component_id (the least id that
    links reach from it)."""
    rows = docs.select(named(id_col).alias("id"), named(text_col).cast("string").alias("text"))
    rows = rows.withColumn("key", text_key(F.col("text")))
    joiner = Joiner(rows)
    signed = stored(joiner.signed(), "signed")
    labels = joiner.labels(signed)
    each = signed.where("n_shingles > 0").groupBy("key").agg(F.min("id").alias("least"))
    each = stored(each.join(labels, "key", "left").select("key", "least", F.coalesce("label", "key").alias("label")), "each")
    several = each.groupBy("label").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("texts")).where("texts > 1")
    each = each.join(several, "label", "left").select(
        "key", F.when(F.col("texts").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    return signed.select("id", "key", "n_shingles").join(each, "key", "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
