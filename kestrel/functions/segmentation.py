"""Words of running text (U1): the least-cost path through a lattice of lexicon words.

Japanese has no blanks between words, so a run of letters is a sentence, and part-of-speech rules need
its words. A lexicon gives surfaces with a part of speech, a base form and a cost. Every way to cut a run
into lexicon words and unknown words has a cost: those of its words, and those of each two neighbours
by their parts of speech, if such costs are given. The cheapest way is taken; of ways that cost the same,
that with fewer words, then that whose last word is longest, and so on back to the first one.

Where the lexicon has no word, a single character or the rest of a run of one class of characters
(hiragana, katakana, kanji, digits, other letters) is an unknown word of ``UNKNOWN`` plus ``PER_CHARACTER``
for each of its characters. Unknown words are nouns, as everywhere in the keyword rules.

The lexicon, in order of its surfaces, is dealt into blocks of at most ``TRIE_ROWS`` entries, each of which
tasks make into a trie and which are broadcast. Runs are cut in chunks of a bounded number of characters: each block
in turn is walked from those places of the chunk whose first characters lie in its range, so a further block
adds no work to the places of the others, and a task holds one block at a time. Then the lattices of the chunk's
runs are filled in, place by place, for as many runs at once as stay in a core's cache. Each distinct run of a group is cut once, however often it
occurs, where its counts are; no run is shuffled for its words.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from kestrel.functions.keywords import keyword_of, surface_ok, words
LEXICON_SCHEMA = StructType([StructField("surface", StringType()), StructField("pos", StringType()),
                             StructField("base_form", StringType()), StructField("cost", IntegerType())])
TOKEN = StructType([StructField("surface", StringType()), StructField("pos", StringType()), StructField("base_form", StringType())])
TOKENS = ArrayType(TOKEN)
#: a larger lexicon is broadcast in blocks of at most so many entries
TRIE_ROWS = 300_000
#: runs are cut in chunks of about so many characters for every eight blocks, and of at most so many times as many
CHUNK, CHUNKS = 100_000, 20
#: the lattices of runs of about so many characters are filled in at once
PIECE = 100_000
UNKNOWN, PER_CHARACTER = 20_000, 1_000

Connections = dict[tuple[str, str], int]


def character_class(c: str) -> int:
    """1 hiragana, 2 katakana, 3 kanji, 4 digits, 0 any other letter."""
    if "ぁ" <= c <= "ゟ":
        return 1
    if "ァ" <= c <= "ヿ" or "ｦ" <= c <= "ﾟ":
        return 2
    if "㐀" <= c <= "鿿" or c == "々":
        return 3
    return 4 if "0" <= c <= "9" else 0


class Lattice:
    """The lexicon as a trie, kept as a table of the prefixes of its surfaces: the entry (cost, part of speech,
    base form) of a prefix that is a word, None of the others."""

    def __init__(self, entries: Iterable[tuple[str, str, str, int]], connections: Connections | None = None):
        words: dict[str, tuple[int, str, str]] = {}
        for surface, pos, base, cost in entries:
            if surface and cost is not None:
                entry = (cost, pos or "", base or surface)
                words[surface] = min(entry, words.get(surface, entry))
        self.prefixes: dict[str, tuple[int, str, str] | None] = {w[:i]: None for w in words for i in range(1, len(w))}
        self.prefixes.update(words)
        self.connections = connections or {}
        self.classes: dict[str, int] = {}

    def class_ends(self, run: str) -> list[int]:
        """Where the stretch of one class of characters ends that each place lies in."""
        for c in set(run).difference(self.classes):
            self.classes[c] = character_class(c)
        kinds = [self.classes[c] for c in run]
        ends = [len(run)] * len(run)
        for i in range(len(run) - 2, -1, -1):
            ends[i] = ends[i + 1] if kinds[i] == kinds[i + 1] else i + 1
        return ends

    def starting(self, run: str, at: int, class_end: int) -> list[tuple[int, int, tuple | None]]:
        """(end, cost, entry) of each word that may start there, known ones (of a surface that may also be
        unknown, if they cost no more) before the unknown ones, whose entry is None."""
        prefixes, found, end, n = self.prefixes, [], at + 1, len(run)
        part = run[at:end]
        while part in prefixes:
            entry = prefixes[part]
            if entry is not None:
                found.append((end, entry[0], entry))
            if end == n:
                break
            end += 1
            part = run[at:end]
        found.append((at + 1, UNKNOWN + PER_CHARACTER, None))
        if class_end > at + 1:
            found.append((class_end, UNKNOWN + PER_CHARACTER * (class_end - at), None))
        return found

    def cut(self, run: str) -> list[dict]:
        """The words of the cheapest path."""
        return self.connected(run) if self.connections else self.plain(run)

    def plain(self, run: str) -> list[dict]:
        n = len(run)
        # starts rise, so of equal ways to a place the first one found has the longest last word
        cost, count, start, entries = [0] + [None] * n, [0] * (n + 1), [0] * (n + 1), [None] * (n + 1)
        for at, class_end in enumerate(self.class_ends(run)):
            so_far, many = cost[at], count[at] + 1
            for end, more, entry in self.starting(run, at, class_end):
                total, have = so_far + more, cost[end]
                if have is None or total < have or (total == have and many < count[end]):
                    cost[end], count[end], start[end], entries[end] = total, many, at, entry
        found = []
        while n:
            found.append(self.word(run[start[n]:n], entries[n]))
            n = start[n]
        return found[::-1]

    def connected(self, run: str) -> list[dict]:
        n = len(run)
        # per place and class of the word before it: (cost, words, start, class before that, entry)
        best: list[dict[str, tuple]] = [{} for _ in range(n + 1)]
        best[0][""] = (0, 0, 0, "", None)
        for at, class_end in enumerate(self.class_ends(run)):
            for end, more, entry in self.starting(run, at, class_end):
                kind = entry[1].split(",")[0] if entry else ""
                cost, count, before = min((b[0] + more + self.connections.get((k, kind), 0), b[1] + 1, k) for k, b in best[at].items())
                have = best[end].get(kind)
                if have is None or (cost, count, at, before) < have[:4]:
                    best[end][kind] = (cost, count, at, before, entry)
        found = []
        kind = min(best[n], key=lambda k: best[n][k][:4])
        while n:
            _, _, start, before, entry = best[n][kind]
            found.append(self.word(run[start:n], entry))
            n, kind = start, before
        return found[::-1]

    @staticmethod
    def word(surface: str, entry: tuple | None) -> dict:
        return {"surface": surface, "pos": entry and entry[1], "base_form": entry and entry[2]}


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(the characters of all texts as numbers, where each text begins, and the end)."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32)
    return flat, np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])


def first_three(flat: np.ndarray, places: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for up to three characters from each place on (to its end), in the order of the strings."""
    out = np.zeros(len(places), np.int64)
    for i in range(3):
        inside = places + i < ends
        out = out << 21 | np.where(inside, flat[np.minimum(places + i, len(flat) - 1)] + 1, 0) if len(flat) else out
    return out


class Trie:
    """A block of lexicon entries of distinct, ascending surfaces: the children of its nodes in a hash table by (node,
    character), the costs, parts of speech and base forms by entry."""

    def __init__(self, surfaces: list[str], costs: np.ndarray, pos: pa.Array, base: pa.Array):
        self.costs, self.pos, self.base = costs, pos, base
        flat, bounds = code_points(surfaces)
        starts, sizes = bounds[:-1], np.diff(bounds)
        node, alive, depth, keys, entry = np.zeros(len(surfaces), np.int64), np.arange(len(surfaces)), 0, [], {}
        n = 0
        while len(alive):
            found, inverse = np.unique(node[alive] << 21 | flat[starts[alive] + depth], return_inverse=True)
            keys.append(found)
            node[alive] = n + 1 + inverse
            n += len(found)
            depth += 1
            alive = alive[sizes[alive] > depth]
        #: the node of key i is i + 1; node 0 is the root
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.entry = np.full(n + 1, -1, np.int32)
        self.entry[node] = np.arange(len(surfaces))
        self.bits = max(4, (2 * n + 1).bit_length())
        self.table = np.full(1 << self.bits, -1, np.int32)
        at, pending = self.slots(self.keys), np.arange(n)
        while len(pending):
            free = pending[self.table[at[pending]] < 0]
            self.table[at[free]] = free
            pending = pending[self.table[at[pending]] != pending]
            at[pending] = at[pending] + 1 & len(self.table) - 1
        # the range of the block, and those of the strings that begin with its words of one and two characters
        threes = first_three(flat, starts, bounds[1:])
        short = np.maximum(0, 3 - sizes)
        few = short > 0
        ranges = np.concatenate([np.stack([threes, threes + (np.int64(1) << 21 * short)], 1)[few],
                                 [[threes[0], threes[-1] + 1]] if len(threes) else np.zeros((0, 2), np.int64)]).astype(np.int64)
        #: those that do not overlap, ascending
        ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
        upto = np.maximum.accumulate(ranges[:, 1])
        first = np.flatnonzero(np.concatenate([[True], ranges[1:, 0] > upto[:-1]])) if len(ranges) else np.zeros(0, np.int64)
        self.ranges = np.stack([ranges[first, 0], np.maximum.reduceat(ranges[:, 1], first) if len(first) else first], 1)

    @classmethod
    def of(cls, state: dict) -> Trie:
        """The trie whose ``vars`` these are: only plain values travel, so executors need no module of ours."""
        trie = cls.__new__(cls)
        vars(trie).update(state)
        return trie

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def children(self, nodes: np.ndarray, characters: np.ndarray) -> np.ndarray:
        """The node below each node by each character, 0 if there is none."""
        keys = nodes << 21 | characters
        at, out, open_ = self.slots(keys), np.zeros(len(keys), np.int64), np.arange(len(keys))
        while len(open_):
            found = self.table[at[open_]]
            taken = found >= 0
            open_, found = open_[taken], found[taken]
            same = self.keys[found] == keys[open_]
            out[open_[same]] = found[same] + 1
            open_ = open_[~same]
            at[open_] = at[open_] + 1 & len(self.table) - 1
        return out

    def places(self, threes: np.ndarray) -> np.ndarray:
        """Which of the ascending ``threes`` may begin a word of the block."""
        return np.concatenate([np.arange(a, b) for a, b in np.searchsorted(threes, self.ranges).tolist()] or [np.zeros(0, np.int64)])

    def words(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, entry) of the words that begin at the starts, whose runs end at ``ends``."""
        out, nodes, at = [], np.zeros(len(starts), np.int64), starts
        while len(starts):
            nodes = self.children(nodes, flat[at])
            at = at + 1
            entries = self.entry[nodes]
            known = np.flatnonzero((nodes > 0) & (entries >= 0))
            out.append((starts[known], at[known], entries[known]))
            on = np.flatnonzero((nodes > 0) & (at < ends))
            nodes, at, starts, ends = nodes[on], at[on], starts[on], ends[on]
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*out) if out else [()] * 3))


def cut_chunk(runs: list[str], tries: Iterable[Trie], n_tries: int, connections: Connections | None) -> tuple[np.ndarray, pa.Array, pa.Array, pa.Array]:
    """(number of the run, surface, part of speech, base form) of each word of the runs, in order."""
    flat, bounds = code_points(runs)
    sizes = np.diff(bounds)
    of = np.repeat(np.arange(len(runs), dtype=np.int32), sizes)
    every, ends = np.arange(len(flat), dtype=np.int32), np.repeat(bounds[1:].astype(np.int32), sizes)
    if n_tries > 1:
        threes = first_three(flat, every, ends)
        by = np.argsort(threes).astype(np.int32)
        threes = threes[by]
    found, pos, base, n_entries = [], [], [], 0
    for trie in tries:
        starts = by[trie.places(threes)] if n_tries > 1 else every
        starts, stops, entries = trie.words(flat, starts, ends[starts])
        used, entries = np.unique(entries, return_inverse=True) if n_tries > 1 else (np.arange(len(trie.costs)), entries)
        found.append((starts, stops, (entries + n_entries).astype(np.int32), trie.costs[used][entries]))
        n_entries += len(used)
        pos.append(trie.pos.take(pa.array(used)))
        base.append(trie.base.take(pa.array(used)))
    starts, stops, entries, costs = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 4
    pos, base = pa.chunked_array(pos, pa.string()).combine_chunks(), pa.chunked_array(base, pa.string()).combine_chunks()
    joined = "".join(runs)
    if connections:
        return cut_connected(runs, of[starts], [joined[a:b] for a, b in zip(starts.tolist(), stops.tolist())],
                             pos.take(pa.array(entries)).to_pylist(), base.take(pa.array(entries)).to_pylist(), costs.tolist(), connections)
    at, entry = least_cuts(flat, bounds, of, starts, stops, entries, costs)
    index = pa.array(entry, mask=entry < 0)
    # the words follow one another without a gap, so the runs' own text is that of the words
    width = np.concatenate([[0], np.cumsum(1 + (flat >= 0x80) + (flat >= 0x800) + (flat >= 0x10000), dtype=np.int64)])
    offsets = width[np.append(at, len(flat))].astype(np.int32)
    surfaces = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(joined.encode()))
    return of[at], surfaces, pos.take(index), base.take(index)


def cut_connected(runs: list[str], of: np.ndarray, surfaces: list, pos: list, base: list, costs: list, connections: Connections):
    """As ``cut_chunk``, run by run, with costs of neighbours."""
    own: list[list[tuple]] = [[] for _ in runs]
    for i, entry in zip(of.tolist(), zip(surfaces, pos, base, costs)):
        own[i].append(entry)
    words = [Lattice(entries, connections).cut(run) for run, entries in zip(runs, own)]
    flat = [w for ws in words for w in ws]
    return (np.repeat(np.arange(len(runs)), [len(ws) for ws in words]),
            *(pa.array([w[name] for w in flat], pa.string()) for name in ("surface", "pos", "base_form")))


def least_cuts(flat, bounds, of, starts, stops, entries, costs) -> tuple[np.ndarray, np.ndarray]:
    """(start, entry or -1) of the words of the cheapest paths, ascending: ``Lattice.plain`` for many runs at once. The
    words given (start, end, entry, cost) are the known ones."""
    sizes = np.diff(bounds)
    longest = max(1, int(sizes.max(initial=0)))
    firsts = np.flatnonzero(np.diff(bounds[:-1] // PIECE, prepend=-1))  # the runs that pieces begin with
    lasts = np.append(firsts[1:], len(sizes))
    # (piece, place) of each place of the runs as one number, and of the words
    key = np.arange(len(flat)) + np.repeat(np.repeat(np.arange(len(firsts)) * longest, lasts - firsts) - bounds[:-1], sizes)
    key = key.astype(np.uint16 if len(firsts) * longest < 1 << 16 else np.int64)[starts]
    by = np.argsort(key, kind="stable")
    key = key[by]
    cuts = np.searchsorted(key, np.arange(len(firsts) + 1) * longest).tolist()
    found = []
    for i, (first, last) in enumerate(zip(firsts.tolist(), lasts.tolist())):
        mine, a, b = by[cuts[i]:cuts[i + 1]], int(bounds[first]), int(bounds[last])
        at, entry = least_cuts_of(flat[a:b], bounds[first:last + 1] - a, of[a:b] - first, key[cuts[i]:cuts[i + 1]].astype(np.int64) - i * longest,
                                  starts[mine] - a, stops[mine] - a, entries[mine], costs[mine])
        found.append((at + a, entry))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2


def least_cuts_of(flat, bounds, of, place, starts, stops, entries, costs) -> tuple[np.ndarray, np.ndarray]:
    """``least_cuts`` of a piece, place by place from the beginnings of its runs; the known words ascend by their places."""
    sizes = np.diff(bounds)
    letters, inverse = np.unique(flat, return_inverse=True)
    classes = np.array([character_class(chr(c)) for c in letters.tolist()], np.int8)[inverse]
    last = np.ones(len(flat), bool)  # the last place of a stretch of one class
    last[:-1] = (classes[1:] != classes[:-1]) | (of[1:] != of[:-1])
    class_ends = np.flatnonzero(last)[np.cumsum(last) - last] + 1 if len(flat) else np.zeros(0, np.int64)

    # a run of n characters has n + 1 places, so its places follow those of i other ones by i more
    cost = np.full(len(flat) + len(sizes), np.iinfo(np.int64).max // 2)
    count, start, word = np.zeros(len(cost), np.int64), np.zeros(len(cost), np.int64), np.full(len(cost), -1, np.int64)
    cost[bounds[:-1] + np.arange(len(sizes))] = 0

    def reach(begin: np.ndarray, end: np.ndarray, more: np.ndarray | int, entry: np.ndarray | None) -> None:
        shift = of[begin]
        total, many, to = cost[begin + shift] + more, count[begin + shift] + 1, end + shift
        better = np.flatnonzero((total < cost[to]) | ((total == cost[to]) & (many < count[to])))
        to = to[better]
        cost[to], count[to], start[to] = total[better], many[better], begin[better]
        word[to] = -1 if entry is None else entry[better]

    longest = int(sizes.max(initial=0))
    cuts = np.searchsorted(place, np.arange(longest + 1))
    long_first = np.argsort(-sizes, kind="stable")
    firsts, many = bounds[:-1][long_first], np.searchsorted(-sizes[long_first], -np.arange(longest), side="left")
    for p in range(longest):
        a, b = cuts[p], cuts[p + 1]
        reach(starts[a:b], stops[a:b], costs[a:b], entries[a:b])
        at = firsts[:many[p]] + p
        reach(at, at + 1, UNKNOWN + PER_CHARACTER, None)
        at = at[class_ends[at] > at + 1]
        reach(at, class_ends[at], UNKNOWN + PER_CHARACTER * (class_ends[at] - at), None)

    begins, found = np.zeros(len(flat), bool), np.zeros(len(flat), np.int64)  # of the word that begins at a place
    runs, end = np.flatnonzero(sizes > 0), bounds[1:][sizes > 0]
    while len(runs):
        begin = start[end + runs]
        begins[begin], found[begin] = True, word[end + runs]
        on = begin > bounds[runs]
        runs, end = runs[on], begin[on]
    begin = np.flatnonzero(begins)
    return begin, found[begin]


def lexicon_tries(lexicon: DataFrame, trie_rows: int) -> list[Broadcast]:
    """The lexicon's blocks, each built in a task and broadcast; of several entries of a surface the least stays."""
    entry = F.struct(F.col("cost").cast("int").alias("cost"), F.coalesce("pos", F.lit("")).alias("pos"),
                     F.coalesce(F.when(F.col("base_form") != "", F.col("base_form")), "surface").alias("base_form"))
    one = lexicon.where("length(surface) > 0 AND CAST(cost AS int) IS NOT NULL").groupBy("surface").agg(F.min(entry).alias("e"))
    rows = one.select("surface", "e.cost", "e.pos", "e.base_form").orderBy("surface")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tries(held: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
            while held.num_rows >= least:
                block = held.slice(0, trie_rows).combine_chunks()
                surface, cost, pos, base = (block.column(i).combine_chunks() for i in range(4))
                trie = Trie(surface.to_pylist(), cost.to_numpy().astype(np.int64), pos, base)
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(vars(trie))], pa.binary())], names=["trie"])
                held = held.slice(trie_rows)
            return held

        held = None
        for batch in batches:
            held = pa.Table.from_batches(([] if held is None else held.to_batches()) + [batch])
            held = yield from tries(held, trie_rows)
        if held is not None:
            yield from tries(held, 1)

    spark = lexicon.sparkSession
    return [spark.sparkContext.broadcast(pickle.loads(r["trie"])) for r in rows.mapInArrow(build, "trie binary").toLocalIterator(prefetchPartitions=True)]


def chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches again, in batches of runs of about ``most`` characters."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.utf8_length(batch.column("run")), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            before = int(ends[first - 1]) if first else 0
            upto = int(np.searchsorted(ends, before + most - size, side="left")) + 1
            held.append(batch.slice(first, upto - first))
            size += int(ends[min(upto, batch.num_rows) - 1]) - before
            first = upto
            if size >= most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def with_words(rows: DataFrame, lexicon: DataFrame, connections: Connections | None, trie_rows: int, as_list: bool) -> DataFrame:
    """``rows`` (with a column ``run``) with the words of their runs: one row for each word, without the run, or each
    row with the list of its words as ``tokens``."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    shared = lexicon_tries(lexicon, trie_rows)
    keep = rows.columns if as_list else [c for c in rows.columns if c != "run"]
    schema = StructType([rows.schema[c] for c in keep] + ([StructField("tokens", TOKENS)] if as_list else TOKEN.fields))

    def blocks() -> Iterator[Trie]:
        for block in shared:
            yield Trie.of(block.value)
            block.__dict__.pop("_value", None)  # a worker holds one block at a time

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, CHUNK * min(CHUNKS, -(-len(shared) // 8))):
            texts = [r or "" for r in batch.column("run").to_pylist()]
            of, *words = cut_chunk(texts, blocks(), len(shared), connections)
            if as_list:
                bounds = np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32)
                words = [pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(words, TOKEN.names))]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + words, names=schema.names)
            else:
                yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(of)) for c in keep] + words, names=schema.names)

    return rows.mapInArrow(run, schema)


def cut_runs(runs: DataFrame, lexicon: DataFrame, connections: Connections | None = None, trie_rows: int = TRIE_ROWS) -> DataFrame:
    """(run, tokens) for distinct ``run`` rows and a lexicon of LEXICON_SCHEMA's columns."""
    return with_words(runs.select("run"), lexicon, connections, trie_rows, as_list=True)


def segmented_keywords(df: DataFrame, text_col: str, group_cols: list[str], lexicon: DataFrame, pos_mode: str = "subclass",
                       connections: Connections | None = None, trie_rows: int = TRIE_ROWS,
                       count_name: str = "appearances") -> DataFrame:
    """Keyword appearances per group, as ``count_keywords`` gives them, for running text: every run of letters
    is cut into words, and the rules F3-F8 act on those."""
    runs = df.select(*group_cols, F.explode(words(F.col(text_col))).alias("run")).where("run <> ''")
    counted = runs.groupBy(*group_cols, "run").agg(F.count("*").alias("_n"))
    tokens = with_words(counted, lexicon, connections, trie_rows, as_list=False)
    per_word = tokens.groupBy(*group_cols, "surface", "pos", "base_form").agg(F.sum("_n").alias("_n"))
    keyword = keyword_of(F.col("surface"), F.col("pos"), F.col("base_form"), pos_mode)
    kept = per_word.where(surface_ok(F.col("surface"))).select(*group_cols, "_n", keyword.alias("keyword")).where("keyword IS NOT NULL")
    return kept.groupBy(*group_cols, "keyword").agg(F.sum("_n").cast("bigint").alias(count_name))
