"""A prefix trie of conversations, and totals of its subtrees by centroid decomposition.

A node is a distinct sequence of the first d turns (role, text) of some conversations; its name is a
pair of 64-bit prefix sums of the turns' hashes, each times a power of an odd base. Prefix sums are
taken over range partitions of the turns, with the sums of the parts before carried over, so a
conversation of any length is spread over many tasks. A node's smallest conversation, count and
last text come from one aggregation by name.

Subtree totals (leaves, saved bytes) come from a centroid decomposition of the parent edges. In each
component a node's ``size`` is the number of the component's nodes below it, itself included.

* The nodes whose size is half of their component's or more form the path from the component's top to
  its centroid: of two such nodes one is above the other. The centroid is the deepest of them.
* Taking the centroid out splits the component: each of its children heads a component of its own,
  and what is above it stays one. No part holds more than half of the nodes.
* The values at and below the centroid are summed up; the sum is added to all nodes of the path. Two
  nodes, one above the other, stay together until a centroid between them (or one of the two) is taken
  out, so each value reaches each node above it once.
* The path's sizes fall by the centroid's size; all other sizes stay as they are.

Components of more than ``LOCAL`` nodes are split in rounds of joins over all of them at once, so the
number of rounds is the logarithm of the trie's size over LOCAL, however deep it is. A node finds the
child of the centroid that it lies below by its smallest conversation, which passes through that child.
Smaller components are then taken apart to the end inside tasks, many at a time. At the start, a node's
size follows from chains: the nodes that have the same smallest conversation are the end of that
conversation's path, so each conversation of a node adds the length of its own chain.

Lists of the conversations that end at a node are digested in order, from strings of up to
``LISTED`` ids each that are made before the shuffle; a digest is sequential by definition, so a node's
strings pass through one task, a few at a time.

Defined cases: rows with a null conversation id belong to no conversation and are left out; a null role or
text counts as empty; rows with equal turn numbers are ordered by role, then text (so repeated rows are
turns of their own); a conversation without any turn ends at the root; an empty table has no root and
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import named, ship_package
from kestrel.llm.graph import stored

#: larger components are split by joins, the others inside a task
LOCAL = 20_000
#: ids of one string of a node's list
LISTED = 10_000
#: odd multipliers of the two prefix sums
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponent modulo 2**64."""
    left, square = exponents.astype(np.uint64), base
    out = np.ones(len(left), np.uint64)
    while len(left) and left.max() > 0:
        out = np.where(left & np.uint64(1) == 1, out * np.uint64(square), out)
        left = left >> np.uint64(1)
        square = square * square % (1 << 64)
    return out


def running_sums(rows: DataFrame, key: str, spread: list, order: list, names: list[str], kinds: str,
                 terms: Callable[[pa.RecordBatch], list[np.ndarray]], keep: list[str], needs: list[str] = []) -> DataFrame:  # noqa: B006
    """``keep`` columns (of the types ``kinds``) and, for each name, the sum of the terms of the key's rows
    up to this one in the given order, modulo 2**64 as a long; ``before_<name>`` is the sum without this
    row's term. The first name's terms must be 1, so that it counts rows; ``needs`` are further columns that
    ``terms`` reads.

    Rows are range-partitioned by the key and ``spread`` (columns that ``order`` refines), so that a hot
    key has many tasks. The sums of each part are written; what a key that goes on from part to part has
    gathered before is added afterwards. Only such keys' sums, two for each part, go to the driver.
    """
    ship_package(rows.sparkSession)
    ordered = rows.repartitionByRange(F.col(key).asc_nulls_first(), *spread).sortWithinPartitions(F.col(key).asc_nulls_first(), *order)
    ordered = ordered.select(*keep, *needs)
    width, both = len(keep), [*names, *(f"before_{n}" for n in names)]
    schema = kinds + "".join(f", {n} long" for n in both) + ", part int"

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, carry = TaskContext.get().partitionId(), None, [np.uint64(0)] * len(names)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy()
            starts = np.concatenate([[0], 1 + np.flatnonzero(keys[1:] != keys[:-1])])
            lengths = np.diff(np.append(starts, len(keys)))
            sums, before = [], []
            for k, term in enumerate(terms(batch)):
                total = np.cumsum(term, dtype=np.uint64)
                base = total[starts] - term[starts]
                if keys[0] == last:
                    base[:1] -= carry[k]
                total -= np.repeat(base, lengths)
                sums.append(total)
                before.append(total - term)
                carry[k] = total[-1]
            last = keys[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(x.view(np.int64)) for x in (*sums, *before)]
                + [pa.array(np.full(len(keys), part, np.int32))], names=[*keep, *both, "part"])

    sums = stored(ordered.mapInArrow(local, schema), "sums")
    ends = sums.groupBy("part").agg(F.min(key).alias("least"), F.max(key).alias("most")).orderBy("part").collect()
    over = [(a, b) for a, b in zip(ends[:-1], ends[1:]) if a["most"] == b["least"]]
    if not over:
        return sums.drop("part")
    pieces = sorted({(r["part"], a["most"]) for a, b in over for r in (a, b)})
    few = rows.sparkSession.createDataFrame(pieces, f"part int, {key} {rows.schema[key].dataType.simpleString()}")
    last = sums.join(F.broadcast(few), ["part", key]).groupBy("part", key).agg(F.max_by(F.struct(*names), F.col(names[0])).alias("s"))
    gathered: dict[tuple[int, int], list[int]] = {}
    running: dict[int, list[int]] = {}
    for r in sorted(last.collect(), key=lambda r: (r[key], r["part"])):
        have = running.setdefault(r[key], [0] * len(names))
        gathered[r["part"], r[key]] = list(have)
        running[r[key]] = [(x + r["s"][n]) % (1 << 64) for x, n in zip(have, names)]
    shared = rows.sparkSession.sparkContext.broadcast(gathered)

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, keys = batch.column("part").to_numpy(), batch.column(key).to_numpy()
            columns = [batch.column(c).to_numpy().view(np.uint64).copy() for c in both]
            edges = np.concatenate([[0], 1 + np.flatnonzero((keys[1:] != keys[:-1]) | (parts[1:] != parts[:-1])), [len(keys)]]) if len(keys) else [0]
            for a, b in zip(edges[:-1], edges[1:]):
                extra = shared.value.get((int(parts[a]), int(keys[a])))
                if extra:
                    for column, x in zip(columns, extra * 2):
                        column[a:b] += np.uint64(x)
            yield pa.RecordBatch.from_arrays(batch.columns[:width] + [pa.array(c.view(np.int64)) for c in columns], names=[*keep, *both])

    return sums.mapInArrow(carried, schema.removesuffix(", part int"))


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv, pos, a, b, bytes): each turn's place in its conversation, from 1, two hashes of its role and
    text, and its text's bytes in UTF-8."""
    empty = F.lit("")
    rows = conversations.select(named(conv_col).cast("long").alias("conv"), named(turn_col).alias("turn"),
                                F.coalesce(named(role_col).cast("string"), empty).alias("role"),
                                F.coalesce(named(text_col).cast("string"), empty).alias("text")).where("conv is not null")
    rows = rows.select("*", F.xxhash64(F.lit(1), "role", "text").alias("a"), F.xxhash64(F.lit(2), "role", "text").alias("b"),
                       F.octet_length("text").cast("long").alias("bytes"))
    first = F.col("turn").asc_nulls_first()
    one = lambda batch: [np.ones(batch.num_rows, np.uint64)]
    return running_sums(rows, "conv", [first, "role", F.substring("text", 1, 32)], [first, "role", "text"], ["pos"],
                        "conv long, a long, b long, bytes long", one, ["conv", "a", "b", "bytes"]).drop("before_pos")


def spliced(turns: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that share their beginnings: conversation c begins with the first h turns of
    conversation c - c % every, with h the CRC-32 of c's decimal text modulo ``most``, and goes on with its
    own turns after its first h. Returns the turns (as ``turns`` gives them) and (conv, total), the number of
    turns of every conversation, 0 included."""
    turns = stored(turns, "turns")
    sizes = turns.groupBy("conv").agg(F.max("pos").alias("own"))
    plan = sizes.select("conv", "own", (F.crc32(F.col("conv").cast("string")) % most).alias("h"),
                        (F.col("conv") - F.pmod("conv", F.lit(every))).alias("donor"))
    theirs = sizes.select(F.col("conv").alias("donor"), F.col("own").alias("given"))
    plan = plan.join(theirs, "donor", "left").withColumn("k", F.least("h", F.coalesce("given", F.lit(0))).cast("long"))
    plan = stored(plan.select("conv", "donor", "h", "k", (F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("total")), "plan")
    what = ["a", "b", "bytes"]
    heads = turns.where(F.col("pos") < most).where(F.pmod("conv", F.lit(every)) == 0).select(F.col("conv").alias("donor"), "pos", *what)
    begun = plan.where("k > 0").join(heads, "donor").where("pos <= k").select("conv", "pos", *what)
    rest = turns.join(plan.select("conv", "h", "k"), "conv").where("pos > h")
    return begun.unionAll(rest.select("conv", (F.col("k") + F.col("pos") - F.col("h")).alias("pos"), *what)), plan.select("conv", "total")


class Trie:
    """The trie of conversations, given (conv, pos, a, b, bytes) rows with places from 1 and (conv, total)."""

    def __init__(self, turns: DataFrame, totals: DataFrame):
        self.spark, self.totals = turns.sparkSession, totals

        def terms(batch: pa.RecordBatch) -> list[np.ndarray]:
            at = batch.column("pos").to_numpy()
            hashed = [batch.column(c).to_numpy().view(np.uint64) * powers(base, at) for c, base in zip("ab", BASES)]
            return [np.ones(len(at), np.uint64), *hashed]

        sums = running_sums(turns.select("conv", "pos", "a", "b", "bytes"), "conv", ["pos"], ["pos"], ["n", "x", "y"],
                            "conv long, pos long, bytes long", terms, ["conv", "pos", "bytes"], ["a", "b"])
        #: a row per conversation and turn: the node (x, y) and its parent (px, py)
        self.steps = stored(sums.select("conv", "pos", "bytes", "x", "y", F.col("before_x").alias("px"), F.col("before_y").alias("py")), "steps")

    def nodes(self) -> DataFrame:
        """x, y, px, py, conv, depth, n_convs, bytes, n_children, parent_conv and size of every node; the
        root is (0, 0)."""
        inner = self.steps.groupBy("x", "y").agg(F.min("px").alias("px"), F.min("py").alias("py"), F.min("conv").alias("conv"),
                                                 F.min("pos").alias("depth"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"))
        zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
        root = self.totals.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
            zero.alias("x"), zero.alias("y"), none.alias("px"), none.alias("py"), "conv", zero.alias("depth"), "n_convs", zero.alias("bytes"))
        nodes = stored(inner.unionByName(root), "nodes")
        children = nodes.groupBy(F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count(F.lit(1)).alias("n_children"))
        above = nodes.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv").alias("parent_conv"))
        chains = nodes.groupBy("conv").agg(F.count(F.lit(1)).alias("chain"), F.max("depth").alias("last"))
        weights = self.steps.select("conv", "x", "y").join(chains.select("conv", "chain"), "conv").groupBy("x", "y").agg(
            F.sum("chain").alias("all"))
        found = nodes.join(children, ["x", "y"], "left").join(weights, ["x", "y"], "left").join(chains, "conv")
        found = found.withColumn("size", F.when(F.col("depth") == 0, F.lit(nodes.count())).otherwise(
            F.col("all") - F.col("chain") + F.col("last") - F.col("depth") + 1))
        found = found.join(above, ["px", "py"], "left")
        return found.select("x", "y", "px", "py", "conv", "depth", "n_convs", "bytes",
                            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "parent_conv", F.col("size").cast("long"))

    def rolled(self, nodes: DataFrame, values: list[str]) -> DataFrame:
        """The nodes, with ``sum_<value>`` over the subtree of each (itself included)."""
        sums = [f"sum_{v}" for v in values]
        live = nodes.select("*", F.lit(0).cast("long").alias("cx"), F.lit(0).cast("long").alias("cy"),
                            *[F.lit(0).cast("long").alias(s) for s in sums])
        live = stored(live, "live")
        columns, rest = live.columns, []
        comp, head = ["cx", "cy"], (F.col("x") == F.col("cx")) & (F.col("y") == F.col("cy"))
        while True:
            # as many as nodes / LOCAL at the utmost
            large = live.where(head).where(F.col("size") > LOCAL).select(*comp, F.col("size").alias("whole"))
            large = stored(large, "large")
            if large.isEmpty():
                break
            rest.append(live.join(F.broadcast(large.select(*comp)), comp, "left_anti"))
            now = live.join(F.broadcast(large), comp).withColumn("path", 2 * F.col("size") >= F.col("whole"))
            best = F.max_by(F.struct("x", "y", "depth", "size"), "depth").alias("c")
            centroids = now.where("path").groupBy(*comp).agg(best).select(
                *comp, F.col("c.x").alias("mx"), F.col("c.y").alias("my"), F.col("c.depth").alias("m_depth"), F.col("c.size").alias("m_size"))
            centroids = stored(centroids, "centroids")
            # the child of the centroid on each conversation that passes through both
            through = self.steps.join(F.broadcast(centroids.select(F.col("mx").alias("px"), F.col("my").alias("py"))), ["px", "py"])
            through = through.select("conv", F.col("px").alias("mx"), F.col("py").alias("my"), F.col("x").alias("nx"), F.col("y").alias("ny"))
            now = now.join(F.broadcast(centroids), comp)
            low = now.where(F.col("depth") > F.col("m_depth")).join(through, ["conv", "mx", "my"], "left")
            high = now.where(F.col("depth") <= F.col("m_depth")).withColumns({c: F.lit(None).cast("long") for c in ("nx", "ny")})
            placed = low.unionByName(high).withColumn("taken", (F.col("x") == F.col("mx")) & (F.col("y") == F.col("my")))
            placed = stored(placed.drop("whole"), "placed")
            totals = placed.where(F.col("taken") | F.col("nx").isNotNull()).groupBy(*comp).agg(*[F.sum(v).alias(f"all_{v}") for v in values])
            placed = placed.join(F.broadcast(totals), comp)
            after = placed.withColumns(
                {s: F.when(F.col("path"), F.col(s) + F.col(f"all_{v}")).otherwise(F.col(s)) for s, v in zip(sums, values)}
                | {"size": F.when(F.col("path") & ~F.col("taken"), F.col("size") - F.col("m_size")).otherwise(F.col("size")),
                   "cx": F.coalesce("nx", "cx"), "cy": F.coalesce("ny", "cy")})
            after = stored(after.select(*columns, "taken"), "live")
            rest.append(after.where("taken").select(*columns).withColumns({"cx": F.lit(None).cast("long"), "cy": F.lit(None).cast("long")}))
            live = after.where("not taken").select(*columns)
        rest.append(live)
        out = rest[0]
        for part in rest[1:]:
            out = out.unionByName(part)
        return self.finished(out, values).drop("cx", "cy")

    def finished(self, live: DataFrame, values: list[str]) -> DataFrame:
        """Components of at most LOCAL nodes taken apart inside tasks (a null component is done)."""
        ship_package(self.spark)
        done = live.where("cx is null")
        live = live.where("cx is not null").repartition("cx", "cy").sortWithinPartitions("cx", "cy", "depth")
        columns, at = live.columns, [live.columns.index(f"sum_{v}") for v in values]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []

            def result() -> Iterator[pa.RecordBatch]:
                whole = pa.Table.from_batches(held).combine_chunks()
                added = subtree_sums(whole, values)
                arrays = list(whole.columns)
                for k, extra in zip(at, added):
                    arrays[k] = pa.array(arrays[k].to_numpy() + extra)
                yield from pa.Table.from_arrays(arrays, names=columns).to_batches()

            for batch in batches:
                if not batch.num_rows:
                    continue
                cx, cy = batch.column("cx").to_numpy(), batch.column("cy").to_numpy()
                # all but the last component of the batch are complete
                last = int(np.flatnonzero((cx != cx[-1]) | (cy != cy[-1]))[-1]) + 1 if (cx != cx[-1]).any() or (cy != cy[-1]).any() else 0
                if held and (last or (held[-1].column("cx")[0].as_py(), held[-1].column("cy")[0].as_py()) != (cx[0], cy[0])):
                    if last:
                        held.append(batch.slice(0, last))
                        batch = batch.slice(last)
                    yield from result()
                    held = []
                elif last:
                    held = [batch.slice(0, last)]
                    yield from result()
                    held, batch = [], batch.slice(last)
                held.append(batch)
            if held:
                yield from result()

        return live.mapInArrow(run, live.schema).unionByName(done)

    def ends(self) -> DataFrame:
        """(x, y, ends_sha256) of the nodes where conversations end: the SHA-256 of their ids as decimal text,
        ascending and joined by commas."""
        ship_package(self.spark)
        last = self.steps.join(self.totals, "conv").where("pos = total").select("x", "y", "conv")
        zero = F.lit(0).cast("long")
        last = last.unionAll(self.totals.where("total = 0").select(zero.alias("x"), zero.alias("y"), "conv"))
        ordered = last.repartitionByRange("x", "y", "conv").sortWithinPartitions("x", "y", "conv")

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y, conv = (batch.column(c).to_numpy() for c in ("x", "y", "conv"))
                cuts = np.union1d(np.flatnonzero((x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1, np.arange(0, len(x), LISTED)).astype(np.int64)
                if len(x):
                    texts = [",".join(map(str, part.tolist())) for part in np.split(conv, cuts[1:])]
                    yield pa.RecordBatch.from_arrays([pa.array(x[cuts]), pa.array(y[cuts]), pa.array(conv[cuts]), pa.array(texts)],
                                                     names=["x", "y", "conv", "ids"])

        strings = ordered.mapInArrow(listed, "x long, y long, conv long, ids string")
        strings = strings.repartition("x", "y").sortWithinPartitions("x", "y", "conv")

        def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, digest, out = None, None, []
            for batch in batches:
                for x, y, ids in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), batch.column("ids")):
                    if (x, y) == now:
                        digest.update(b",")
                    else:
                        if now is not None:
                            out.append((*now, digest.hexdigest()))
                        now, digest = (x, y), hashlib.sha256()
                    digest.update(ids.as_py().encode())
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["x", "y", "ends_sha256"])
                    out = []
            if now is not None:
                last = (*now, digest.hexdigest())
                yield pa.RecordBatch.from_arrays([pa.array([c]) for c in last], names=["x", "y", "ends_sha256"])

        return strings.mapInArrow(digested, "x long, y long, ends_sha256 string")


def subtree_sums(rows: pa.Table, values: list[str]) -> list[np.ndarray]:
    """For whole components sorted by component and depth: what their own nodes add to the sums of each
    node, by taking centroids out until nothing is left."""
    n = rows.num_rows
    names = list(zip(rows["x"].to_pylist(), rows["y"].to_pylist()))
    heads = list(zip(rows["cx"].to_pylist(), rows["cy"].to_pylist()))
    number = {name: i for i, name in enumerate(names)}
    parents = [-1 if name == head else number[p]
               for name, head, p in zip(names, heads, zip(rows["px"].to_pylist(), rows["py"].to_pylist()))]
    children: list[list[int]] = [[] for _ in range(n)]
    size = [1] * n
    for i in range(n - 1, -1, -1):  # children come after their parents
        if parents[i] >= 0:
            size[parents[i]] += size[i]
            children[parents[i]].append(i)
    worth = [rows[v].to_pylist() for v in values]
    sums = [[0] * n for _ in values]
    taken = [False] * n
    tops = [i for i in range(n) if parents[i] < 0]
    while tops:
        top = tops.pop()
        whole, path = size[top], [top]
        while True:  # down to the deepest node that holds half of the component
            below = next((c for c in children[path[-1]] if not taken[c] and 2 * size[c] >= whole), None)
            if below is None:
                break
            path.append(below)
        centroid = path[-1]
        part = [centroid]
        for i in part:  # grows while it is read
            part += [c for c in children[i] if not taken[c]]
        for total, worths in zip(sums, worth):
            amount = sum(worths[i] for i in part)
            for i in path:
                total[i] += amount
        for i in path[:-1]:
            size[i] -= size[centroid]
        taken[centroid] = True
        tops += [c for c in children[centroid] if not taken[c]]
        if centroid != top:
            tops.append(top)
    return [np.array(s, np.int64) for s in sums]


def build(turns: DataFrame, totals: DataFrame) -> DataFrame:
    """A row per node: conv (its smallest conversation), depth, parent_conv, n_convs, n_children, n_leaves,
    saved (what storing shared turns once saves in its subtree, in bytes) and ends_sha256."""
    trie = Trie(turns, totals)
    nodes = trie.nodes().withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn(
        "worth", (F.col("n_convs") - 1) * F.col("bytes"))
    nodes = trie.rolled(nodes, ["leaf", "worth"])
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(trie.ends(), ["x", "y"], "left").select(
        "conv", "depth", "parent_conv", "n_convs", "n_children", F.col("sum_leaf").alias("n_leaves"), F.col("sum_worth").alias("saved"),
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
