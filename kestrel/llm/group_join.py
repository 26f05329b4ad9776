"""Components of texts under links that are found inside groups of texts.

Texts that may link share a token (a bucket of samples, a first shingle). The texts of a token make up a
group; the links inside a group are found in one task, by a function that is given the group's texts and
the components known so far, and returns the components after it. Groups are joined in rounds, with
the components so far known to the next one: by the tokens of each round in turn (those where most copies
meet first), then between the blocks of groups that are larger than ``GROUP`` and still hold several
components. There the members outside the largest component are put against all members, block
by block, so every pair of texts that are not yet connected meets, and the work follows the members that
are left over. Groups that hold one component are left alone, and equal member lists are joined once. No
group, list or pair is cut short, and no pair leaves its task: a group returns the edges of a spanning
forest of the components it connects, from the least of them to each other one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import ship_package
from kestrel.llm.graph import components, sized, stored

#: larger groups are joined in blocks of about so many texts
GROUP = 400

#: (rows of a group, number of the component of each row) -> numbers after the group's links, of which each
#: is that of one of the components that it joins
Connect = Callable[[pa.RecordBatch, np.ndarray], np.ndarray]


def shared_members(tokens: DataFrame) -> DataFrame:
    """The rows of ``tokens`` whose token has two rows or more, written."""
    several = tokens.groupBy("token").count().where("count > 1").select("token")
    return stored(tokens.join(several, "token"), "members")


class GroupJoin:
    """The join of (token, key) members, in the rounds given; ``rows`` has a row per key, with the columns
    that ``connect`` reads. ``group`` (GROUP, if not given) is the size beyond which groups are split."""

    def __init__(self, rounds: list[DataFrame], keys: DataFrame, n_keys: int, rows: DataFrame, connect: Connect, group: int | None = None):
        self.rounds, self.group = [r.select("token", "key") for r in rounds], group or GROUP
        self.keys, self.n_keys, self.rows, self.connect = keys, n_keys, rows, connect

    def labels(self) -> DataFrame:
        """(key, label) of every key: the least key of its component."""
        labels = self.keys.select("key", F.col("key").alias("label"))
        large = []
        for members in self.rounds:
            mixed = self.mixed(members, labels)
            n_rows = mixed.count()
            if n_rows:
                # only these may hold several components later on
                large.append(mixed.where(F.col("size") > self.group).select("token", "key"))
                labels = self.merged(labels, self.joined(self.lists(mixed), labels, n_rows))
        for members in large:
            if members.isEmpty():
                continue
            mixed = self.mixed(members, labels)
            if not mixed.isEmpty():
                labels = self.merged(labels, self.joined(self.blocks(mixed), labels))
        return labels

    def mixed(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """The members of the tokens that hold several components: token, key, label, and the token's
        number of members, as ``size``."""
        now = members.join(sized(labels, self.n_keys), "key")
        tokens = now.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("x"), F.max("label").alias("y"))
        return stored(now.join(tokens.where("x <> y").select("token", "size"), "token"), "mixed")

    def lists(self, mixed: DataFrame) -> DataFrame:
        """(task, key): the members of each token, in parts of about ``group``, every list of members once."""
        part = F.pmod(F.xxhash64("key"), F.ceil(F.col("size") / self.group))
        lists = mixed.groupBy("token", part.alias("part")).agg(F.sort_array(F.collect_set("key")).alias("keys"))
        lists = lists.where(F.size("keys") > 1).select("keys").distinct()
        return lists.select(F.xxhash64("keys").alias("task"), F.explode("keys").alias("key"))

    def blocks(self, mixed: DataFrame) -> DataFrame:
        """(task, key) for tokens of more than ``group`` members: the members outside the token's largest
        component, in blocks, each with every block of members."""
        each = mixed.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
        tokens = each.groupBy("token").agg(F.max_by("label", F.struct("n", "label")).alias("most"), F.first("size").alias("all"),
                                           F.max("n").alias("n")).select(
            "token", "most", F.ceil(F.col("all") / self.group).alias("blocks"), F.ceil((F.col("all") - F.col("n")) / self.group).alias("rest"))
        rows = mixed.join(tokens, "token").select("token", "key", "blocks", "rest", (F.col("label") != F.col("most")).alias("out"))
        name = F.xxhash64("key")
        upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
        everyone = rows.select("token", "key", F.pmod(name, F.col("blocks")).alias("i"), F.explode(upto("rest")).alias("j"))
        others = rows.where("out").select("token", "key", F.explode(upto("blocks")).alias("i"), F.pmod(name, F.col("rest")).alias("j"))
        both = everyone.unionAll(others.select("token", "key", "i", "j"))
        return both.select(F.xxhash64("token", "i", "j").alias("task"), "key").distinct()

    def placed(self, tasks: DataFrame, labels: DataFrame, most: int | None) -> DataFrame:
        """The rows of the tasks' members, with task and label; ``tasks`` has ``most`` rows at the utmost, if known."""
        return tasks.join(sized(labels, self.n_keys), "key").join(self.rows, "key")

    def joined(self, tasks: DataFrame, labels: DataFrame, most: int | None = None) -> DataFrame:
        """Edges (a, b) between components of the tasks' members, in both directions, which connect what the
        members' links connect: in each task those to the least of the components that become one."""
        ship_package(tasks.sparkSession)
        connect = self.connect
        rows = self.placed(tasks, labels, most)
        rows = rows.repartition("task").sortWithinPartitions("task")

        def edges(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if len(parts) > 1 else parts[0]
            found, first, before = np.unique(np.array(whole.column("label").to_pylist(), object), return_index=True, return_inverse=True)
            after = (connect(whole, before) if len(found) > 1 else before)[first]
            least: dict[int, int] = {}
            pairs = [(old, to) for old, new in enumerate(after.tolist()) if (to := least.setdefault(new, old)) != old]
            labels = whole.column("label").take(pa.array(first))
            a, b = (labels.take(pa.array([p[k] for p in pairs] + [p[1 - k] for p in pairs], pa.int64())) for k in (0, 1))
            return pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            task = None
            for batch in batches:
                names = batch.column("task").to_numpy()
                cuts = [0, *(1 + np.flatnonzero(names[1:] != names[:-1])).tolist(), len(names)] if len(names) else []
                for a, b in zip(cuts[:-1], cuts[1:]):
                    if held and names[a] != task:
                        yield edges(held)
                        held = []
                    task = names[a]
                    held.append(batch.slice(a, b - a))
            if held:
                yield edges(held)

        kind = self.keys.schema["key"].dataType.simpleString()
        return rows.mapInArrow(run, f"a {kind}, b {kind}")

    def merged(self, labels: DataFrame, edges: DataFrame) -> DataFrame:
        """The labels after the edges between them have joined their components."""
        sides = stored(edges, "edges")
        if sides.isEmpty():
            return labels
        found = components(sides, self.n_keys)
        renamed = found.select(F.col("key").alias("label"), F.col("label").alias("least"))
        after = labels.join(sized(renamed, self.n_keys), "label", "left")
        return stored(after.select("key", F.coalesce("least", "label").alias("label")), "labels")
