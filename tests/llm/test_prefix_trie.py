"""The conversation trie against plain sets of prefixes."""

import hashlib
import random
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from kestrel.llm import prefix_trie
from kestrel.llm.queries import op12_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    out = {}
    for c, own in convs.items():
        h = crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(rows):
    members, ends = {}, {}
    for c, turns in rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[x] for x in below)
    digest = lambda node: hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
    return sorted(((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])), leaves[node],
                    saved[node], digest(node)) for node, m in members.items()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def found(conversations):
    turns, totals = prefix_trie.spliced(prefix_trie.turns(conversations))
    return sorted((tuple(r) for r in prefix_trie.build(turns, totals).select(
        "conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256").collect()), key=str)


@pytest.fixture()
def many_parts(spark):
    """Shuffles keep their eight parts, so that long conversations run over several."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_whole_table_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    made = op12_prefix_trie(spark, sf)
    assert made.columns == list(NAMES)
    assert sorted((tuple(r) for r in made.collect()), key=str) == brute(rows)


def random_conversations(rng, n, long_one=0):
    rows = []
    for c in range(n):
        turns = [("u" if i % 2 else "a", rng.choice("xyz") * rng.randrange(1, 3)) for i in range(rng.randrange(1, 14))]
        if c % 3 == 0:  # copies
            turns = [("a", "hello"), ("u", "same")] + [("a", "x")] * 7
        rows += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    rows += [(n, i, "u", f"turn {i % 7}") for i in range(long_one)]
    rng.shuffle(rows)
    return rows


def test_large_components_are_split_by_joins(spark, monkeypatch, many_parts):
    """A third of all rows are one long conversation, a third of the conversations are copies, and
    components of more than 12 nodes are split in rounds."""
    rng = random.Random(5)
    rows = random_conversations(rng, 40, long_one=170)
    monkeypatch.setattr(prefix_trie, "LOCAL", 12)
    monkeypatch.setattr(prefix_trie, "LISTED", 3)
    assert found(frame(spark, rows)) == brute(rows)


def test_awkward_rows(spark):
    rows = [(None, 1, "u", "no conversation"), (3, None, None, None), (3, 2, "u", None), (3, 2, "u", ""), (3, 2, "a", "é"), (3, 2, "a", "é"),
            (5, 1, "u", "x" * 70_000), (6, 9, "u", "only"), (7, 1, "u", "x" * 70_000), (7, 2, None, "b"), (10, None, "u", "b"), (10, None, "u", "a")]
    rows += [(c, 1, "u", "turnless when rebuilt") for c in range(20, 60) if c % 5]
    made = found(frame(spark, rows))
    assert made == brute(rows)
    assert any(depth == 0 and ends != hashlib.sha256(b"").hexdigest() for _, depth, *_, ends in made)
    clashing = frame(spark, rows).selectExpr("*", "1 AS x", "'s' AS conv", "2 AS pos", "3 AS size")
    assert found(clashing) == made
    assert found(frame(spark, [])) == []


def test_running_sums_cross_parts(spark, many_parts):
    rows = [(k, i, i * 7 - 3) for k in (1, 2, 3) for i in range(300 if k == 2 else 5)]
    terms = lambda batch: [np.ones(batch.num_rows, np.uint64), batch.column("v").to_numpy().view(np.uint64)]
    df = spark.createDataFrame(rows, "k long, i long, v long")
    made = prefix_trie.running_sums(df, "k", ["i"], ["i"], ["n", "s"], "k long, i long", terms, ["k", "i"], ["v"])
    got = {(r["k"], r["i"]): (r["n"], r["s"], r["before_s"]) for r in made.collect()}
    for k, i, v in rows:
        total = sum(x for a, j, x in rows if a == k and j <= i)
        assert got[k, i] == (i + 1, total, total - v)


def test_powers_wrap():
    for base in prefix_trie.BASES:
        assert prefix_trie.powers(base, np.array([0, 1, 2, 1000, 123456789])).tolist() == [pow(base, e, 1 << 64) for e in (0, 1, 2, 1000, 123456789)]


def test_centroids_of_random_trees():
    rng = random.Random(1)
    for n in (1, 2, 3, 10, 200, 1500):
        for shape in ("any", "chain", "star"):
            parent = [-1] + [{"any": rng.randrange(i), "chain": i - 1, "star": 0}[shape] for i in range(1, n)]
            depth = [0] * n
            for i in range(1, n):
                depth[i] = depth[parent[i]] + 1
            order = sorted(range(n), key=depth.__getitem__)
            worth = [rng.randrange(100) for _ in range(n)]
            rows = pa.table({"x": order, "y": [1] * n, "px": [parent[i] for i in order], "py": [1] * n, "cx": [0] * n, "cy": [1] * n,
                             "v": [worth[i] for i in order]})
            sums = prefix_trie.subtree_sums(rows, ["v"])[0]
            plain = list(worth)
            for i in reversed(order[1:]):
                plain[parent[i]] += plain[i]
            assert sums.tolist() == [plain[i] for i in order]
