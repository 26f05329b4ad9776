"""The n-gram join against a plain comparison of all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import UPPER, awkward, documents, empty
from kestrel.llm import graph, group_join, ngram_join
from kestrel.llm.byte_words import mix
from kestrel.llm.queries import op13_ngram_join

TOKENS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = TOKENS.findall((text or "").translate(UPPER))
    if len(w) >= 4:
        return {tuple(w[i:i + 4]) for i in range(len(w) - 3)}
    return {tuple(w)} if w else set()


def linked(a, b):
    both = len(a & b)
    return both > 0 and 100 * both >= 85 * (len(a) + len(b) - both)


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        near = {j for x in s for j in holders[x] if j < i and 85 * len(s) <= 100 * len(sets[j]) and 85 * len(sets[j]) <= 100 * len(s)}
        for j in near:
            if label[i] != label[j] and linked(s, sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    least = {}
    for (i, _), x in zip(rows, label):
        if i is not None:
            least[x] = min(i, least.get(x, i))
    return sorted(((i, len(s), least.get(x) if s else i) for (i, _), s, x in zip(rows, sets, label)), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10 ** 6)}"
    return " ".join(words)


def family(rng, members, edits, start, length=120, common=""):
    """Copies of one text with so many edited words each; pairs of them are similar, or nearly so."""
    base = [f"w{rng.randrange(4000)}" for _ in range(length)]
    return [(start + i, common + edited(rng, base, rng.randrange(edits))) for i in range(members)]


def test_whole_table_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(op13_ngram_join(spark, sf)) == brute(rows)


def test_mixed_families_in_blocks(spark, monkeypatch):
    """Families whose members are partly just below the threshold, a line that all share, and copies;
    groups are far larger than a block, so that the block round decides."""
    rng = random.Random(7)
    rows = family(rng, 60, 8, 0) + family(rng, 40, 4, 100, common="this line stands in front of many texts ") + family(rng, 30, 12, 200)
    rows += [(300 + i, f"this line stands in front of many texts {i} " + " ".join(f"x{rng.randrange(99)}" for _ in range(i % 9))) for i in range(40)]
    rows += [(400, rows[0][1]), (401, rows[0][1]), (402, "one two three"), (403, "One two THREE"), (404, "one two three four")]
    expected = brute(rows)
    assert len({c for _, _, c in expected}) > 20
    for group, matrix in ((400, 1 << 25), (7, 600)):
        monkeypatch.setattr(group_join, "GROUP", group)
        monkeypatch.setattr(ngram_join, "MATRIX_BYTES", matrix)
        assert rows_of(ngram_join.find(documents(spark, rows))) == expected


def random_groups(trials):
    """(sets with rarities, labels, order) of groups of sets that are similar, or nearly so."""
    rng = np.random.default_rng(3)
    for trial in range(trials):
        universe = rng.integers(0, 1 << 62, 60).astype(np.uint64)
        rarity = dict(zip(universe.tolist(), rng.integers(0, 3, 60).tolist()))
        base = rng.permutation(universe)[:40]
        sets = [np.unique(np.concatenate([base[rng.random(40) < 0.93], rng.permutation(universe)[:rng.integers(0, 5)]]))
                for _ in range(rng.integers(2, 12))]
        sets = [(s, np.array([rarity[x] for x in s.tolist()])) for s in sets if len(s)]
        order = ngram_join.Order({int(x): int(n) for x, n in zip(universe[:9].view(np.int64), rng.integers(2, 5, 9))})
        yield sets, rng.integers(0, 9, len(sets)) if trial % 2 else np.arange(len(sets)), order


def linked_labels(sets, labels):
    label = labels.copy()
    for i in range(len(sets)):
        for j in range(i):
            if linked(set(sets[i][0].tolist()), set(sets[j][0].tolist())):
                label[label == label[i]] = label[j]
    return label


def test_group_join_equals_all_pairs():
    for sets, before, order in random_groups(150):
        found, label = ngram_join.join_group(sets, before, order), linked_labels(sets, before)
        assert (np.equal.outer(found, found) == np.equal.outer(label, label)).all()


@pytest.mark.parametrize("matrix", [1 << 25, 400])
def test_families_of_fronts_hold_every_link(monkeypatch, matrix):
    monkeypatch.setattr(ngram_join, "MATRIX_BYTES", matrix)
    apart = 0
    for sets, before, order in random_groups(150):
        fronts = [(order.sorted(s, r)[1][:ngram_join.in_front(len(s))] >> 32).tolist() for s, r in sets]
        rows = pa.RecordBatch.from_arrays([pa.array([len(s) for s, _ in sets]), pa.array(fronts, pa.list_(pa.int32()))], names=["n_shingles", "front"])
        found, label = ngram_join.connect_fronts(rows, before), linked_labels(sets, before)
        assert (np.equal.outer(label, label) <= np.equal.outer(found, found)).all()
        apart += len(set(found.tolist())) > 1
    assert apart  # some sets that share a few shingles are told apart
    one, two = np.arange(0, 200, dtype=np.uint64), np.arange(150, 350, dtype=np.uint64)
    order = ngram_join.Order({})
    fronts = [order.sorted(np.sort(mix(s)), np.zeros(200, np.int64))[1][:ngram_join.in_front(200)].tolist() for s in (one, two, one)]
    rows = pa.RecordBatch.from_arrays([pa.array([200] * 3), pa.array(fronts, pa.list_(pa.int64()))], names=["n_shingles", "front"])
    assert ngram_join.connect_fronts(rows, np.arange(3)).tolist() == [0, 1, 0]


def test_possible_members(spark):
    """The first common shingle of two similar sets leaves enough behind it in both."""
    fronts = {1: (100, [11, 500, 501, 33]), 2: (90, [11, 33]), 3: (40, [33]), 4: (100, [900 + i for i in range(20)] + [44]), 5: (90, [44])}
    nodes = spark.createDataFrame([(k, n, f) for k, (n, f) in fronts.items()], "key long, n_shingles long, front array<long>")
    found = sorted((r["token"], r["key"], r["n"], r["at"]) for r in ngram_join.possible(nodes).collect())
    assert found == [(11, 1, 100, 0), (11, 2, 90, 0), (33, 1, 100, 3), (33, 2, 90, 1)]


def test_sketches_keep_every_similar_pair_and_no_others(spark):
    """Texts that only share a passage in front are no candidates, however many; similar ones of any size stay."""
    rng = np.random.default_rng(5)
    passage = rng.integers(0, 1 << 62, 12).astype(np.uint64)
    rows, pairs = [], set()
    for token in range(6):
        sets = []
        for i in range(60):
            own = np.unique(np.concatenate([passage, rng.integers(0, 1 << 62, rng.integers(40, 900)).astype(np.uint64)]))
            sets.append(own)
            if i % 10 == 0:  # just similar, and just not
                most = (100 * len(own)) // ngram_join.SIMILAR - len(own)
                for extra in (most, most + 1):
                    sets.append(np.unique(np.concatenate([own, rng.integers(0, 1 << 62, extra).astype(np.uint64)])))
        for i, x in enumerate(sets):
            if any(i != j and linked(set(x.tolist()), set(y.tolist())) for j, y in enumerate(sets)):
                pairs.add((token, 1000 * token + i))
        rows += [(token, 1000 * token + i, len(x), 0, len(sets), bytearray(ngram_join.sketch(x))) for i, x in enumerate(sets)]
    members = spark.createDataFrame(rows, "token long, key long, n long, at int, size long, sketch binary")
    nodes = members.select("key", "sketch")
    found = {(r["token"], r["key"]) for r in ngram_join.narrowed(members.drop("sketch"), nodes).collect()}
    assert found >= pairs and len(pairs) >= 72
    assert len(found) <= len(pairs) + 12 < len(rows) / 3
    whole = ngram_join.narrowed(members.drop("sketch", "size").withColumn("size", F.lit(10 ** 6)), nodes)
    assert whole.count() == len(rows)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(6)
    sets = [rng.integers(0, 400, rng.integers(0, 1 << rng.integers(1, 13))).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D) for _ in range(60)]
    sets = [np.unique(s) for s in sets] + [np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64)) for n in (1, 127, 128, 129, 5000, 9000)]
    sketches = ngram_join.Sketches(pa.array([ngram_join.sketch(s) for s in sets], pa.binary()))
    x, y = (a.ravel() for a in np.indices((len(sets), len(sets))))
    found = sketches.differ(x, y)
    apart = np.array([len(np.setxor1d(sets[a], sets[b])) for a, b in zip(x, y)])
    assert (found <= apart).all() and (found[x == y] == 0).all() and found.max() > 500


def test_steps_of_a_join_are_few(spark, monkeypatch):
    """Every step costs its tasks anew, however few rows it has: links are written once, as those between components,
    labels that already agree take no further round, and families of both kinds are joined in one round."""
    rng = random.Random(11)
    rows = family(rng, 30, 5, 0) + [r for i in range(9) for r in family(rng, 3, 3, 100 + 10 * i)]
    names = []
    write = graph.stored
    for module in (graph, group_join, ngram_join):
        monkeypatch.setattr(module, "stored", lambda df, name: names.append(name) or write(df, name))
    monkeypatch.setattr(group_join, "GROUP", 7)
    assert rows_of(ngram_join.find(documents(spark, rows))) == brute(rows)
    assert len(names) <= 40, names


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_components_equal_a_plain_search(spark, monkeypatch, broadcast):
    monkeypatch.setattr(graph, "sized", lambda df, rows, most=broadcast: F.broadcast(df) if rows <= most else df)
    rng = random.Random(12)
    edges = [(i, i + 1) for i in range(12)] + [(100, 200 - i) for i in range(20)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(45)]
    names = rng.sample(range(1000), 400)
    edges = [(names[a], names[b]) for a, b in edges if a != b]
    least = {v: v for e in edges for v in e}
    for _ in edges:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    sides = spark.createDataFrame([s for a, b in edges for s in ((a, b), (b, a))], "a long, b long")
    found = {r["key"]: r["label"] for r in graph.components(sides, len(least)).collect()}
    assert found == least and len(set(least.values())) > 5


def test_boundary_of_the_similarity():
    sets = [np.arange(0, 100, dtype=np.uint64), np.arange(0, 85, dtype=np.uint64), np.arange(16, 100, dtype=np.uint64)]
    found = ngram_join.join_group([(s, np.zeros(len(s), np.int64)) for s in sets], np.arange(3), ngram_join.Order({}))
    assert found[0] == found[1] != found[2]


@pytest.mark.parametrize("make", [awkward, empty])
def test_awkward_and_empty_tables(spark, make):
    docs = make(spark)
    assert rows_of(ngram_join.find(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
