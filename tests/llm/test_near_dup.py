import random
from collections import defaultdict

import numpy as np
import pytest
from helpers import SF, awkward, documents, empty, words

from kestrel.llm import near_dup
from kestrel.llm.shingles import Sampler, Weights, weighted_jaccard


def brute_classes(rows, common=None, total=1):
    """Components of all pairs whose weighted Jaccard reaches the threshold; plain weights unless
    common shingles are given as {words: document frequency}."""
    import math

    def weights(text):
        w = words(text)
        n = defaultdict(int)
        for k in range(max(1, len(w) - 4) if w else 0):
            n[tuple(w[k:k + 5])] += 1
        idf = lambda s: 1 - 0.5 * math.log(max(common[s] / (0.02 * total), 1)) / math.log(50) if common and s in common else 1
        return {s: (1 + math.log(k)) * idf(s) for s, k in n.items()}

    sets = [weights(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            least = sum(min(v, b[s]) for s, v in a.items() if s in b)
            most = sum(a.values()) + sum(b.values()) - least
            if (rows[i][1] or "") == (rows[j][1] or "") or (most and least / most >= 0.8):
                parent[root(i)] = root(j)
    classes = defaultdict(set)
    for k in range(len(rows)):
        classes[root(k)].add(rows[k][0])
    return set(map(frozenset, classes.values()))


def found_classes(df):
    classes = defaultdict(set)
    for r in df.collect():
        classes[r["class_id"]].add(r["doc_id"])
    assert all(min(ids) == c for c, ids in classes.items())
    return set(map(frozenset, classes.values()))


def edited(rnd, text, n):
    w = text.split()
    for _ in range(n):
        w[rnd.randrange(len(w))] = f"new{rnd.randrange(10**6)}"
    return " ".join(w)


def sentences(rnd, n):
    return " ".join(f"w{rnd.randrange(3000)}" for _ in range(n))


def test_groups_of_edited_copies(spark):
    rnd = random.Random(5)
    rows = []
    for _ in range(12):  # originals with copies edited once or twice, and exact copies
        text = sentences(rnd, 150)
        rows += [text, text] + [edited(rnd, text, rnd.choice([1, 2])) for _ in range(4)]
    rows += [sentences(rnd, rnd.randint(1, 80)) for _ in range(60)]
    rnd.shuffle(rows)
    rows = list(enumerate(rows))
    assert found_classes(near_dup.find(documents(spark, rows))) == brute_classes(rows)


def test_large_group_and_common_passage(spark):
    """A group of a third of all rows whose copies resemble the original more than one another, and a
    long passage that another third shares without being copies."""
    rnd = random.Random(6)
    text, passage = sentences(rnd, 200), sentences(rnd, 60)
    rows = [edited(rnd, text, 3) for _ in range(150)] + [text]
    rows += [passage + " " + sentences(rnd, 60) for _ in range(150)]
    rows += [sentences(rnd, 100) for _ in range(150)]
    rnd.shuffle(rows)
    rows = list(enumerate(rows))
    counts = defaultdict(int)
    for _, t in rows:
        w = words(t)
        for s in {tuple(w[k:k + 5]) for k in range(len(w) - 4)}:
            counts[s] += 1
    common = {s: n for s, n in counts.items() if n >= 0.02 * len(rows)}
    expected = brute_classes(rows, common, len(rows))
    got = found_classes(near_dup.find(documents(spark, rows)))
    assert got == expected
    assert max(map(len, got)) >= 140


def test_exact_copies_do_not_make_their_shingles_common(spark):
    """An edited copy at a plain similarity of 0.815 of a text that a third of the rows repeat."""
    rnd = random.Random(8)
    w = [f"hot{k}" for k in range(200)]
    text = " ".join(w)
    for k in (30, 70, 110, 150):
        w[k] = f"new{k}"
    rows = list(enumerate([text] * 100 + [" ".join(w)] + [sentences(rnd, 40) for _ in range(199)]))
    got = found_classes(near_dup.find(documents(spark, rows)))
    assert got == brute_classes(rows) and max(map(len, got)) == 101


def test_samples_agree_as_often_as_the_weighted_jaccard():
    rng = np.random.default_rng(1)
    sampler = Sampler(2000)
    names = np.sort(rng.integers(0, 1 << 63, 300, np.uint64))
    a = np.where(rng.random(300) < 0.8, rng.choice([0.5, 1, 1.7, 3.0], 300), 0)
    b = np.where(rng.random(300) < 0.8, np.where(rng.random(300) < 0.7, a, rng.choice([0.5, 1, 2.2], 300)), 0)
    sides = [(names[w > 0], w[w > 0]) for w in (a, b)]
    joined = sampler.samples(np.concatenate([s[0] for s in sides]), np.concatenate([s[1] for s in sides]), np.array([0, len(sides[0][0])]))
    assert abs((joined[0] == joined[1]).mean() - weighted_jaccard(*sides)) < 0.04


def test_weights_of_common_shingles():
    weights = Weights({5: 1000, 9: 20}, 1000)
    assert weights.of(np.array([5, 9, 11], np.uint64), np.array([1, 1, 1])).tolist() == pytest.approx([0.5, 1.0, 1.0])


def test_query_on_whole_documents(spark):
    from kestrel.llm.queries import op1_near_dup, table

    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    assert found_classes(op1_near_dup(spark, SF)) == brute_classes(rows)


def test_awkward_rows(spark):
    rows = {}
    for r in near_dup.find(awkward(spark)).collect():
        rows.setdefault(r["doc_id"], r)
    assert near_dup.find(awkward(spark)).count() == awkward(spark).count()
    assert rows[5]["class_id"] == rows[11]["class_id"] == 5 and rows[5]["class_size"] == 3 == rows[5]["copies"]
    assert rows[1]["class_id"] == rows[2]["class_id"] == 1 and rows[3]["class_id"] == 3 and rows[4]["class_id"] == 4
    assert rows[None]["class_id"] is None
    assert near_dup.find(empty(spark)).count() == 0


def test_one_row_of_each_class_stays(spark):
    kept = near_dup.keep_one(awkward(spark))
    assert kept.columns == awkward(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 3, 4, 5, 6, 7, 8, 9, 10, 12] and ids.count(None) == 1
    assert near_dup.keep_one(empty(spark)).count() == 0
