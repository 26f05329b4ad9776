import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from helpers import SF, awkward, documents, empty

from kestrel.llm import fingerprints, sharding


def check_law(rows, shards=24):
    places = defaultdict(list)
    for r in rows:
        places[r["shard"]].append(r["slot"])
    sizes = [len(places[s]) for s in range(shards)]
    assert set(places) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in places.values())


def test_shards_of_documents(spark):
    from kestrel.llm.queries import op3_shards, table

    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    rows = op3_shards(spark, SF).collect()
    assert len(rows) == len(texts)
    check_law(rows)
    groups = defaultdict(set)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 8, zlib.crc32(data), "rows", None)
        groups[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in groups.values())


def test_a_hot_group_fills_as_few_shards_as_it_can(spark):
    rng = random.Random(4)
    texts = ["hot"] * 800 + [f"pair {k // 2}" for k in range(400)] + [f"own {k}" for k in range(1200)]
    rng.shuffle(texts)
    docs = documents(spark, list(enumerate(texts)))
    rows = sharding.assign(docs, 24).collect()
    check_law(rows)
    spread = defaultdict(set)
    for r in rows:
        spread[texts[r["doc_id"]]].add(r["shard"])
    assert len(spread["hot"]) <= 12  # 8 shards of 100 rows hold it; hashing alone would use all 24
    pairs = [s for t, s in spread.items() if t.startswith("pair")]
    assert sum(len(s) == 1 for s in pairs) >= 0.9 * len(pairs)


def test_places_are_numbered_within_groups(spark):
    rows = spark.range(1000).selectExpr("id as row", "id % 3 as g")
    placed = sharding.numbered(rows, "g", 7).collect()
    for g in range(3):
        assert sorted(r["place"] for r in placed if r["g"] == g) == list(range(sum(r["g"] == g for r in placed)))


def test_sharding_awkward_rows(spark):
    rows = sharding.assign(awkward(spark), 24).collect()
    assert len(rows) == awkward(spark).count()
    check_law(rows)
    check_law(sharding.assign(awkward(spark), 2).collect(), 2)
    assert sharding.assign(empty(spark), 24).count() == 0


# --- fingerprints -----------------------------------------------------------------------------

def names_at(text, levels):
    x, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    for _ in range(levels):
        x, offsets = fingerprints.parse(x, offsets)
    return x.tolist()


def test_equal_substrings_share_interior_names_at_any_offset():
    rng = random.Random(1)
    common = bytes(rng.randrange(97, 110) for _ in range(4000))
    for levels in (1, 2, 3):
        plain = names_at(common, levels)
        for k in range(1, 9):
            inside = names_at(bytes(rng.randrange(97, 123) for _ in range(k)) + common + b"zz" * k, levels)
            missing = sum((Counter(plain) - Counter(inside)).values())
            assert missing <= 14, (levels, k, missing)


def test_phrases_of_runs_and_of_short_texts():
    assert names_at(b"a" * 50, 1) != names_at(b"a" * 51, 1) and len(names_at(b"a" * 50, 1)) == 1
    texts = [b"", b"a", b"ab", b"aa", b"ba", b"abc" * 1000, b"a" * 5000, "é".encode() * 700]
    roots, sketches = fingerprints.fingerprints(texts)
    assert len(set(roots.tolist())) == len(texts)
    alone = [fingerprints.fingerprints([t]) for t in texts]
    assert [int(r[0]) for r, _ in alone] == roots.tolist()  # no text depends on its neighbours in a batch
    assert all((s[0] == sketches[k]).all() for k, (_, s) in enumerate(alone))
    assert fingerprints.likeness(sketches[:1], sketches[:1])[0] == 1.0 and fingerprints.likeness(sketches[:1], sketches[5:6])[0] == 0.0


def check_neighbours(rows, pairs):
    """``pairs``: (id, text) in order."""
    found = defaultdict(list)
    for r in rows:
        found[r["doc_id"]].append(r)
    texts = [t or "" for _, t in pairs]
    prints = {}
    for k, (i, _) in enumerate(pairs):
        text, following = texts[k], texts[(k + 1) % len(texts)]
        n = len(text)
        edited = text[:n - n // 2] + following[:n // 2]
        wanted = (n, hashlib.sha256(edited.encode()).hexdigest())
        r = next(x for x in found[i] if (x["n_chars"], x["edited_sha256"]) == wanted)
        found[i].remove(r)
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert prints.setdefault(edited, r["edited_fingerprint"]) == r["edited_fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if edited == text:
            assert r["near_edited"] == 1
        if following == text:
            assert r["near_next"] == 1
    assert len(set(prints.values())) == len(prints)


def test_fingerprints_of_documents(spark):
    from kestrel.llm.queries import op4_fingerprints, table

    pairs = sorted((r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect())
    rows = op4_fingerprints(spark, SF).collect()
    assert len(rows) == len(pairs)
    check_neighbours(rows, pairs)
    long = [r for r in rows if r["n_chars"] > 1000]
    assert 0.2 < np.mean([r["near_edited"] for r in long]) < 0.5 and np.mean([r["near_next"] for r in long]) < 0.05


def test_fingerprints_of_awkward_rows(spark):
    order = sorted(awkward(spark).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    pairs = [(r["doc_id"], r["text"]) for r in order]
    for partitions in (1, 3, 40):
        check_neighbours(fingerprints.compare_neighbours(awkward(spark), partitions=partitions).collect(), pairs)
    assert fingerprints.compare_neighbours(empty(spark)).count() == 0
    single = fingerprints.compare_neighbours(documents(spark, [(1, "alone")])).collect()
    check_neighbours(single, [(1, "alone")])


def test_rows_of_a_hot_id_are_spread_over_partitions(spark):
    """One id with most rows: its texts go to several partitions, and still meet in the order of texts."""
    from pyspark.sql import functions as F

    rows = [(7, f"text number {i % 997:04d} of a hot id") for i in range(2000)] + [(i, f"other {i}") for i in range(300)]
    docs = documents(spark, rows)
    order = sorted(((i, t.encode()) for i, t in rows), key=lambda r: r)
    expected = sorted(hashlib.sha256((t.decode()[:len(t) - len(t) // 2] + f.decode()[:len(t) // 2]).encode()).hexdigest()
                      for (_, t), (_, f) in zip(order, order[1:] + order[:1]))
    found = fingerprints.compare_neighbours(docs, partitions=8)
    assert sorted(r["edited_sha256"] for r in found.collect()) == expected
    parts = docs.select(F.col("doc_id").alias("id"), "text").repartitionByRange(8, F.col("id"), F.substring("text", 1, 64))
    sizes = [r["count"] for r in parts.where("id = 7").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 5 and max(sizes) < 1000
