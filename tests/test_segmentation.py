"""Words of running text against every possible cut, and against a plain dynamic program."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from kestrel.functions import segmentation
from kestrel.functions.segmentation import PER_CHARACTER, UNKNOWN, Lattice, character_class, cut_runs, segmented_keywords

LEXICON = [("今日", "名詞,副詞可能,*,*", "今日", 4000), ("は", "助詞,係助詞,*,*", "は", 3000), ("東京", "名詞,固有名詞,*,*", "東京", 3000),
           ("京都", "名詞,固有名詞,*,*", "京都", 2800), ("都", "名詞,接尾,*,*", "都", 5000), ("東", "名詞,一般,*,*", "東", 6000),
           ("の", "助詞,連体化,*,*", "の", 2500), ("天気", "名詞,一般,*,*", "天気", 4500), ("が", "助詞,格助詞,*,*", "が", 2500),
           ("良い", "形容詞,自立,*,*", "良い", 4200), ("走っ", "動詞,自立,*,*", "走る", 5000), ("た", "助動詞,*,*,*", "た", 2000)]


def rows(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")


def lexicon(spark, entries=LEXICON):
    return spark.createDataFrame(entries, "surface string, pos string, base_form string, cost int")


def spans(run, words):
    """(start, end): (cost, known) of the words that a run may hold."""
    out = {}
    for i in range(len(run)):
        stop = i + 1
        while stop < len(run) and character_class(run[stop]) == character_class(run[i]):
            stop += 1
        for j in range(i + 1, len(run) + 1):
            unknown = UNKNOWN + PER_CHARACTER * (j - i) if j in (i + 1, stop) else None
            known = words.get(run[i:j])
            if known is not None and (unknown is None or known <= unknown):
                out[i, j] = (known, True)
            elif unknown is not None:
                out[i, j] = (unknown, False)
    return out


def all_cuts(run, words):
    """The best of all cuts: least cost, fewest words, then the longest last words."""
    found, best = spans(run, words), None
    for k in range(len(run)):
        for places in itertools.combinations(range(1, len(run)), k):
            cuts = [0, *places, len(run)]
            steps = list(zip(cuts[:-1], cuts[1:]))
            if all(s in found for s in steps):
                rank = (sum(found[s][0] for s in steps), len(steps), cuts[::-1][1:])
                best = min(best, (rank, steps)) if best else (rank, steps)
    return [(run[a:b], found[a, b][1]) for a, b in best[1]]


def dynamic(run, words):
    """The same by a table from the end to the front."""
    n, rest = len(run), {}
    words_of, longest = words, max(map(len, words))
    stop, stops = n, {}
    for i in range(n - 1, -1, -1):
        stop = stop if i + 1 < n and character_class(run[i]) == character_class(run[i + 1]) else i + 1
        stops[i] = stop
    best = [(0, 0)] + [None] * n
    for j in range(1, n + 1):
        options = []
        for i in set(range(max(0, j - longest), j)) | {i for i in range(j) if stops[i] == j}:
            costs = [c for c in (words_of.get(run[i:j]), UNKNOWN + PER_CHARACTER * (j - i) if j in (i + 1, stops[i]) else None) if c is not None]
            options += [(best[i][0] + c, best[i][1] + 1, i) for c in costs]
        best[j] = min(options)
        rest[j] = best[j][2]
    out = []
    while n:
        out.append(run[rest[n]:n])
        n = rest[n]
    return out[::-1]


def test_every_cut_of_short_runs():
    rng = random.Random(2)
    for _ in range(400):
        letters = rng.choice(["ab", "abc", "あア亜", "a1あ"])
        words = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 4))): rng.choice([1000, 9000, 21000, 22000, 30000]) for _ in range(6)}
        run = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 8)))
        found = Lattice([(w, "名詞", w, c) for w, c in words.items()]).cut(run)
        assert [(t["surface"], t["pos"] is not None) for t in found] == all_cuts(run, words)


def test_sentence_without_blanks(spark):
    df = rows(spark, ["今日は東京都の天気が良い", "走った https://t.co/abc 東京都 ", None, "", "ラーメン123とABC"])
    for trie_rows in (100, 3):
        runs = spark.createDataFrame([("今日は東京都の天気が良い",)], "run string")
        tokens = cut_runs(runs, lexicon(spark), trie_rows=trie_rows).collect()[0]["tokens"]
        assert [t["surface"] for t in tokens] == ["今日", "は", "東京", "都", "の", "天気", "が", "良い"]
        found = {(r["id"], r["keyword"]): r["appearances"] for r in segmented_keywords(df, "text", ["id"], lexicon(spark), trie_rows=trie_rows).collect()}
        assert found == {(0, "今日"): 1, (0, "東京"): 1, (0, "都"): 1, (0, "天気"): 1, (0, "良い"): 1, (1, "走る"): 1, (1, "東京"): 1, (1, "都"): 1,
                         (4, "ラーメン"): 1, (4, "ABC"): 1}


def test_costs_of_neighbours_change_the_path(spark):
    run = spark.createDataFrame([("東京都",)], "run string")
    assert [t["surface"] for t in cut_runs(run, lexicon(spark)).collect()[0]["tokens"]] == ["東京", "都"]
    apart = lexicon(spark, [("東京", "名詞", "東京", 3000), ("都", "接尾", "都", 5000), ("東", "名詞", "東", 4000), ("京都", "地名", "京都", 4500)])
    assert [t["surface"] for t in cut_runs(run, apart).collect()[0]["tokens"]] == ["東京", "都"]
    found = cut_runs(run, apart, connections={("名詞", "接尾"): 2000, ("名詞", "地名"): -500}).collect()[0]["tokens"]
    assert [t["surface"] for t in found] == ["東", "京都"]


@pytest.mark.parametrize("trie_rows", [10_000, 70])
def test_whole_documents_without_any_blank(spark, trie_rows):
    """Every run of the documents with all blanks gone, cut as a plain dynamic program does."""
    from collections import Counter

    import re

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(60).collect()
    texts = [re.sub(r"\s+", "", r["text"]) for r in docs]
    counts = Counter(w for r in docs for w in re.findall(r"[^\W_]+", r["text"]) if 2 <= len(w) <= 12)
    words = {w: 9000 - 300 * n + 100 * len(w) for w, n in counts.most_common(300)}
    runs = sorted({r for t in texts for r in re.findall(r"[^\W_]+", t)}, key=len)
    runs = runs[:400] + runs[-20:]
    table = spark.createDataFrame([(r,) for r in runs], "run string")
    found = cut_runs(table, lexicon(spark, [(w, "名詞", w, c) for w, c in words.items()]), trie_rows=trie_rows).collect()
    assert {r["run"]: [t["surface"] for t in r["tokens"]] for r in found} == {r: dynamic(r, words) for r in runs}


def test_empty_lexicon_and_no_rows(spark):
    none = lexicon(spark).where("false")
    assert [r["keyword"] for r in segmented_keywords(rows(spark, ["東京abc"]), "text", [], none).collect()] != []
    assert segmented_keywords(rows(spark, ["x"]).where("false"), "text", [], lexicon(spark)).count() == 0


@pytest.mark.parametrize("block", [1, 2, 5, 100])
def test_runs_cut_at_once_are_cut_as_one_by_one(block):
    """All runs of a chunk, by tries of some entries each, against the lattice of each run."""
    rng = random.Random(block)
    for letters in ("ab", "abcd12", "あア亜々9x", "a\U00020000\U00020001é"):
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 7))) for _ in range(40)})
        entries = [(w, "名詞", w, rng.choice([-3, 1000, 9000, 21000, 22000, 30000])) for w in words]
        tries = [segmentation.Trie([w for w, *_ in e], np.array([x[3] for x in e], np.int64), *[pa.array([x[i] for x in e]) for i in (1, 2)])
                 for e in (entries[i:i + block] for i in range(0, len(entries), block))]
        runs = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 30))) for _ in range(200)]
        of, *found = segmentation.cut_chunk(runs, tries, len(tries), None)
        found = list(zip(of.tolist(), *(x.to_pylist() for x in found)))
        lattice = Lattice(entries)
        assert found == [(i, w["surface"], w["pos"], w["base_form"]) for i, run in enumerate(runs) for w in lattice.cut(run)]


def test_blocks_of_a_lexicon_add_no_pass_over_the_runs(spark):
    """One step over the runs, however many blocks the lexicon has, and no shuffle of runs or of their entries."""
    runs = spark.range(3).selectExpr("CAST(id AS string) AS run")
    plan = cut_runs(runs, lexicon(spark), trie_rows=2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan and "Union" not in plan


def test_each_group_counts_its_own_words(spark):
    """Rows of a null group, and of runs that several groups hold."""
    df = spark.createDataFrame([(None, "東京都"), ("a", "東京都"), ("a", "東京都 東"), ("b", "zz東")], "g string, text string")
    found = {(r["g"], r["keyword"]): r["appearances"] for r in segmented_keywords(df, "text", ["g"], lexicon(spark), trie_rows=4).collect()}
    assert found == {(None, "東京"): 1, (None, "都"): 1, ("a", "東京"): 2, ("a", "都"): 2, ("a", "東"): 1, ("b", "zz"): 1, ("b", "東"): 1}


def test_lattices_are_filled_in_by_pieces(monkeypatch):
    """A chunk's lattices are filled in for a bounded number of characters at once, whatever the chunk's size; the words
    are those of the runs one by one, from blocks that overlap in their ranges too."""
    rng = random.Random(5)
    entries = sorted({"".join(rng.choice("abcあア漢1𠮷") for _ in range(rng.randint(1, 4))): rng.randint(1, 9) * 4000 for _ in range(90)}.items())
    runs = ["".join(rng.choice("abcdあいア漢字12𠮷") for _ in range(rng.randint(0, 12))) for _ in range(300)]
    tries = [segmentation.Trie([w for w, _ in part], np.array([c for _, c in part]), pa.array(["名詞"] * len(part)), pa.array([w for w, _ in part]))
             for part in (entries[i:i + 7] for i in range(0, len(entries), 7))]
    sizes, whole = [], segmentation.least_cuts_of

    def recorded(flat, *rest):
        sizes.append(len(flat))
        return whole(flat, *rest)

    monkeypatch.setattr(segmentation, "PIECE", 100)
    monkeypatch.setattr(segmentation, "least_cuts_of", recorded)
    of, surfaces, pos, base = segmentation.cut_chunk(runs, tries, len(tries), None)
    lattice = segmentation.Lattice([(w, "名詞", w, c) for w, c in entries])
    expected = [(i, w["surface"], w["pos"], w["base_form"]) for i, run in enumerate(runs) for w in lattice.cut(run)]
    assert list(zip(of.tolist(), surfaces.to_pylist(), pos.to_pylist(), base.to_pylist())) == expected
    assert len(sizes) > 10 and max(sizes) < 100 + 2 * 12
