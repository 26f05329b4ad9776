import hashlib
import random

import pytest
from helpers import SF, awkward, documents, empty, words
from pyspark.sql import functions as F

from kestrel.llm import decontaminate


def brute(text, items):
    """(words, hit words, matching items) by the contract, window by window."""
    w, hit, found = words(text), set(), set()
    for item, phrase in items:
        p = words(phrase)
        n = min(13, len(p))
        for k in range(len(p) - n + 1 if n else 0):
            for at in range(len(w) - n + 1):
                if w[at:at + n] == p[k:k + n]:
                    hit.update(range(at, at + n))
                    found.add(item)
    return len(w), len(hit), found


def some_tables(spark, seed=3):
    rnd = random.Random(seed)
    vocabulary = ["a", "B", "c", "é", "1"]
    phrase = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(1, phrase(20)), (2, phrase(13)), (3, phrase(5)), (4, "zz"), (5, ""), (6, "zz"), (None, phrase(14)), (7, None)]
    docs = [(k, phrase(rnd.randint(0, 60))) for k in range(40)]
    docs += [(100, "x, " + items[0][1].upper() + " y"), (101, "-ZZ-"), (102, items[1][1] + " " + items[1][1]), (103, None)]
    return documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"), docs, items


@pytest.mark.parametrize("block", [1_000_000, 3])
def test_matches_equal_brute_force_in_one_block_and_in_many(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    docs, benchmark, texts, items = some_tables(spark)
    got = {r["doc_id"]: r for r in decontaminate.matches(docs, benchmark).withColumn("hit", decontaminate.n_hit()).collect()}
    for i, text in texts:
        n, hit, found = brute(text, items)
        assert (got[i]["n_words"], got[i]["hit"]) == (n, hit)
        assert got[i]["items"] == sorted(str(x) for x in found if x is not None)


def test_query_on_whole_documents(spark):
    from kestrel.llm.queries import op7_decontaminate, table

    benchmark = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    windows = {}
    for item, text in benchmark:
        w = words(text)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(str(item))
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    rows = op7_decontaminate(spark, SF).collect()
    assert len(rows) == len(texts) and any(r["contaminated"] for r in rows)
    for r in rows:
        w, hit, found = words(texts[r["doc_id"]]), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if items := windows.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    found |= items
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (len(w), len(hit), len(found))
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(w))


def test_removal_of_documents_and_of_spans(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    clean = "nothing to see here"
    docs = documents(spark, [(1, f"Start, {item.upper()}! end"), (2, clean), (3, None), (4, item + " filler" * 400)])
    kept = decontaminate.remove_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4]
    texts = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, benchmark).collect()}
    assert texts[1] == "Start, ! end" and texts[2] == clean and texts[3] is None


def test_awkward_rows(spark):
    benchmark = spark.createDataFrame([(1, "One")], "item_id long, text string")
    rows = decontaminate.matches(awkward(spark), benchmark).collect()
    assert len(rows) == awkward(spark).count()
    assert sum(bool(r["items"]) for r in rows) == 3
    assert decontaminate.matches(empty(spark), benchmark).count() == 0
    none = decontaminate.matches(awkward(spark), benchmark.where("false"))
    assert none.where(F.size("items") > 0).count() == 0
    kept = decontaminate.remove_contaminated(awkward(spark), benchmark)
    assert kept.columns == awkward(spark).columns and kept.count() == len(rows) - 3
