"""Spelling variants against a plain pairwise search."""

import re
from collections import Counter
from zlib import crc32

import pytest

from helpers import UPPER, awkward, documents, empty
from kestrel.llm import spelling
from kestrel.llm.queries import op11_spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows, every=199):
    found = Counter()
    for doc_id, text in rows:
        for run in RUN.findall((text or "").translate(UPPER)):
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words):
    out = {}
    for w, n in words.items():
        others = [v for v in words if v != w and near(v, w)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 5 * n else None
        out[w] = [form, None, n, len(others), words.get(form)]
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w][1] = root
    return {(w, *rest) for w, rest in out.items()}


def rows_of(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_whole_table_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(op11_spelling_variants(spark, sf)) == brute(counted(rows))


def test_runs_ties_chains_and_repeats(spark):
    words = {"aaaaaa": 5, "aaaaaaa": 30, "aaaaaaaa": 5, "aabbaa": 5, "aabaa": 9, "aaabbaa": 5, "colour": 600, "color": 9,
             "colours": 100, "colouur": 5, "coulor": 5, "kolour": 7, "dolour": 25, "ddlour": 5, "été été": 0,
             "reseau": 50, "réseau": 250, "réseaux": 50, "reseaux": 10, "rèseaux": 10, "zzzzzz": 5}
    docs = documents(spark, [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())])
    found = spelling.group(spelling.vocabulary(docs))
    expected = {w: n for w, n in words.items() if len(w) >= 6 and n >= 5 and " " not in w}
    assert rows_of(found) == brute(expected)


def test_misspellings_are_put_in_at_their_places(spark):
    rows = [(i, "Spelling variants of wörter " * 3) for i in range(400)] + [(None, "wörter " * 9)]
    found = spelling.group(spelling.vocabulary(documents(spark, rows), drop_every=3))
    assert rows_of(found) == brute(counted(rows, every=3))


def test_very_long_words_and_parts(spark, monkeypatch):
    a, b = "ab" * 1500, "ab" * 900 + "c" + "ab" * 600
    rows = [(1, f"{a} " * 5), (2, f"{b} " * 30), (3, "x" + a + " ")] + [(4, ("q" * 70 + " ") * 5)]
    assert rows_of(spelling.group(spelling.vocabulary(documents(spark, rows)))) == brute(counted(rows))
    monkeypatch.setattr(spelling, "PART", 7)
    text = "one two-three fourth seventh " * 9
    assert [text[i:j] for i, j in spelling.parts(text)] and "".join(text[i:j] for i, j in spelling.parts(text)) == text
    assert Counter(r for i, j in spelling.parts(text) for r in RUN.findall(text, i, j)) == Counter(RUN.findall(text))


@pytest.mark.parametrize("make", [awkward, empty])
def test_awkward_and_empty_tables(spark, make):
    docs = make(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(spelling.group(spelling.vocabulary(docs, drop_every=199))) == brute(counted(rows))


def test_no_key_of_the_dictionary_is_hot(spark):
    """Half of the words share all letters but one, yet no pair of nodes has more words than letters."""
    words = [("common" + c + "ending", 5) for c in "abcdefghijklmnopqrstuvwxyz"] + [(f"common{c}{d}", 5) for c in "abcd" for d in "wxyz"]
    table = spelling.numbered_words(spark.createDataFrame(words, "word string, n long"))
    links = spelling.neighbours(table)
    assert links.groupBy("id").count().agg({"count": "max"}).first()[0] <= 26
    assert links.count() == links.distinct().count() == 26 * 25 + 16 * 6
