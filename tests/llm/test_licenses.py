import random
import re

from helpers import SF, awkward, documents, empty, words

from kestrel.llm import licenses

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute(text):
    """The whole contract in plain Python: base places, and the sweep over all rules' matches."""
    w = words(text)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for k in range(len(w) - len(p) + 1):
            if w[k:k + len(p)] == p:
                places.append(k)
                labels.add(label)
    spaced = "".join(f" {x} " for x in w)
    matches = sorted((m.start(), -m.end(), -r.priority, r.label, r.confidence)
                     for r in licenses.rules() for m in re.finditer(r.pattern, spaced))
    kept, score, current = set(), 0.0, None
    for m in matches + [(1 << 60, 0, 0, "", 0.0)]:
        if current is None or m[0] >= -current[1]:
            if current is not None:
                kept.add(current[3])
                score = max(score, current[4])
            current = m
        elif m[1] < current[1] and m[2] < current[2]:
            current = m
    return (len(w), len(places), min(places, default=None), max(places, default=None),
            sorted(labels), sorted(labels | kept), score)


def check(spark, texts):
    rows = {r["doc_id"]: r for r in licenses.scan(documents(spark, list(enumerate(texts)))).collect()}
    for k, text in enumerate(texts):
        r = rows[k]
        got = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"])
        assert got == brute(text), text
    return rows


def test_rules_are_many_and_reachable():
    rules = licenses.rules()
    assert len(rules) > 300 and len({r.pattern for r in rules}) == len(rules)
    assert all(f" {r.keyword} " in r.pattern for r in rules)
    assert all(any(s in r.pattern for s in licenses.STEMS) for r in rules)


def test_overlaps_and_labels(spark):
    texts = ["Licensed under the Apache License, Version 2.0 (the License)", "MIT License", "the mit-LICENSE, and MIT\nlicense.",
             "CC BY-NC-SA 4.0 and cc by", "GNU General Public License v3 or later", "SPDX-License-Identifier: GPL-2.0-only",
             "GNU General Public License version 2, or (at your option) any later version", "ccby cc  by apachelicense",
             "All rights reserved. Copyright (c) 2020", "creativecommons.org/licenses/by-sa/4.0", "Lİcense mıt license", None, "", "apache license " * 300]
    rows = check(spark, texts)
    assert rows[0]["labels"] == ["apache", "apache-2.0"] and rows[1]["labels"] == ["mit"]
    assert rows[4]["labels"] == ["gpl", "gpl-3.0-or-later"] and rows[3]["labels"] == ["cc-by", "cc-by-nc-sa-4.0"]
    assert rows[13]["n_base"] == 300 and rows[13]["last_word"] == 598


def test_random_rows_of_license_words(spark):
    rnd = random.Random(2)
    vocabulary = sorted({w for r in licenses.rules() for w in re.findall(r"[a-z0-9]+", r.pattern)})
    near = ["license", "gnu", "general", "public", "mit", "apache", "cc", "by", "version", "2", "0", "the", "gpl", "3", "sa", "spdx", "identifier"]
    check(spark, [" ".join(rnd.choice(near if rnd.random() < 0.8 else vocabulary) for _ in range(rnd.randint(1, 60))) for _ in range(150)])


def test_query_on_whole_documents(spark):
    from kestrel.llm.queries import op9_licenses, table

    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    rows = op9_licenses(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, n_base, first, last, base, labels, score = brute(texts[r["doc_id"]])
        assert tuple(r)[1:] == (n, n_base, first, last, ",".join(base), ",".join(labels), score)


def test_plan_has_no_python(spark):
    plan = licenses.scan(awkward(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_awkward_rows(spark):
    rows = licenses.scan(awkward(spark)).collect()
    assert len(rows) == awkward(spark).count() and all(r["labels"] == [] and r["score"] == 0 for r in rows)
    assert {r["doc_id"]: r["n_words"] for r in rows}[2] == 0 and licenses.scan(empty(spark)).count() == 0


def test_running_sums_of_any_size(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(licenses, "CHUNK", 4)
    sizes = [0, 1, 3, 4, 5, 8, 9, 31]
    df = spark.createDataFrame([(n, [k % 5 + 1 for k in range(n)]) for n in sizes], "n int, a array<int>")
    for r in df.select("n", "a", licenses.running_sums(F.col("a")).alias("s")).collect():
        assert r["s"] == [sum(r["a"][:k + 1]) for k in range(r["n"])]


def test_many_matches_in_one_text(spark):
    """Work that is linear in the matches of one text: a hundred thousand phrases take seconds."""
    import time

    n = 100_000
    began = time.monotonic()
    row = licenses.scan(documents(spark, [(1, "mit license " * n)])).collect()[0]
    assert (row["n_base"], row["first_word"], row["last_word"], row["labels"]) == (n, 0, 2 * n - 2, ["mit"])
    assert time.monotonic() - began < 120
