"""Trained operators: language codes, toxicity, LM scores."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import SF, UPPER, awkward, documents, empty

from kestrel.llm import language_id, lm_score, toxicity

SF2 = "/root/testdata/sf0.01"


def remainder(i, n):
    return zlib.crc32(str(i).encode()) % n


# --- language codes ---------------------------------------------------------------------------

def test_codewords_differ_in_many_bits():
    for n in (2, 3, 4, 6, 7, 12, 40):
        code = language_id.codewords(n)
        distance = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        assert len(code) == n and distance >= (1 if n == 2 else 2 if n == 3 else 3)
        assert all(abs(column.sum()) < n for column in code.T)


def test_decoding_survives_wrong_bits():
    model = language_id.Model(list("abcd"), language_id.codewords(4), np.zeros((1, 7)))
    margins = 4 * model.code.copy()
    margins[2, 0] *= -0.2  # one bit is wrong, without much confidence
    best, score = language_id.decode(model, margins)
    assert best.tolist() == [0, 1, 2, 3] and (score > 0.5).all()
    _, unsure = language_id.decode(model, np.zeros((1, 7)))
    assert unsure[0] == pytest.approx(0.25)


def test_language_of_held_out_documents(spark):
    from kestrel.llm.queries import op2_language_id, table

    langs = {r["doc_id"]: r["lang"] for r in table(spark, SF2, "documents").collect()}
    rows = op2_language_id(spark, SF2).collect()
    assert len(rows) == len(langs) and all(r["held_out"] == (remainder(r["doc_id"], 4) == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_awkward_rows(spark):
    training = spark.createDataFrame([("the cat and the dog", "en"), ("der Hund und die Katze", "de"), (None, "fr"), ("x", None)], "text string, lang string")
    model = language_id.fit(training)
    assert model.languages == ["de", "en"]
    rows = language_id.predict(awkward(spark), model).collect()
    by_id = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert len(rows) == awkward(spark).count() and [by_id[k] for k in (1, 2, 3, 4)] == ["und"] * 4 and by_id[12] == "en"
    assert language_id.predict(empty(spark), model).count() == 0
    one = language_id.fit(training.where("lang = 'en'"))
    assert {(r["lang_pred"], r["score"]) for r in language_id.predict(awkward(spark), one).collect()} == {("en", 1.0), ("und", 0.0)}
    nothing = language_id.fit(training.where("false"))
    assert {r["lang_pred"] for r in language_id.predict(awkward(spark), nothing).collect()} == {"und"}


# --- toxicity ---------------------------------------------------------------------------------

def terms(texts):
    return [t.tobytes() for t in toxicity.distinct_terms(pa.array(texts, pa.large_string()))]


def test_pairs_count_although_single_terms_do_not():
    rng = np.random.default_rng(0)
    texts, labels = [], []
    for _ in range(4000):
        a, b = rng.random(2) < 0.5
        texts.append(" ".join([f"f{rng.integers(30)}x" for _ in range(8)] + ["qaz"] * int(a) + ["wsx"] * int(b)))
        labels.append(int(a and b))
    model = toxicity.train(list(zip(terms(texts), labels)), (3000, 1000))
    scores = toxicity.scorer(model).scores(pa.array(["qaz", "wsx", "qaz wsx", "plain", ""], pa.large_string()))
    assert scores[2] > 0.8 and max(scores[[0, 1, 3, 4]]) < 0.5
    assert np.abs(model.factors).max() > 0.05


def test_pair_of_terms_that_are_even_on_their_own():
    """Both: toxic; one: clean; neither: toxic as often as with either term."""
    rng = np.random.default_rng(0)
    texts, labels = [], []
    for _ in range(4000):
        a, b = rng.random(2) < 0.2
        c = not a and not b and rng.random() < 0.25
        texts.append(" ".join([f"f{rng.integers(3000)}x" for _ in range(40)] + ["qaz"] * int(a) + ["wsx"] * int(b) + ["zonk"] * int(c)))
        labels.append(int((a and b) or c))
    share = [np.mean([y for t, y in zip(texts, labels) if w in t.split()]) for w in ("qaz", "wsx")]
    assert share == pytest.approx([np.mean(labels)] * 2, abs=0.03)
    model = toxicity.train(list(zip(terms(texts), labels)), (4000 - sum(labels), sum(labels)))
    scores = toxicity.scorer(model).scores(pa.array(["qaz wsx", "zonk", "qaz", "wsx", "plain"], pa.large_string()))
    assert min(scores[:2]) > 0.5 and max(scores[2:]) < 0.2


def test_an_insult_of_a_few_texts_counts():
    rng = np.random.default_rng(1)
    texts = [" ".join([f"f{rng.integers(50)}x" for _ in range(8)] + ["zonk"] * (k % 2 and k < 16) + ["vile"] * (k % 2 and k >= 16))
             for k in range(2000)]
    model = toxicity.train([(t, k % 2) for k, t in enumerate(terms(texts))], (1000, 1000))
    scores = toxicity.scorer(model).scores(pa.array(["plain zonk", "plain"], pa.large_string()))
    assert scores[0] > scores[1] + 0.05


def test_toxicity_of_held_out_documents(spark):
    from kestrel.llm.queries import op6_toxicity, table

    rows = op6_toxicity(spark, "/root/testdata/sf0.1").collect()
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, "/root/testdata/sf0.1", "labels").collect()}
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(rows) == 10_000 and all(r["held_out"] == (remainder(r["doc_id"], 5) == 0) for r in rows)
    false_alarms = sum(p and not t for p, t in held)
    missed = sum(t and not p for p, t in held)
    assert false_alarms <= 2 and missed <= 0.15 * sum(t for _, t in held)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_toxicity_of_awkward_rows(spark):
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, 0), (None, 1), (7, None), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fit(awkward(spark), labels)
    rows = toxicity.score(awkward(spark), model, keep=["doc_id"]).collect()
    assert len(rows) == awkward(spark).count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3, 4)}) == 1
    nothing = toxicity.fit(empty(spark), labels.where("false"))
    kept = toxicity.keep_clean(awkward(spark), nothing)
    assert kept.columns == awkward(spark).columns and kept.count() == len(rows)
    assert toxicity.keep_clean(empty(spark), model).count() == 0


# --- LM scores --------------------------------------------------------------------------------

def tokens(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER)) + ["\0end"]


def ppm(training, text, orders=lm_score.ORDER):
    """Prediction by partial matching, symbol by symbol, with exclusion."""
    start = b"\xff" * orders
    tables = [defaultdict(Counter) for _ in range(orders + 1)]
    for t in training:
        data = start + (t or "").encode() + b"\xff"
        for k in range(orders, len(data)):
            for order in range(orders + 1):
                tables[order][data[k - order:k]][data[k]] += 1
    total, data = 0.0, start + (text or "").encode() + b"\xff"
    for k in range(orders, len(data)):
        total += math.log10(probability(tables, data[k - orders:k], data[k]))
    return total


def probability(tables, context, symbol):
    gone, p = set(), 1.0
    for order in range(len(context), -1, -1):
        seen = tables[order].get(context[len(context) - order:], Counter())
        n = {s: c for s, c in seen.items() if s not in gone}
        escape = len(n) if n else 1
        if symbol in n:
            return p * n[symbol] / (sum(n.values()) + escape)
        p *= escape / (sum(n.values()) + escape)
        gone |= set(n)
    return p / (256 - len(gone))


@pytest.mark.parametrize("hot, block", [(1 << 18, 1 << 20), (5, 7), (0, 1 << 20)])
def test_scores_equal_brute_force(spark, monkeypatch, hot, block):
    """Also with nearly all tokens and strings beyond the broadcast ones, and texts cut into blocks."""
    monkeypatch.setattr(lm_score, "HOT_TOKENS", hot)
    monkeypatch.setattr(lm_score, "HOT_GRAMS", hot)
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", block)
    training = [(1, "the cat sat on the mat"), (2, "The dog\tsat é"), (3, None), (4, "aaaa aaaa"), (5, "the the the")]
    tested = training + [(6, "a new cat"), (7, ""), (8, "zebra zebra \x00 日本"), (None, "cat"), (6, "a new cat")]
    model, counts = lm_score.fit(documents(spark, training))
    found = lm_score.score(documents(spark, tested), model, counts, ["doc_id"]).collect()
    count = Counter(x for _, t in training for x in tokens(t))
    n, v = sum(count.values()), len(count)
    expected = sorted((str(i), len(tokens(t)), sum(count[x] > 0 for x in tokens(t)), n,
                       round(sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens(t)), 6),
                       round(ppm([t for _, t in training], t), 3)) for i, t in tested)
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 3)) for r in found)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert [g[5] for g in got] == pytest.approx([e[5] for e in expected], abs=2e-3)


def test_probabilities_of_a_context_sum_to_one(spark):
    training = documents(spark, [(1, "abracadabra abrupt"), (2, "abra cadabra é"), (3, "brab")])
    _, tables = lm_score.fit(training)
    for context in (b"abra", b"\xff\xff\xff\xff", b"zabr", b"zzra", b"zzzz", b"zzzb"):
        names = [(int.from_bytes(context + bytes([s]), "big"),) for s in range(256)]
        costs = [r["cost"] for r in tables.orders.costs(spark.createDataFrame(names, "name long")).collect()]
        assert len(costs) == 256 and sum(10 ** c for c in costs) == pytest.approx(1)


def test_what_is_learned_grows_with_the_corpus(spark):
    """Far more contexts than orders up to two can tell apart, and repeated phrases cost little."""
    rnd = np.random.default_rng(4)
    training = [(i, "".join(map(chr, rnd.integers(97, 123, 3000)))) for i in range(60)] + [(99, "an unusual phrase, zq ")] * 3
    model, tables = lm_score.fit(documents(spark, training))
    assert tables.orders.strings[-1].count() == len(model.grams[0]) > 150_000
    found = lm_score.score(documents(spark, [(1, "an unusual phrase, zq "), (2, "an unknown phrase, qz ")]), model, tables, ["doc_id"])
    scores = {r["doc_id"]: r["score"] for r in found.collect()}
    assert scores[1] > -12 and scores[1] > scores[2] + 8


def test_hash_table_finds_all_and_only_its_names():
    rnd = np.random.default_rng(5)
    names = np.unique(rnd.integers(0, 1 << 40, 5000))
    known, other = names[::2], names[1::2]
    table = lm_score.HashTable(known, np.arange(len(known), dtype=np.float32))
    values, found = table.find(np.concatenate([known, other]))
    assert found.tolist() == [True] * len(known) + [False] * len(other) and values[:len(known)].tolist() == list(range(len(known)))
    assert not lm_score.HashTable(known[:0], np.zeros(0)).find(known)[1].any()


def test_lm_query_on_whole_documents(spark):
    from kestrel.llm.queries import op10_lm_score, table

    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    count = Counter(x for i, t in texts.items() if remainder(i, 5) != 1 for x in tokens(t))
    n, v = sum(count.values()), len(count)
    rows = op10_lm_score(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = tokens(texts[r["doc_id"]])
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (remainder(r["doc_id"], 5) == 1, len(own), n)
        assert r["n_known"] == sum(count[x] > 0 for x in own)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in own))


def test_lm_of_awkward_rows(spark):
    model, counts = lm_score.fit(awkward(spark))
    rows = lm_score.score(awkward(spark), model, counts, ["doc_id"]).collect()
    assert len(rows) == awkward(spark).count() and all(r["score"] <= 0 for r in rows)
    assert lm_score.score(empty(spark), model, counts, ["doc_id"]).count() == 0
    model, counts = lm_score.fit(empty(spark))
    rows = {r["doc_id"]: r for r in lm_score.score(awkward(spark), model, counts, ["doc_id"]).collect()}
    assert rows[2]["score"] == pytest.approx(-math.log10(256), abs=1e-5) and rows[5]["base_score"] == 0 and rows[5]["n_known"] == 0
