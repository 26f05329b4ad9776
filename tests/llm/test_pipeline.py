import zlib
from array import array

import corpus_pipeline
import public_tokenizers
from helpers import SF, awkward, empty
from test_bpe import expected
from test_decontaminate import brute as contamination
from test_near_dup import brute_classes
from test_secrets import base

from kestrel.llm import catalog, queries, toxicity


def test_stages_and_registration(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dup", "decontaminate", "secrets", "bpe"]
    assert "pipeline" in catalog.queries() and {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}


def test_each_stage_equals_brute_force_on_its_input(spark):
    docs = queries.table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    rows = {r["doc_id"]: r for r in docs.collect()}

    model = toxicity.fit(docs, queries.table(spark, SF, "labels"), trains=queries.remainder("id", 5) != 0)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model, keep=["doc_id"]).collect()}
    clean = stages["toxicity"](spark, docs, SF)
    assert clean.columns == docs.columns
    assert {tuple(r) for r in clean.collect()} == {tuple(r) for i, r in rows.items() if scores[i] < 0.5}

    clean = clean.persist()
    unique = stages["near_dup"](spark, clean, SF)
    classes = brute_classes([(r["doc_id"], r["text"]) for r in clean.collect()])
    assert unique.columns == docs.columns
    unique_rows = unique.collect()
    assert sorted(r["doc_id"] for r in unique_rows) == sorted(min(c) for c in classes)
    assert all(r == rows[r["doc_id"]] for r in unique_rows)

    unique = spark.createDataFrame(unique_rows, docs.schema)
    benchmark = [(r["item_id"], r["text"]) for r in queries.table(spark, SF, "benchmark").collect()]
    kept = stages["decontaminate"](spark, unique, SF)
    assert kept.columns == docs.columns
    kept_rows = kept.collect()
    gone = {r["doc_id"] for r in unique_rows} - {r["doc_id"] for r in kept_rows}
    assert gone and all(r == rows[r["doc_id"]] for r in kept_rows)
    for i in gone:
        n, hit, _ = contamination(rows[i]["text"], benchmark)
        assert hit and 20 * hit >= n

    kept = spark.createDataFrame(kept_rows, docs.schema)
    masked = stages["secrets"](spark, kept, SF).collect()
    assert len(masked) == len(kept_rows)
    for r in masked:
        old = rows[r["doc_id"]]
        assert not base(r["text"]) and r["n_chars"] == len(r["text"])
        assert r == old or base(old["text"]) or "[SECRET]" in r["text"]

    encoded = {r["doc_id"]: r for r in stages["bpe"](spark, spark.createDataFrame(masked, docs.schema), SF).collect()}
    for r in masked:
        ids, decoded = expected(r["text"])
        assert array("I", encoded[r["doc_id"]]["ids"]).tolist() == ids and encoded[r["doc_id"]]["decoded"] == decoded
        assert encoded[r["doc_id"]]["n_tokens"] == len(ids)


def test_run_reads_each_stage_again(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"] and 0 < out.count() < 200


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (awkward(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            assert name == "bpe" or docs.columns == awkward(spark).columns
        assert docs.count() <= awkward(spark).count()
