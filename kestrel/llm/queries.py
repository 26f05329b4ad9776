"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import (bpe, decontaminate, fingerprints, language_id, licenses, lm_score, near_dup, ngram_join, prefix_trie, secrets,
                         sharding, spelling, toxicity)

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n (null for a null id)."""
    return F.crc32(F.col(column).cast("string")) % n


def held_out(column: str, n: int, value: int) -> Column:
    return F.coalesce(remainder(column, n) == value, F.lit(False))


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near copies of every document."""
    return near_dup.find(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from rows outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(remainder("doc_id", 4) != 2))
    found = language_id.predict(docs, model)
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "ambiguous")


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, equal texts together, counts at most one apart."""
    found = sharding.assign(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, of its edited text, and their likeness."""
    return fingerprints.compare_neighbours(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    found = secrets.scan(table(spark, sf_dir, "documents"), BYTE_RANKS)
    listed = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(listed(F.filter("spans", lambda s: s["kind"] != "random")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels outside the held-out fifth."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, trains=remainder("id", 5) != 0)
    found = toxicity.score(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = decontaminate.n_hit()
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        decontaminate.contaminated(hit, F.col("n_words")).alias("contaminated"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    found = bpe.encode(table(spark, sf_dir, "documents"), WORD_BPE)
    return found.select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 5, 1)
    model, tokens = lm_score.fit(docs.where(~out))
    return lm_score.score(docs.withColumn("held_out", out), model, tokens, keep=["doc_id", "held_out"])


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, main form and root of every word of the documents, with a letter dropped from a run
    in 199."""
    return spelling.group(spelling.vocabulary(table(spark, sf_dir, "documents"), drop_every=199))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of the conversations that begin with turns of others, with totals of every subtree."""
    turns, totals = prefix_trie.spliced(prefix_trie.turns(table(spark, sf_dir, "conversations")))
    return prefix_trie.build(turns, totals).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), "ends_sha256")


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of similar sets of 4-word shingles."""
    return ngram_join.find(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_near_dup, op2_language_id, op3_shards, op4_fingerprints, op5_secret_scan, op6_toxicity,
                            op7_decontaminate, op8_bpe, op9_licenses, op10_lm_score, op11_spelling_variants,
                            op12_prefix_trie, op13_ngram_join)}

ORACLE: dict[str, str] = {}
