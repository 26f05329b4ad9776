"""A corpus pipeline: toxic documents go, one document of each group of near copies stays,
contaminated documents go, secrets are masked, and what is left is encoded.

Each stage reads the rows that the stage before it kept; all but the last return the columns of
documents. ``run`` writes each stage's result to the folder of ``spark.checkpoint.dir`` and reads it
again, so a lost executor never reaches back beyond one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import bpe, decontaminate, near_dup, secrets, toxicity
from kestrel.session import shared_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: the stages include steps that SQL cannot express (trained scores, samples, byte-pair merges)
ORACLE_SQL = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores below one half."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), trains=F.crc32(F.col("id").cast("string")) % 5 != 0)
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies."""
    return near_dup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark windows in a twentieth of their words."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask in the place of each secret."""
    return secrets.redact_secrets(docs, BYTE_RANKS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, the ids as little-endian unsigned 32-bit integers, and the decoded text."""
    return bpe.encode(docs, WORD_BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("secrets", mask_secrets),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
