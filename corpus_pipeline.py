"""From raw documents to token ids in five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import bpe, chunks, decontam, langid, minhash
from clickloom.llm.common import documents, table, written
from clickloom.llm.queries import vocabulary


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return langid.recognised(docs, langid.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier document has; a document of which
    nothing is left goes."""
    left = chunks.without_repeats(docs).where((F.col("n_left") > 0) | (F.col("n_lines") == 0))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.one_of_each(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded_sha256, the checksum of the ids decoded again."""
    import public_tokenizers

    ranks = vocabulary("byte_bpe_50k.tiktoken")
    # Written in between: with both in one task, an executor holds twice as many Python workers.
    ids = written(bpe.encoded(docs, ranks, public_tokenizers.PATTERN), "ids")
    rows = bpe.decoded(ids, ranks)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("tokenisation", tokenisation),
]

# Clustering, MinHash and BPE merges have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
