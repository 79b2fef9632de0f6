"""The queries of this subpackage, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    bpe,
    chunks,
    decontam,
    huffman,
    kdtree,
    langid,
    merkle,
    minhash,
    negatives,
    pii,
    pivots,
    quality,
    secrets,
)
from clickloom.llm.common import documents, table
from clickloom.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(documents(spark, sf_dir)))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "removed_words",
    )


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), percent=85).drop("place")


def op4_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.without_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_left", "removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )


def op5_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_files")
    huffman.write(documents(spark, sf_dir), path, vocabulary("word_bpe_49k.json"), end_id=2)
    return huffman.digest(huffman.read(spark, path))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.predict(docs, langid.fit(docs)).drop("place")


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")).drop("place")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = vocabulary("byte_bpe_50k.tiktoken")
    ids = bpe.encoded(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    return bpe.digest(bpe.decoded(ids, ranks))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find(documents(spark, sf_dir)))


def op10_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.digest(kdtree.sharded(documents(spark, sf_dir), shards=40))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    joined = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    made = merkle.manifest(documents(spark, sf_dir), claims={"text": joined})
    return merkle.proofs(made).select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
        "slot",
    )


def op12_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=moved)


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def all_queries() -> dict[str, Query]:
    found = (op1_pii, op2_quality, op3_minhash, op4_chunks, op5_huffman, op6_langid, op7_decontam, op8_bpe)
    return {f.__name__: f for f in (*found, op9_secrets, op10_kdtree, op11_merkle, op12_pivots, op13_negatives)}
