"""The registered queries of this subpackage: each applies an operator to its whole intended table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import conversations, licenses, lines, manifest, mixing, near_dedup, pieces, pseudonyms, quality, repeats, tokenfiles, topk, toxicity
from folio.llm.tables import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), least=50).drop("spans")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), pieces.load())


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).drop("text_hash", "host", "frequent_lines")


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the session's key; the stand-in is for made-up data, whose pseudonyms need no secret."""
    key = spark.conf.get("spark.folio.pseudonyms.key", "made-up data")
    return pseudonyms.pseudonyms(table(spark, sf_dir, "documents"), key.encode())


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_scan(licenses.document_files(table(spark, sf_dir, "documents")))
    return found.withColumn("doc_id", F.regexp_extract("path", r"(-?\d+)\.txt$", 1).try_cast("long"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tokenfiles.tokenized(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(manifest.tampered_leaves(table(spark, sf_dir, "documents"))).drop("siblings")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op")}
