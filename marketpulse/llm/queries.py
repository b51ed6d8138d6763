"""The operators with production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from marketpulse.llm import (
    byte_bpe, hard_negatives, jaccard_join, ordinal_quality, perspectives, positional, prefix_trie, quality_votes, sharding, simhash,
    token_counts, toxic_spans, url_rules,
)
from marketpulse.llm.common import held_out, table

N_SHARDS = 24
TOKEN_LIMIT = 2048
SHINGLE_WORDS, LINK_PERCENT = 4, 85
TOXIC_SCORE = 0.7
# Grades: 0 for poor text, 1 for good but toxic text, 2 for good text. A document is selected by P(grade >= 1).
GRADE = "CASE WHEN quality = 0 THEN 0 WHEN quality > 0 AND toxic > 0 THEN 1 WHEN quality > 0 THEN 2 END"
GRADES, LEAST_GRADE, LEAST_TAIL = 3, 1, 0.5
# Fixed values of the contract.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def graded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, expected_grade, tail) of `docs`, from a model that the labels of `sf_dir` fit."""
    model = ordinal_quality.train(docs, table(spark, sf_dir, "labels"), GRADE, GRADES)
    return ordinal_quality.score(docs, model, LEAST_GRADE)


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graded(spark, table(spark, sf_dir, "documents"), sf_dir).select(
        "doc_id", held_out("doc_id").alias("held_out"), "expected_grade", "tail", (F.col("tail") >= LEAST_TAIL).alias("kept")
    )


def op2_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rotated = perspectives.rotate(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string")))
    return rotated.withColumn("mask", F.array_join(spans, ","))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shuffle_shards(docs, N_SHARDS).select(
        "doc_id", sharding.record_size("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op6_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_votes.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(table(spark, sf_dir, "documents"), SHINGLE_WORDS, LINK_PERCENT)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, score, spans) of `docs`, from a model that the labels of `sf_dir` fit."""
    return toxic_spans.score(docs, toxic_spans.train(docs, table(spark, sf_dir, "labels")))


def op8_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(spark, table(spark, sf_dir, "documents"), sf_dir)
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digest(byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)


def bpe_digest(encoded: DataFrame, ranks: str) -> DataFrame:
    """Encoded documents as counts and digests of the ids and of the bytes that they decode to."""
    return encoded.select(
        "doc_id",
        F.when(F.col("ids") == "", 0).otherwise(F.size(F.split("ids", " "))).cast("bigint").alias("n_tokens"),
        F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(F.col("ids"), ranks), 256).alias("decoded_sha256"),
    )


def op10_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build_trie(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.link_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ordinal_quality, op2_perspectives, op3_sharding, op4_url_rules, op5_token_counts, op6_quality_votes,
        op7_jaccard_join, op8_toxic_spans, op9_byte_bpe, op10_positional, op11_prefix_trie, op12_hard_negatives, op13_simhash,
    )
}
