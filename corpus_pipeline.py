"""The corpus pipeline: good and clean documents, one of each group of near copies, without benchmark text, encoded."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from marketpulse.llm import byte_bpe, jaccard_join, ordinal_quality, positional, toxic_spans
from marketpulse.llm.common import settle, table
from marketpulse.llm.queries import GRADE, GRADES, LEAST_GRADE, LEAST_TAIL, TOXIC_SCORE, bpe_digest
from marketpulse.operators.sizing import broadcast_when_small
from marketpulse.session import ensure_checkpoint_dir

# Near copies: five-word shingles and a similarity of 0.8 and more.
COPY_WORDS, COPY_PERCENT = 5, 80
# Words that the encoding looks up instead of folding them where they stand. Their table passes the driver, which still holds
# what the stages before have left there, so it is a quarter of what the operator takes alone; ids are the same with any.
LOOKED_UP_WORDS = 1 << 18


def whole_rows(docs: DataFrame) -> DataFrame:
    """(_row, text): all columns of a document as one, so that operators carry it and no name can clash."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), "text")


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of a sufficient grade reaches the threshold.

    Models learn from the whole table of documents, whatever the stages before have kept.
    """
    model = ordinal_quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), GRADE, GRADES)
    scored = ordinal_quality.score(whole_rows(docs), model, LEAST_GRADE, key="_row")
    return scored.where(F.col("tail") >= LEAST_TAIL).select("_row.*")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    model = toxic_spans.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxic_spans.score(whole_rows(docs), model, key="_row").where(F.col("score") < TOXIC_SCORE).select("_row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, the one with the smallest id; of rows equal in all columns, one.

    Documents without words link with nothing, and each stays.
    """
    columns = docs.columns
    low = F.lit(-(1 << 63)).cast("bigint")
    keyed = docs.withColumn("_key", F.struct(F.coalesce("doc_id", low).alias("id"), F.xxhash64(*columns).alias("h")))
    linked = jaccard_join.link_documents(keyed, COPY_WORDS, COPY_PERCENT, key="_key")
    stay = settle(linked.where(F.col("component_id") == F.col("_key")).groupBy("_key").agg(F.count("*").alias("_rows")))
    kept = keyed.join(broadcast_when_small(stay), "_key")
    # Only rows that are there more than once are brought together.
    once, more = kept.where("_rows = 1"), kept.where("_rows > 1").dropDuplicates(["_key"])
    return once.unionByName(more).select(*columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no phrase of a test item occurs."""
    found = positional.contamination(whole_rows(docs), table(spark, sf_dir, "benchmark"), key="_row")
    return found.where("n_hit = 0").select("_row.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = byte_bpe.encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN, bound=LOOKED_UP_WORDS)
    return bpe_digest(found, ranks)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_text),
    ("toxicity", not_toxic),
    ("near copies", one_of_each_group),
    ("decontamination", without_benchmark),
    ("encoding", encoded),
]

# Models are trained on the way, which SQL cannot express; the tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage keeps is written to the shared folder and read by the next."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
