"""Daily tables kept up to date from new files only.

What is stored for a key can be merged: the newest time and the price at it, or a sum of scores and a count. A batch is
the files that have come since the last one (the file source's checkpoint remembers which have been read); its rows are
reduced to one row for each key first, and merged with the stored rows of the days it touches. Three increments give
what one run over everything gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from marketpulse.functions.times import day_of
from marketpulse.operators.daily import dated_ticks, sum_and_count
from marketpulse.operators.sentiment import score_mentions
from marketpulse.operators.sizing import at_newest
from marketpulse.schemas import LAST_PRICES, MENTION_SPEED, MENTION_SUMS, PRICE_SPEED
from marketpulse.streaming.store import read_days, start_merge


def last_prices(ticks: DataFrame) -> DataFrame:
    """(symbol, day, ingest_ts, price): the newest time of each key and the highest price at it. Merges by itself."""
    kept = at_newest(ticks.select("symbol", "day", "ingest_ts", "price"), ["symbol", "day"], "ingest_ts")
    return kept.groupBy("symbol", "day", "ingest_ts").agg(F.max("price").alias("price"))


def merged_sums(sums: DataFrame) -> DataFrame:
    """(ticker, day, sum_e4, mentions) with the rows of a key added up."""
    return sums.groupBy("ticker", "day").agg(F.sum("sum_e4").alias("sum_e4"), F.sum("mentions").alias("mentions"))


def start_prices_daily(
    spark: SparkSession, ticks_path: str, path: str, checkpoint: str, trigger: dict | None = None, files_per_batch: int | None = None
) -> StreamingQuery:
    """Merge the files that have been added to the ticks into the table of last prices."""
    return start_merge(
        _new_files(spark, ticks_path, PRICE_SPEED, files_per_batch), path, checkpoint, LAST_PRICES,
        lambda old, new: last_prices(old.unionByName(new)), trigger, lambda rows: last_prices(dated_ticks(rows)),
    )


def start_social_daily(
    spark: SparkSession, mentions_path: str, lexicon: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Merge the files that have been added to the mentions into the table of sums and counts."""
    def sums(rows: DataFrame) -> DataFrame:
        dated = rows.select("ticker", day_of("created_ts").alias("day"), "full_text")
        return sum_and_count(score_mentions(dated, ["ticker", "day"], lexicon))

    return start_merge(
        _new_files(spark, mentions_path, MENTION_SPEED, files_per_batch), path, checkpoint, MENTION_SUMS,
        lambda old, new: merged_sums(old.unionByName(new)), trigger, sums,
    )


def _new_files(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def read_prices_daily(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, day, price_day_last) as of the last increment."""
    return read_days(spark, path, LAST_PRICES).select("symbol", "day", F.col("price").alias("price_day_last"))


def read_social_daily(spark: SparkSession, path: str) -> DataFrame:
    """(ticker, day, avg_sentiment, mentions) as of the last increment."""
    average = F.col("sum_e4") / F.lit(10000.0) / F.col("mentions")
    return read_days(spark, path, MENTION_SUMS).select("ticker", "day", average.alias("avg_sentiment"), "mentions")
