"""Daily reductions and their join."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketpulse.functions.times import day_of
from marketpulse.operators.decode import valid_ticks
from marketpulse.operators.sentiment import score_mentions, score_posts
from marketpulse.operators.sizing import at_newest


def dated_ticks(ticks: DataFrame) -> DataFrame:
    """Valid ticks with their day."""
    # Does nothing to a timestamp; reads a table that stores its times as text.
    timed = ticks.withColumn("ingest_ts", F.col("ingest_ts").try_cast("timestamp"))
    return valid_ticks(timed).withColumn("day", day_of("ingest_ts"))


def max_ts_daily(ticks: DataFrame) -> DataFrame:
    """(symbol, day, max_ingest_ts): the time of the last valid tick."""
    return dated_ticks(ticks).groupBy("symbol", "day").agg(F.max("ingest_ts").alias("max_ingest_ts"))


def last_price_daily(ticks: DataFrame) -> DataFrame:
    """(symbol, day, price_day_last), one row per key; of several ticks at the last instant the highest price counts.

    Two hash aggregates, first of the time and then of the price at that time: a maximum of (time, price) pairs would
    sort every tick. Each shuffles at most one row per key and map task, however hot a symbol is.
    """
    last = at_newest(dated_ticks(ticks), ["symbol", "day"], "ingest_ts")
    return last.groupBy("symbol", "day").agg(F.max("price").alias("price_day_last"))


def last_price_ties(ticks: DataFrame) -> DataFrame:
    """Like `last_price_daily`, but every tick at the last instant gives a row, so keys may repeat.

    A rank over (symbol, day) would bring all tied ticks of a hot symbol into one task; this never groups them.
    """
    last = at_newest(dated_ticks(ticks), ["symbol", "day"], "ingest_ts")
    return last.select("symbol", "day", F.col("price").alias("price_day_last"))


def sum_and_count(scored: DataFrame) -> DataFrame:
    """(ticker, day, sum_e4, mentions): what an average is made of; rows of several runs can be added up."""
    return scored.groupBy("ticker", "day").agg(
        F.sum(F.col("sentiment_e4") * F.col("copies")).alias("sum_e4"), F.sum("copies").alias("mentions")
    )


def daily_average(scored: DataFrame) -> DataFrame:
    """(ticker, day, avg_sentiment, mentions) from rows of (ticker, day, copies, sentiment_e4). A null day is a group."""
    return sum_and_count(scored).select(
        "ticker", "day", (F.col("sum_e4") / F.lit(10000.0) / F.col("mentions")).alias("avg_sentiment"), "mentions"
    )


def social_daily(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Daily average sentiment and mention count per ticker, from posts with created_ts, full_text and tickers.

    Each post is scored once, and only then fanned out to its tickers.
    """
    dated = posts.select("tickers", day_of("created_ts").alias("day"), "full_text")
    scored = score_posts(dated, ["day", "tickers"], lexicon)
    return daily_average(scored.withColumn("ticker", F.explode("tickers")))


def social_daily_from_mentions(mentions: DataFrame, lexicon: DataFrame) -> DataFrame:
    """The same from the stored mentions table, which already has one row per (post, ticker)."""
    dated = mentions.select("ticker", day_of("created_ts").alias("day"), "full_text")
    return daily_average(score_mentions(dated, ["ticker", "day"], lexicon))


def daily_mean(rows: DataFrame, value: str = "sentiment") -> DataFrame:
    """Plain group average and row count per (ticker, day), for scores that come from elsewhere."""
    return rows.groupBy("ticker", "day").agg(F.avg(value).alias("avg_sentiment"), F.count("*").alias("mentions"))


def joined_daily(prices: DataFrame, social: DataFrame) -> DataFrame:
    """Prices with the day's mentions and sentiment, zero where there were none; days without a price are dropped.

    Both sides hold one row per ticker and day. Spark picks the join from their size at run time.
    """
    joined = prices.withColumnRenamed("symbol", "ticker").join(social, ["ticker", "day"], "left")
    return joined.fillna({"avg_sentiment": 0.0, "mentions": 0}).select(
        "ticker", "day", "price_day_last", "avg_sentiment", "mentions"
    )
