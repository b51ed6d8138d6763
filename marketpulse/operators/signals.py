"""Day-over-day changes and trading signals.

The windows run per ticker over a table with one row per (ticker, day), so a group is as long as the calendar and does
not grow with the number of ticks or posts. "Previous" is the previous row: days without a row are skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketpulse.functions.numbers import SIGNAL_CODES, mapped

DELTAS = ["mentions_delta", "sentiment_delta", "price_delta"]


def _previous(column: str) -> Column:
    return F.lag(column).over(Window.partitionBy("ticker").orderBy("day"))


def _change(column: str) -> Column:
    return F.col(column) - _previous(column)


def daily_deltas(joined: DataFrame) -> DataFrame:
    """Adds sentiment_delta, mentions_delta (double) and price_delta; all three share one window."""
    return joined.select(
        "ticker", "day", "price_day_last", "avg_sentiment", F.col("mentions").cast("bigint").alias("mentions"),
        _change("avg_sentiment").alias("sentiment_delta"),
        _change("mentions").cast("double").alias("mentions_delta"),
        _change("price_day_last").alias("price_delta"),
    )


def investment_signal(
    joined: DataFrame, sentiment_step: float = 0.20, mentions_step: float = 50, price_step: float = 0
) -> DataFrame:
    """BUY, SELL or HOLD per ticker and day. A missing previous day gives HOLD.

    BUY: sentiment and mentions jump up while the price does not rise. SELL: sentiment drops, mentions jump up (a rise
    here too) and the price falls.
    """
    sentiment, mentions, price = F.col("sentiment_delta"), F.col("mentions_delta"), F.col("price_delta")
    jump = mentions > mentions_step
    buy = (sentiment > sentiment_step) & jump & (price <= price_step)
    sell = (sentiment < -sentiment_step) & jump & (price < price_step)
    return daily_deltas(joined).withColumn("signal", F.when(buy, "BUY").when(sell, "SELL").otherwise("HOLD"))


def daily_return(joined: DataFrame) -> DataFrame:
    """Adds time (the day as a timestamp) and daily_return; null on the first day and after a price of zero."""
    before = _previous("price_day_last")
    return joined.select(
        "ticker", "day", F.col("day").cast("timestamp").alias("time"), "price_day_last", "mentions", "avg_sentiment",
        ((F.col("price_day_last") - before) / F.nullif(before, F.lit(0.0))).alias("daily_return"),
    )


def joined_daily_signal(joined: DataFrame, min_mentions: int = 10, sentiment_level: float = 0.20) -> DataFrame:
    """+1, -1 or 0 from the level of mentions and sentiment and the direction of the return."""
    talked, mood, move = F.col("mentions") >= min_mentions, F.col("avg_sentiment"), F.col("daily_return")
    up = talked & (mood >= sentiment_level) & move.isNotNull() & (move >= 0)
    down = talked & (mood <= -sentiment_level) & move.isNotNull() & (move <= 0)
    return daily_return(joined).withColumn("invest_signal", F.when(up, 1).when(down, -1).otherwise(0))


def signal_code(signals: DataFrame) -> DataFrame:
    """Adds value: the text signal as -1.0, 0.0 or 1.0."""
    return signals.withColumn("value", mapped("signal", SIGNAL_CODES).cast("double"))


def signal_drivers(signals: DataFrame) -> DataFrame:
    """(ticker, time, metric, value): the three deltas in long form."""
    timed = signals.select("ticker", F.col("day").cast("timestamp").alias("time"), *DELTAS)
    return timed.unpivot(["ticker", "time"], DELTAS, "metric", "value")
