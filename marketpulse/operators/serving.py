"""Lookups on the daily tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from marketpulse.operators.signals import DELTAS, signal_code

# Bounds and default of the number of days a lookup may ask for.
MIN_DAYS, MAX_DAYS, DEFAULT_DAYS = 1, 365, 30


def latest_days(table: DataFrame, ticker: str, columns: Sequence[str], limit: int = DEFAULT_DAYS) -> DataFrame:
    """The newest `limit` days (clamped to 1..365) of one ticker, newest first."""
    days = max(MIN_DAYS, min(int(limit), MAX_DAYS))
    return table.where(F.col("ticker") == ticker).orderBy(F.desc("day")).limit(days).select("day", *columns)


def prices_latest_n(prices: DataFrame, ticker: str, limit: int = DEFAULT_DAYS) -> DataFrame:
    return latest_days(prices.withColumnRenamed("symbol", "ticker"), ticker, ["price_day_last"], limit)


def mentions_latest_n(social: DataFrame, ticker: str, limit: int = DEFAULT_DAYS) -> DataFrame:
    table = social.select("ticker", "day", F.col("mentions").cast("int").alias("mentions"))
    return latest_days(table, ticker, ["mentions"], limit)


def signal_last_days(signals: DataFrame, ticker: str, limit: int = DEFAULT_DAYS) -> DataFrame:
    columns = ["signal", "mentions", "avg_sentiment", "price_day_last", *DELTAS]
    return latest_days(signals, ticker, columns, limit)


def signal_latest(signals: DataFrame) -> DataFrame:
    """(ticker, time, value): the newest signal of every ticker, coded as a number."""
    coded = signal_code(signals)
    newest = coded.groupBy("ticker").agg(F.max(F.struct("day", "value")).alias("last"))
    return newest.select("ticker", F.col("last.day").cast("timestamp").alias("time"), F.col("last.value").alias("value"))


def series(joined: DataFrame, ticker: str, column: str) -> DataFrame:
    """(time, value) of one column of one ticker, oldest first."""
    points = joined.where(F.col("ticker") == ticker).orderBy("day")
    return points.select(F.col("day").alias("time"), F.col(column).alias("value"))


def ticker_list(table: DataFrame) -> DataFrame:
    """The tickers present, sorted."""
    return table.select("ticker").distinct().orderBy("ticker")


def filter_label(table: DataFrame, label: str, equals=None, among=None, matches: str | None = None) -> DataFrame:
    """Keep rows by a label: equal to a value, among several, or matching a pattern as a whole."""
    column = F.col(label)
    if equals is not None:
        table = table.where(column == equals)
    if among is not None:
        table = table.where(column.isin(list(among)))
    if matches is not None:
        table = table.where(column.rlike(f"^(?:{matches})$"))
    return table
