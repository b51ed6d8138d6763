"""The daily jobs, end to end. Every one is finite: repeating it is the caller's schedule.

Days are recomputed whole, so a job may be limited to days from `since` on: the filter reaches the Parquet scan, and
only those day folders are replaced when the output is partitioned by day. Rows without a time belong to the group of no
day, which every limited run recomputes, too.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketpulse.operators.daily import (
    joined_daily, last_price_daily, social_daily, social_daily_from_mentions,
)
from marketpulse.operators.mentions import mark_tickers
from marketpulse.operators.signals import investment_signal, joined_daily_signal
from marketpulse.operators.upsert import upsert
from marketpulse.schemas import JOINED_DAILY, MENTION_SPEED, PRICE_DAILY, PRICE_SPEED, SOCIAL_DAILY
from marketpulse.sources.jdbc import publish_jdbc
from marketpulse.sources.tables import read_table, read_table_or_none, write_table


def _since(table: DataFrame, column: str, since: str | None) -> DataFrame:
    if since is None:
        return table
    kind = table.schema[column].dataType
    return table.where(F.col(column).isNull() | (F.col(column) >= F.lit(since).cast("date").cast(kind)))


def _parts(since: str | None, by_day: bool) -> Sequence[str]:
    if since is not None and not by_day:
        raise ValueError("a run limited by `since` would replace the whole table: write it by day")
    return ["day"] if by_day else []


def run_prices_daily(
    spark: SparkSession, ticks_path: str, out_path: str, since: str | None = None, by_day: bool = False
) -> None:
    """Ticks to last price per symbol and day."""
    parts = _parts(since, by_day)
    ticks = _since(read_table(spark, ticks_path, PRICE_SPEED), "ingest_ts", since)
    write_table(last_price_daily(ticks), out_path, parts, since)


def run_social_daily(
    spark: SparkSession, mentions_path: str, lexicon: DataFrame, out_path: str, since: str | None = None,
    by_day: bool = False,
) -> None:
    """Stored mentions to daily sentiment and counts."""
    parts = _parts(since, by_day)
    mentions = _since(read_table(spark, mentions_path, MENTION_SPEED), "created_ts", since)
    write_table(social_daily_from_mentions(mentions, lexicon), out_path, parts, since)


def run_joined_daily(
    spark: SparkSession, prices_path: str, social_path: str, out_path: str, since: str | None = None, by_day: bool = False
) -> None:
    """Both daily tables to the joined one."""
    parts = _parts(since, by_day)
    prices = _since(read_table(spark, prices_path, PRICE_DAILY), "day", since)
    social = _since(read_table(spark, social_path, SOCIAL_DAILY), "day", since)
    write_table(joined_daily(prices, social), out_path, parts, since)


def run_publish(spark: SparkSession, joined_path: str, url: str, target: str, properties: Mapping[str, str], **how) -> bool:
    """The joined table to the database; False when it has not been written yet."""
    joined = read_table_or_none(spark, joined_path, schema=JOINED_DAILY)
    if joined is None:
        return False
    publish_jdbc(joined, url, target, properties, **how)
    return True


def load_prices(target: DataFrame, prices: DataFrame) -> DataFrame:
    """The served price table with a batch of daily prices put in by (ticker, day)."""
    return upsert(target, prices.withColumnRenamed("symbol", "ticker"), ["ticker", "day"])


def load_mentions(target: DataFrame, social: DataFrame) -> DataFrame:
    """The served social table with a batch put in by (ticker, day); value columns it lacks default to zero."""
    return upsert(target, social, ["ticker", "day"], {"mentions": 0, "avg_sentiment": 0.0})


def build_joined(ticks: DataFrame, posts: DataFrame, lexicon: DataFrame, watchlist: Sequence[str]) -> DataFrame:
    """Ticks and posts to the joined daily table without writing the steps between."""
    return joined_daily(last_price_daily(ticks), social_daily(mark_tickers(posts, watchlist), lexicon))


def build_investment_signal(
    ticks: DataFrame, posts: DataFrame, lexicon: DataFrame, watchlist: Sequence[str], **steps: float
) -> DataFrame:
    return investment_signal(build_joined(ticks, posts, lexicon, watchlist), **steps)


def build_joined_daily_signal(
    ticks: DataFrame, posts: DataFrame, lexicon: DataFrame, watchlist: Sequence[str], **levels: float
) -> DataFrame:
    return joined_daily_signal(build_joined(ticks, posts, lexicon, watchlist), **levels)
