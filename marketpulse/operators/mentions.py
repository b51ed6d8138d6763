"""Posts to ticker mentions, and de-duplication of posts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketpulse.functions.texts import extract_tickers, full_text
from marketpulse.functions.times import epoch_to_ts
from marketpulse.operators.once import compute_once

POST_KEY = ("subreddit", "id")


def mark_tickers(posts: DataFrame, watchlist: Sequence[str]) -> DataFrame:
    """Adds created_ts, full_text and the array of mentioned tickers; keeps only posts that mention one.

    A post that brings its own created_ts (see `normalize_posts`) keeps it where created_utc is missing.
    """
    created = epoch_to_ts("created_utc")
    if "created_ts" in posts.columns:
        created = F.coalesce(created, F.col("created_ts"))
    texts = posts.withColumn("created_ts", created).withColumn("full_text", full_text("title", "text"))
    return compute_once(texts, "tickers", extract_tickers("full_text", watchlist)).where(F.size("tickers") > 0)


def explode_mentions(posts: DataFrame, watchlist: Sequence[str], now: Column | None = None) -> DataFrame:
    """One row per (post, ticker), with ingest_ts and text_length: the layout of the mentions table."""
    marked = mark_tickers(posts.withColumn("ingest_ts", F.current_timestamp() if now is None else now), watchlist)
    return marked.withColumn("ticker", F.explode("tickers")).withColumn("text_length", F.length("full_text"))


def first_seen(posts: DataFrame, keys: Sequence[str] = POST_KEY, order: Sequence[str] = ("ingest_ts",)) -> DataFrame:
    """The earliest copy of each post; of several at one instant always the same one, by a hash of the whole row.

    Posts with an empty last key (no id) are dropped, as producers skip them. row_number() = 1 lets Spark prune inside
    each map task, so however often a post was copied, at most one copy per map task is shuffled.
    """
    ident = F.col(keys[-1])
    window = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*posts.columns))
    return (
        posts.where(ident.isNotNull() & (ident != ""))
        .withColumn("_nth", F.row_number().over(window))
        .where(F.col("_nth") == 1)
        .drop("_nth")
    )
