"""Structured Streaming jobs of the speed layer. The transforms are those of the batch path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from marketpulse.operators.decode import decode_prices, decode_social
from marketpulse.operators.mentions import POST_KEY, explode_mentions


def price_stream(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """Raw price messages to clean ticks."""
    return decode_prices(raw, now)


def drop_repeats(
    posts: DataFrame, keys: Sequence[str] = POST_KEY, delay: str = "7 days", event_time: str | None = None
) -> DataFrame:
    """Each post once. Its key is kept for `delay` after it was first seen, across restarts.

    Time is the time of arrival, so no post is dropped for being old: the first poll of a slow forum brings posts that
    are weeks old. With `event_time`, a timestamp column of the posts counts instead, and posts that are older than the
    newest one by more than `delay` are dropped as late. Posts without an id are dropped, as producers skip them.
    """
    ident = F.col(keys[-1])
    return (
        posts.where(ident.isNotNull() & (ident != ""))
        .withColumn("_seen_at", F.current_timestamp() if event_time is None else F.col(event_time))
        .withWatermark("_seen_at", delay)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop("_seen_at")
    )


def mention_stream(
    raw: DataFrame, watchlist: Sequence[str], now: Column | None = None, dedupe_delay: str | None = None
) -> DataFrame:
    """Raw post messages of all producers to ticker mentions; with `dedupe_delay`, repeated posts are dropped first."""
    posts = decode_social(raw)
    if dedupe_delay:
        posts = drop_repeats(posts, delay=dedupe_delay)
    return explode_mentions(posts, watchlist, now)


def start_append(
    df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, files_per_batch: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once across restarts from the same checkpoint.

    `trigger` takes writeStream.trigger arguments; a longer processingTime or `files_per_batch` keeps a slow feed from
    leaving thousands of tiny files.
    """
    if files_per_batch:
        df = df.coalesce(files_per_batch)
    writer = df.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def run_until_any_ends(spark: SparkSession) -> None:
    """Block until one of the running queries stops or fails."""
    spark.streams.awaitAnyTermination()
