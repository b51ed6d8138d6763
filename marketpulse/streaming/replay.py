"""Finite runs of streams: everything that is there is worked through, and the run ends with a report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from marketpulse.streaming.jobs import drop_repeats, price_stream, start_append

ALL_THERE_IS = {"availableNow": True}
MESSAGES = T.StructType([T.StructField("value", T.BinaryType())])


def message_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Messages that were stored as Parquet files with a column `value`, as a stream that sees files added later, too."""
    reader = spark.readStream.schema(MESSAGES)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def finish(query: StreamingQuery) -> list[Mapping[str, Any]]:
    """Wait for a finite run to end, raise if it failed, and give the progress report of each of its batches."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return list(query.recentProgress)


def store_prices(
    spark: SparkSession, messages: str, path: str, checkpoint: str, now: Column | None = None, files_per_batch: int | None = None
) -> list[Mapping[str, Any]]:
    """Clean ticks from all stored messages that no earlier run from this checkpoint has read, appended to `path`."""
    ticks = price_stream(message_stream(spark, messages, files_per_batch), now)
    return finish(start_append(ticks, path, checkpoint, ALL_THERE_IS))


def store_new_posts(
    posts: DataFrame, path: str, checkpoint: str, keys: Sequence[str], delay: str, event_time: str
) -> list[Mapping[str, Any]]:
    """Each post of a stream once, by event time: posts older than the newest by more than `delay` are dropped as late."""
    return finish(start_append(drop_repeats(posts, keys, delay, event_time), path, checkpoint, ALL_THERE_IS))


def late_rows(reports: Iterable[Mapping[str, Any]]) -> int:
    """Rows that keyed state refused because the watermark had passed them, over all batches of the reports."""
    return sum(int(state["numRowsDroppedByWatermark"]) for report in reports for state in report["stateOperators"])


def input_rows(reports: Iterable[Mapping[str, Any]]) -> int:
    return sum(int(report["numInputRows"]) for report in reports)


def merged_stream(feeds: Sequence[DataFrame], event_time: str, delays: Sequence[str], slowest_counts: bool = True) -> DataFrame:
    """Several producers as one stream, each with a watermark of its own; fields that one lacks are null there.

    The watermark of what is stateful behind it is the slowest feed's, so that no row of a late feed is dropped because
    another is ahead. With `slowest_counts=False` the fastest feed's counts: state is given up sooner, and what a slower feed
    brings behind it is dropped as late. The policy is a setting of the session and is fixed when a query first starts.
    """
    if len(feeds) != len(delays):
        raise ValueError("each feed needs its own delay")
    feeds[0].sparkSession.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min" if slowest_counts else "max")
    marked = [feed.withWatermark(event_time, delay) for feed, delay in zip(feeds, delays)]
    merged = marked[0]
    for feed in marked[1:]:
        merged = merged.unionByName(feed, allowMissingColumns=True)
    return merged
