"""Shaping of what the outside services return into feed events."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from marketpulse.functions.texts import extract_cashtags
from marketpulse.operators.once import compute_once
from marketpulse.schemas import LISTING


def flatten_listing(
    listings: DataFrame, body: str = "value", forum: str = "subreddit", schema: T.StructType = LISTING
) -> DataFrame:
    """Forum listings (one JSON page per row) to post events. Children without an id are skipped, absent texts empty."""
    pages = compute_once(listings.select(F.col(forum).alias("subreddit"), F.col(body).cast("string").alias("_body")),
                         "_page", F.from_json("_body", schema))
    post = F.col("child.data")
    return (
        pages.select("subreddit", F.explode("_page.data.children").alias("child"))
        .where(post["id"].isNotNull() & (post["id"] != ""))
        .select(
            F.lit("reddit").alias("source"),
            "subreddit",
            post["id"].alias("id"),
            post["created_utc"].alias("created_utc"),
            F.coalesce(post["title"], F.lit("")).alias("title"),
            F.coalesce(post["selftext"], F.lit("")).alias("text"),
            post["score"].alias("score"),
            post["num_comments"].alias("num_comments"),
            post["permalink"].alias("permalink"),
        )
    )


# Counter names as the service spells them, and as the feed does.
_COUNTERS = {"likeCount": "like_count", "repostCount": "repost_count", "replyCount": "reply_count"}


def normalize_posts(posts: DataFrame, watchlist: Sequence[str]) -> DataFrame:
    """Microblog posts to feed events: text defaulted, tickers by the strict rule, posts without a ticker dropped.

    Counters may come under the service's own names. `id` and `created_ts` are added so that the event fits in with
    forum posts: the uri identifies a post, and its creation time is read from created_at.
    """
    posts = posts.withColumnsRenamed(_COUNTERS)
    for name in _COUNTERS.values():
        if name not in posts.columns:
            posts = posts.withColumn(name, F.lit(None).cast("bigint"))
    events = posts.withColumn("text", F.coalesce("text", F.lit("")))
    events = compute_once(events.drop("tickers"), "tickers", extract_cashtags("text", watchlist))
    events = events.where(F.size("tickers") > 0)
    return events.select(
        F.lit("bluesky").alias("source"), "uri", "cid", "author_did", "author_handle", "text", "created_at", "tickers",
        "like_count", "repost_count", "reply_count",
        F.col("uri").alias("id"), F.try_to_timestamp("created_at").alias("created_ts"),
    )


def merge_feeds(*feeds: DataFrame) -> DataFrame:
    """Several producers as one feed; fields that one of them lacks are null there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), feeds)
