"""From raw feed messages to typed rows. Works on batch and streaming inputs alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from marketpulse.functions.times import parse_ingest_ts
from marketpulse.operators.once import compute_once
from marketpulse.schemas import POST_EVENT, PRICE_EVENT


def decode_json(raw: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON bytes or text to the columns of `schema`. Text that is no JSON gives nulls, unknown fields are ignored."""
    event = F.from_json(F.col(value).cast("string"), schema)
    return compute_once(raw.select(value), "_event", event).select("_event.*")


def decode_prices(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """Price messages to (symbol, price, ingest_ts, source); events without a symbol or a price are dropped.

    JSON readers let NaN through, which is no price either.
    """
    events = decode_json(raw, PRICE_EVENT).where(
        F.col("symbol").isNotNull() & F.col("price").isNotNull() & ~F.isnan("price")
    )
    return events.select("symbol", "price", parse_ingest_ts("ingest_ts", now).alias("ingest_ts"), "source")


def decode_posts(raw: DataFrame) -> DataFrame:
    """Post messages to typed columns; nothing is dropped."""
    return decode_json(raw, POST_EVENT)


def decode_social(raw: DataFrame) -> DataFrame:
    """Messages of forum and microblog producers on one topic, in the layout of forum posts plus created_ts.

    A microblog post is identified by its uri, and created_ts is read from its created_at.
    """
    extra = T.StructType([T.StructField("uri", T.StringType()), T.StructField("created_at", T.StringType())])
    events = decode_json(raw, T.StructType(POST_EVENT.fields + extra.fields))
    posts = events.withColumn("id", F.coalesce("id", "uri"))
    return posts.select(*POST_EVENT.fieldNames(), F.try_to_timestamp("created_at").alias("created_ts"))


def valid_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks with a symbol, a price that is a number, and a time.

    The three plain null tests reach the Parquet scan, which dropna() would not. NaN would win over every real price.
    """
    present = F.col("symbol").isNotNull() & F.col("price").isNotNull() & F.col("ingest_ts").isNotNull()
    return ticks.where(present & ~F.isnan("price"))
