"""Declared schemas of the feeds and tables, and the tracked universe."""

from __future__ import annotations

from pyspark.sql import types as T

# The tracked symbols.
DEFAULT_WATCHLIST = [
    "AAPL", "MSFT", "NVDA", "GOOGL", "AMZN", "META", "TSLA", "JPM", "V", "MA", "BAC", "WMT", "COST", "NKE",
    "JNJ", "PFE", "XOM", "CVX", "BA", "GME",
]
# The shorter universe of the microblog and quote feeds.
SHORT_WATCHLIST = ["AAPL", "MSFT", "NVDA", "GOOGL", "AMZN"]


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_text, _real, _int, _long = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
_time, _date, _texts = T.TimestampType(), T.DateType(), T.ArrayType(T.StringType())

# The fields of the feeds' messages.
PRICE_EVENT = _struct(symbol=_text, price=_real, source=_text, ingest_ts=_text)

POST_EVENT = _struct(
    source=_text, subreddit=_text, id=_text, created_utc=_real, title=_text, text=_text,
    score=_int, num_comments=_int, permalink=_text,
)

# The fields that are read of a forum's listing pages.
LISTING = _struct(
    data=_struct(
        children=T.ArrayType(
            _struct(
                data=_struct(
                    id=_text, created_utc=_real, title=_text, selftext=_text, score=_int, num_comments=_int,
                    permalink=_text,
                )
            )
        )
    )
)

# The columns of the stored tables.
PRICE_SPEED = _struct(symbol=_text, price=_real, ingest_ts=_time, source=_text)

MENTION_SPEED = T.StructType(
    POST_EVENT.fields
    + _struct(
        ingest_ts=_time, created_ts=_time, full_text=_text, tickers=_texts, ticker=_text, text_length=_int
    ).fields
)

PRICE_DAILY = _struct(symbol=_text, day=_date, price_day_last=_real)
SOCIAL_DAILY = _struct(ticker=_text, day=_date, avg_sentiment=_real, mentions=_long)
JOINED_DAILY = _struct(ticker=_text, day=_date, price_day_last=_real, avg_sentiment=_real, mentions=_long)

# What increments keep for a key, which can be merged: the newest time with its price; a sum of scores and a count.
LAST_PRICES = _struct(symbol=_text, ingest_ts=_time, price=_real, day=_date)
MENTION_SUMS = _struct(ticker=_text, sum_e4=_long, mentions=_long, day=_date)
