"""The same results for people who write SQL: views over the joined table, and text functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from marketpulse.functions.texts import CASHTAG, OWN_CAPITALS, WIDE_LETTERS, WORD, plain_symbols, word_symbols
from marketpulse.operators.serving import DEFAULT_DAYS, MAX_DAYS, MIN_DAYS
from marketpulse.operators.signals import investment_signal, joined_daily_signal


def register_views(joined: DataFrame, **steps: float) -> None:
    """joined_daily, investment_signal_daily and joined_daily_signal as temporary views of the session.

    A filter on the ticker goes through the views' windows down to the scan.
    """
    joined.createOrReplaceTempView("joined_daily")
    investment_signal(joined, **steps).createOrReplaceTempView("investment_signal_daily")
    joined_daily_signal(joined).createOrReplaceTempView("joined_daily_signal")


def _sql_list(values: Sequence[str]) -> str:
    return "CAST(array(" + ", ".join(f"'{value}'" for value in values) + ") AS ARRAY<STRING>)"


def register_functions(spark: SparkSession, watchlist: Sequence[str]) -> None:
    """extract_tickers(text) and extract_cashtags(text) for SQL. They are expanded into the query, with no Python."""
    plain = f"if(octet_length(body) = length(body), body, translate(body, '{WIDE_LETTERS}', '{OWN_CAPITALS}'))"
    words = f"regexp_extract_all(upper({plain}), r'{WORD}', 0)"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION extract_tickers(body STRING) RETURNS ARRAY<STRING> RETURN "
        f"coalesce(sort_array(array_intersect({words}, {_sql_list(word_symbols(watchlist))})), {_sql_list([])})"
    )
    found = f"concat(regexp_extract_all(body, r'{CASHTAG}', 1), regexp_extract_all(body, r'{WORD}', 0))"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION extract_cashtags(body STRING) RETURNS ARRAY<STRING> RETURN "
        f"coalesce(sort_array(array_intersect({found}, {_sql_list(plain_symbols(watchlist))})), {_sql_list([])})"
    )


# Lookups for SQL: name -> (view, columns and types). Each takes a ticker and a number of days.
_LOOKUPS = {
    "signal_last_days": (
        "investment_signal_daily",
        "day DATE, signal STRING, mentions BIGINT, avg_sentiment DOUBLE, price_day_last DOUBLE, mentions_delta DOUBLE, "
        "sentiment_delta DOUBLE, price_delta DOUBLE",
    ),
    "prices_last_days": ("joined_daily", "day DATE, price_day_last DOUBLE"),
    "mentions_last_days": ("joined_daily", "day DATE, mentions BIGINT"),
}


def register_lookups(spark: SparkSession) -> None:
    """signal_last_days(symbol, n), prices_last_days(symbol, n) and mentions_last_days(symbol, n) as table functions.

    They read the views of `register_views` and give the newest n days of one ticker, n between 1 and 365, 30 unless
    given. The ticker reaches the scan like a filter on the view.
    """
    for name, (view, columns) in _LOOKUPS.items():
        names = ", ".join(column.split()[0] for column in columns.split(", "))
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(symbol STRING, n INT DEFAULT {DEFAULT_DAYS}) RETURNS TABLE ({columns}) RETURN "
            f"SELECT {names} FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY day DESC) AS nth FROM {view}) "
            f"WHERE ticker = {name}.symbol AND nth <= greatest({MIN_DAYS}, least({name}.n, {MAX_DAYS}))"
        )
