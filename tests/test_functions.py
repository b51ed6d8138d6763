"""Literal rows for the traps in text, time and number handling."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from marketpulse.functions.numbers import ACTIVITY_STEPS, DATASET_AGE_STEPS, UP_LABELS, band, first_price, last_close, mapped, quote_price
from marketpulse.functions.texts import extract_cashtags, extract_tickers, full_text, lexicon_term, tokens
from marketpulse.functions.times import epoch_to_ts, parse_ingest_ts
from marketpulse.schemas import DEFAULT_WATCHLIST, SHORT_WATCHLIST

UTC = dt.timezone.utc


def values(spark, rows, schema, *columns):
    return [tuple(row) for row in spark.createDataFrame(rows, schema).select(*columns).collect()]


def column(spark, items, kind, expr):
    return [row[0] for row in values(spark, [(item,) for item in items], f"x {kind}", expr.alias("y"))]


def test_timestamps(spark):
    now = F.lit("2030-01-01 00:00:00").cast("timestamp")
    texts = [
        "2024-01-01T00:00:07.179575+00:00", "2024-01-01T00:00:07+00:00", "2024-01-01T00:00:07Z",
        "2024-01-01T02:00:07+02", "2024-01-01 00:00:07", "junk", "", None,
    ]
    parsed = column(spark, texts, "string", F.date_format(parse_ingest_ts("x", now), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    at7 = "2024-01-01 00:00:07.000000"
    late = "2030-01-01 00:00:00.000000"
    assert parsed == ["2024-01-01 00:00:07.179575", at7, at7, at7, at7, late, late, late]


def test_missing_time_becomes_the_current_time(spark):
    before = dt.datetime.now(UTC).timestamp()
    got = column(spark, [None], "string", F.unix_micros(parse_ingest_ts("x")))[0] / 1e6
    assert before - 60 <= got <= dt.datetime.now(UTC).timestamp() + 60


def test_epoch_drops_the_fraction_and_survives_broken_values(spark):
    seconds = [1704067207.9, 0.0, -0.5, None, float("nan"), float("inf"), 1e300, 9.1e12]
    got = column(spark, seconds, "double", F.unix_micros(epoch_to_ts("x")))
    assert got == [1704067207000000, 0, 0, None, None, None, None, None]


def test_full_text_skips_nulls(spark):
    rows = [("a", "b"), (None, "b"), ("a", None), (None, None), ("", "")]
    got = values(spark, rows, "t string, x string", full_text("t", "x"))
    assert [row[0] for row in got] == ["a\nb", "b", "a", "", "\n"]


def test_tickers_any_case_whole_words(spark):
    texts = [
        "AAPL and aapl, cost of V. ma", "XAAPL _BA BA_ $GME #TSLA", "", None, "nothing here",
        "(V)", "BA-BA", "éBA BAé", "AAPL's MSFT’s", "tſla", "v2 V.2",
    ]
    got = column(spark, texts, "string", extract_tickers("x", DEFAULT_WATCHLIST))
    assert got == [
        ["AAPL", "COST", "MA", "V"], ["GME", "TSLA"], [], [], [],
        ["V"], ["BA"], [], ["AAPL", "MSFT"], ["TSLA"], ["V"],
    ]


def test_widening_capitals_are_no_match(spark):
    assert column(spark, ["maß", "MASS", "ﬁ", "fi"], "string", extract_tickers("x", ["MASS", "FI"])) == [
        [], ["MASS"], [], ["FI"]
    ]


def test_cashtags_are_strict_and_have_no_right_edge(spark):
    texts = ["$AAPL to $GOOGLE", "aapl $aapl AAPL", "AMZNX MSFT,", "", None, "$NVDA9 x$META"]
    got = column(spark, texts, "string", extract_cashtags("x", SHORT_WATCHLIST))
    assert got == [["AAPL", "GOOGL"], ["AAPL"], ["MSFT"], [], [], ["NVDA"]]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="AaPpLlVvé_ .,$\n1", max_size=30), min_size=20, max_size=40))
def test_tickers_equal_a_word_match_in_python(spark, texts):
    watchlist = ["AAPL", "V", "PL", "A"]
    pattern = re.compile(r"\b(" + "|".join(watchlist) + r")\b", re.IGNORECASE)
    expected = [sorted({hit.upper() for hit in pattern.findall(text)}) for text in texts]
    got = column(spark, texts, "string", extract_tickers("x", watchlist))
    assert got == expected
    assert all(tickers == sorted(set(tickers)) and set(tickers) <= set(watchlist) for tickers in got)


def test_tokens_and_terms(spark):
    got = column(spark, ["Good,  DAY!\n:-) (ok)  end. x"], "string", tokens("x"))[0]
    assert got == ["good,", "day!", ":-)", "(ok)", "end.", "x"]
    words = ["good,", "day!", ":-)", "(ok)", "'tis", "!!!", "", "don't", "plain"]
    assert column(spark, words, "string", lexicon_term("x")) == [
        "good", "day", ":-)", "(ok)", "tis", "!!!", "", "don't", "plain"
    ]


def test_price_fallback_skips_a_zero_only_in_first_fields(spark):
    rows = [
        (1.0, 2.0, 3.0, 4.0, 5.0), (0.0, 2.0, 3.0, 4.0, 5.0), (0.0, 0.0, 3.0, 4.0, 5.0), (0.0, None, 0.0, 4.0, 5.0),
        (None, None, None, 0.0, 5.0), (None, None, None, None, 5.0), (None, None, 0.0, None, None),
    ]
    got = values(
        spark, rows, "a double, b double, c double, d double, e double", first_price("a", "b", "c", "d", F.col("e"))
    )
    assert [row[0] for row in got] == [1.0, 2.0, 0.0, 4.0, 0.0, 5.0, None]


def test_last_close(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [([(t2, 2.0), (t1, 1.0)],), ([],), (None,)]
    got = values(spark, rows, "h array<struct<ts: timestamp, close: double>>", last_close("h"))
    assert [row[0] for row in got] == [2.0, None, None]


def test_quote_price(spark):
    bodies = [
        '{"Global Quote": {"05. price": "12.50"}}', '{"Global Quote": {"05. price": "n/a"}}', '{"Global Quote": {}}',
        '{"Note": "limit"}', "no json", None,
    ]
    assert column(spark, bodies, "string", quote_price("x")) == [12.5, None, None, None, None, None]


def test_bands_and_mappings(spark):
    ages = [0.0, 299.9, 300.0, 899.0, 900.0, float("inf")]
    assert column(spark, ages, "double", band("x", DATASET_AGE_STEPS)) == [
        "green", "green", "yellow", "yellow", "red", "red"
    ]
    assert column(spark, [0, 1, 7, None], "int", band("x", ACTIVITY_STEPS)) == ["red", "green", "green", "red"]
    assert column(spark, [0, 1, 2], "int", mapped("x", UP_LABELS)) == ["DOWN", "UP", None]
