"""Inputs that have to be refused or that once gave wrong results."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from marketpulse.functions.texts import WIDENING, extract_cashtags, extract_tickers
from marketpulse.operators import daily, decode, health, sentiment
from marketpulse.operators.upsert import upsert
from marketpulse.plans import health_report, views

TICKS = "symbol string, price double, ingest_ts timestamp, source string"


def bag(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_repeated_terms_are_refused(spark):
    posts = spark.createDataFrame([("a", "good day")], "id string, full_text string")
    lexicon = spark.createDataFrame([("good", 19), ("good", 19), ("day", 1)], "term string, val10 int")
    with pytest.raises(ValueError, match="good"):
        sentiment.score_posts(posts, ["id"], lexicon)
    assert sentiment.score_posts(posts, ["id"], lexicon.distinct()).first()["copies"] == 1


def test_upsert_with_null_keys_can_be_repeated(spark):
    social = spark.createDataFrame(
        [("A", dt.date(2024, 1, 1), 0.5, 3), ("A", None, 0.1, 1), (None, None, 0.2, 2)],
        "ticker string, day date, avg_sentiment double, mentions bigint",
    )
    keys = ["ticker", "day"]
    once = upsert(social, social, keys)
    assert bag(once) == bag(social) == bag(upsert(once, social, keys))
    counts = social.select("ticker", "day", (F.col("mentions") + 1).alias("mentions"))
    partial = upsert(upsert(social, counts, keys), counts, keys)
    assert bag(partial) == bag(social.withColumn("mentions", F.col("mentions") + 1))
    assert upsert(social.limit(0), counts, keys, {"avg_sentiment": 0.0}).count() == 3
    assert bag(upsert(social, social.limit(0), keys)) == bag(social)


def test_unknown_columns_are_refused(spark):
    target = spark.createDataFrame([("A", 1)], "k string, v int")
    with pytest.raises(ValueError, match="extra"):
        upsert(target, target.withColumn("extra", F.lit(1)), ["k"])


def test_symbols_that_no_strict_pattern_finds_are_refused():
    with pytest.raises(ValueError, match="BRK.B"):
        extract_cashtags("text", ["AAPL", "BRK.B"])


def test_nan_is_no_price(spark):
    at = dt.datetime(2024, 1, 1, 12)
    ticks = spark.createDataFrame([("A", float("nan"), at, "s"), ("A", 3.0, at, "s"), ("B", float("nan"), at, "s")], TICKS)
    assert bag(daily.last_price_daily(ticks)) == [("A", dt.date(2024, 1, 1), 3.0)]
    raw = spark.createDataFrame([(b'{"symbol":"A","price":NaN,"ingest_ts":null}',), (b'{"symbol":"A","price":2.5}',)], "value binary")
    assert [row["price"] for row in decode.decode_prices(raw, F.lit("2024-01-01").cast("timestamp")).collect()] == [2.5]


def test_last_value_keeps_null_labels(spark):
    at = [dt.datetime(2024, 1, 1, h) for h in (1, 2)]
    rows = [(None, at[0], 1.0), (None, at[1], 2.0), (None, at[1], 5.0), ("x", at[0], 7.0), ("x", at[1], None)]
    samples = spark.createDataFrame(rows, "label string, ts timestamp, value double")
    assert bag(health.last_not_null(samples, ["label"])) == sorted([(None, at[1], 5.0), ("x", at[0], 7.0)], key=repr)


def test_no_letter_turns_into_a_ticker(spark):
    """All letters whose capitals are several characters, next to the letters that would make them a symbol."""
    letters = [c for c in map(chr, range(0x80, 0x110000)) if len(c.upper()) > 1]
    assert all(re.fullmatch(WIDENING, c) for c in letters) and len(letters) > 90
    texts = [text for c in letters for text in (c, f"{c}ba", f"x {c}pm", f"ma{c}")]
    symbols = sorted({word for text in texts for word in re.findall(r"[A-Z]+", text.upper()) if word.isascii()} | {"BA", "PM", "MA", "V"})
    expected = [
        sorted({m.group().upper() for m in re.finditer(r"(?<!\w)(?:" + "|".join(symbols) + r")(?!\w)", text, re.IGNORECASE)})
        for text in texts
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = [row[1] for row in frame.select("i", extract_tickers("x", symbols)).orderBy("i").collect()]
    assert got == expected
    views.register_functions(spark, ["BA", "PM", "MA", "V"])
    frame.createOrReplaceTempView("odd_letters")
    assert spark.sql("SELECT count(*) FROM odd_letters WHERE size(extract_tickers(x)) > 0").first()[0] == sum(
        bool({"BA", "PM", "MA", "V"} & set(e)) for e in expected
    )


def test_dataset_health(spark, tmp_path):
    path = str(tmp_path / "some")
    spark.range(3).write.parquet(path)
    ages = spark.createDataFrame([("some", 400.0)], "dataset string, seconds_since_update double")
    datasets = {"some": path, "none": str(tmp_path / "none")}
    assert bag(health_report.dataset_health(spark, datasets, ages)) == [
        ("none", 0, False, "red", "DOWN", float("inf"), "red"), ("some", 3, True, "green", "UP", 400.0, "yellow")
    ]
    by_file = {row["dataset"]: row for row in health_report.dataset_health(spark, datasets).collect()}
    assert by_file["some"]["band"] == "green" and by_file["none"]["seconds_since_update"] == float("inf")
    for seconds, name in ((899.0, "green"), (900.0, "yellow"), (1800.0, "red")):
        row = health_report.overall_freshness(ages.withColumn("seconds_since_update", F.lit(seconds))).first()
        assert tuple(row) == (seconds, name)
