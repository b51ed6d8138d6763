"""What the plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from marketpulse.catalog import QUERIES
from marketpulse import fixtures as fx
from marketpulse.operators import daily, decode, health, mentions, sentiment, signals
from marketpulse.plans import views
from marketpulse.schemas import DEFAULT_WATCHLIST, PRICE_SPEED, SHORT_WATCHLIST
from marketpulse.functions.texts import extract_cashtags, extract_tickers

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not [word for word in FORBIDDEN if word in text]


@pytest.fixture(scope="module")
def stored_ticks(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "ticks")
    decode.valid_ticks(fx.price_ticks(spark, SF_DIR)).select(PRICE_SPEED.fieldNames()).write.parquet(path)
    return path


def test_last_price_sorts_nothing_and_pushes_filters(spark, stored_ticks):
    text = plan(daily.last_price_daily(spark.read.schema(PRICE_SPEED).parquet(stored_ticks)))
    assert "SortAggregate" not in text and "Sort [" not in text and "SortMergeJoin" not in text
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
    for column in ("symbol", "price", "ingest_ts"):
        assert f"IsNotNull({column})" in text
    assert "ReadSchema: struct<symbol:string,price:double,ingest_ts:timestamp>" in text
    assert text.index("partial_max") > text.index("Exchange"), "the partial aggregate runs before the shuffle"


def test_last_value_sorts_nothing(spark, stored_ticks):
    ticks = spark.read.schema(PRICE_SPEED).parquet(stored_ticks)
    text = plan(health.last_not_null(ticks, ["symbol"], "price", "ingest_ts"))
    assert "SortAggregate" not in text and "Sort [" not in text and text.count("FileScan") == 1


def test_since_reaches_the_scan(spark, stored_ticks):
    table = spark.read.schema(PRICE_SPEED).parquet(stored_ticks)
    text = plan(daily.last_price_daily(table.where(F.col("ingest_ts") >= F.lit("2024-01-20").cast("timestamp"))))
    assert "GreaterThanOrEqual(ingest_ts" in text


def test_ties_do_not_shuffle_the_ticks(spark, stored_ticks):
    text = plan(daily.last_price_ties(spark.read.schema(PRICE_SPEED).parquet(stored_ticks)))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_sentiment_shuffles_scores_and_not_texts(spark):
    posts = fx.table(spark, SF_DIR, "documents").select("doc_id", F.col("text").alias("full_text"))
    text = plan(sentiment.post_sentiment(posts, ["doc_id"], fx.lexicon(spark)))
    assert text.count("Exchange hashpartitioning") == 1
    exchange = text.index("Exchange hashpartitioning")
    assert "partial_sum" in text[exchange:] and "BroadcastHashJoin" in text[exchange:]
    assert text.count("sha2(") == 1
    assert text.index("sha2(") > text.index("Generate"), "the hash is taken below the explode"


def test_mentions_are_scored_once_per_text(spark):
    stored = mentions.explode_mentions(fx.social_posts(spark, SF_DIR), fx.WATCHLIST, fx.now())
    text = plan(daily.social_daily_from_mentions(stored.select("ticker", "created_ts", "full_text"), fx.lexicon(spark)))
    cut = text.index("posexplode")
    assert re.search(r"HashAggregate\(keys=\[full_text#\d+\]", text[cut:]), "texts are cut before their copies collapse"


def test_texts_and_json_are_read_once_per_row(spark):
    posts = fx.table(spark, SF_DIR, "documents").select(
        F.col("text"), F.lit(None).cast("string").alias("title"), F.lit(0.0).alias("created_utc")
    )
    assert plan(mentions.mark_tickers(posts, fx.WATCHLIST).select("tickers")).count("regexp_extract_all") == 1
    assert plan(mentions.explode_mentions(posts, fx.WATCHLIST)).count("regexp_extract_all") == 1
    raw = fx.table(spark, SF_DIR, "events").select(F.col("props").alias("value"))
    assert plan(decode.decode_prices(raw)).count("from_json") == 1


def test_repeated_posts_are_pruned_before_the_shuffle(spark):
    text = plan(mentions.first_seen(fx.reposted(spark, SF_DIR)))
    assert len(re.findall(r"WindowGroupLimit .*Partial", text)) == 1
    assert text.index("Partial") > text.index("Exchange hashpartitioning")


def test_deltas_share_one_window(spark):
    joined = spark.createDataFrame([], "ticker string, day date, price_day_last double, avg_sentiment double, mentions bigint")
    text = plan(signals.daily_deltas(joined))
    assert len(re.findall(r"Window \[", text)) == 1 and text.count("Exchange hashpartitioning") == 1


def test_views_and_functions_for_sql(spark, tmp_path):
    path = str(tmp_path / "joined")
    QUERIES["joined_daily"](spark, SF_DIR).write.parquet(path)
    views.register_views(spark.read.parquet(path), mentions_step=5)
    panel = spark.sql(
        "SELECT day, signal, mentions, avg_sentiment, price_day_last, mentions_delta, sentiment_delta, price_delta "
        "FROM investment_signal_daily WHERE ticker = 'THE' ORDER BY day DESC LIMIT 30"
    )
    assert sorted(panel.collect(), key=str) == sorted(QUERIES["signal_last_30"](spark, SF_DIR).collect(), key=str)
    assert "EqualTo(ticker,THE)" in plan(panel)
    assert spark.sql("SELECT count(*) FROM joined_daily_signal WHERE invest_signal IN (-1, 0, 1)").first()[0] == 366

    views.register_functions(spark, DEFAULT_WATCHLIST + SHORT_WATCHLIST)
    texts = spark.createDataFrame([("aapl $V BA",), ("$GOOGLE maß",), ("",), (None,)], "x string")
    texts.createOrReplaceTempView("texts")
    got = spark.sql("SELECT extract_tickers(x), extract_cashtags(x) FROM texts").collect()
    expected = texts.select(extract_tickers("x", DEFAULT_WATCHLIST), extract_cashtags("x", DEFAULT_WATCHLIST)).collect()
    assert [tuple(row) for row in got] == [tuple(row) for row in expected]
    assert expected[0][0] == ["AAPL", "BA", "V"] and expected[1] == ([], ["GOOGL"])
