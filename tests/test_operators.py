"""Literal rows for decoding, de-duplication, daily reductions, signals, upsert and health."""

import datetime as dt
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from marketpulse.operators import daily, decode, health, mentions, sentiment, serving, signals, sizing, upsert
from marketpulse.plans import jobs
from marketpulse.schemas import JOINED_DAILY, POST_EVENT, PRICE_EVENT, PRICE_SPEED
from marketpulse.sources import feeds, topics

D = dt.date
POST = "source string, subreddit string, id string, created_utc double, title string, text string, score int, " \
       "num_comments int, permalink string"
relaxed = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def now():
    return F.lit("2030-01-01 00:00:00").cast("timestamp")


def ts(day, hour=0, minute=0, second=0, micro=0):
    return dt.datetime(2024, 1, day, hour, minute, second, micro)


def rows(df):
    return [tuple(row) for row in df.collect()]


def bag(df):
    return sorted(rows(df), key=repr)


def lexicon(spark, *terms):
    return spark.createDataFrame(terms or [("good", 19), ("bad", -25)], "term string, val10 int")


def post(ident, text, created=1704067200.0, sub="s", title=None):
    return ("reddit", sub, ident, created, title, text, 1, 0, None)


# --- decoding


def test_price_messages(spark):
    bodies = [
        '{"symbol":"A","price":1.5,"source":"y","ingest_ts":"2024-01-01T00:00:07.5+00:00"}',
        '{"symbol":"B","price":2,"extra":1}',
        '{"symbol":"C","price":"1.5"}', '{"symbol":"D","price":null}', '{"price":1.0}', "not json", None,
    ]
    raw = spark.createDataFrame([(body.encode() if body else None,) for body in bodies], "value binary")
    got = decode.decode_prices(raw, now()).select("symbol", "price", F.col("ingest_ts").cast("string"), "source")
    assert bag(got) == [("A", 1.5, "2024-01-01 00:00:07.5", "y"), ("B", 2.0, "2030-01-01 00:00:00", None)]


def test_post_messages_with_a_fraction_in_a_count(spark):
    raw = spark.createDataFrame([('{"id":"a","score":12.0,"num_comments":3}',), ("junk",)], "value string")
    got = rows(decode.decode_posts(raw).select("id", "score", "num_comments"))
    assert got == [("a", None, 3), (None, None, None)]


def test_encode_keeps_nulls_and_round_trips(spark):
    events = spark.createDataFrame([("A", None, "y", None)], PRICE_EVENT)
    encoded = topics.encode_json(events)
    assert encoded.schema["value"].dataType.simpleString() == "binary"
    assert bytes(encoded.first()[0]).decode() == '{"symbol":"A","price":null,"source":"y","ingest_ts":null}'
    assert rows(decode.decode_json(encoded, PRICE_EVENT)) == [("A", None, "y", None)]


def test_flatten_listing(spark):
    page = (
        '{"data":{"children":[{"data":{"id":"a","selftext":"x","score":3,"created_utc":1.0}},'
        '{"data":{"id":null}},{"data":{"id":""}},{"data":{"title":"no id"}},{"data":{"id":"b","title":"t"}},{}]}}'
    )
    listings = spark.createDataFrame([("s", page), ("s2", "junk"), ("s3", '{"data":{}}')], "subreddit string, value string")
    got = bag(feeds.flatten_listing(listings).select("source", "subreddit", "id", "title", "text", "score"))
    assert got == [("reddit", "s", "a", "", "x", 3), ("reddit", "s", "b", "t", "", None)]


def test_normalized_posts_join_the_forum_feed(spark):
    blog = spark.createDataFrame(
        [("u1", "$AAPL up", "2024-01-02T03:04:05.6Z", 7), ("u2", "nothing", None, 1), ("u3", None, None, 1),
         ("u4", "MSFT", "junk", None)],
        "uri string, text string, created_at string, likeCount bigint",
    )
    for name in ("cid", "author_did", "author_handle"):
        blog = blog.withColumn(name, F.lit(name))
    events = feeds.normalize_posts(blog, ["AAPL", "MSFT"])
    assert bag(events.select("uri", "id", "tickers", "like_count", "reply_count")) == [
        ("u1", "u1", ["AAPL"], 7, None), ("u4", "u4", ["MSFT"], None, None)
    ]
    forum = spark.createDataFrame([post("p", "aapl")], POST_EVENT)
    both = feeds.merge_feeds(forum, events.drop("tickers"))
    marked = mentions.mark_tickers(both, ["AAPL", "MSFT"])
    got = bag(marked.select("id", "tickers", F.col("created_ts").cast("string")))
    assert got == [
        ("p", ["AAPL"], "2024-01-01 00:00:00"), ("u1", ["AAPL"], "2024-01-02 03:04:05.6"), ("u4", ["MSFT"], None)
    ]


def test_mentions_layout(spark):
    posts = spark.createDataFrame([post("a", "V and ba"), post("b", "none"), post("c", None, title="GME")], POST)
    got = mentions.explode_mentions(posts, ["V", "BA", "GME"], now())
    assert set(got.columns) == {
        *POST_EVENT.fieldNames(), "ingest_ts", "created_ts", "full_text", "tickers", "ticker", "text_length"
    }
    assert bag(got.select("id", "ticker", "tickers", "full_text", "text_length")) == [
        ("a", "BA", ["BA", "V"], "V and ba", 8), ("a", "V", ["BA", "V"], "V and ba", 8), ("c", "GME", ["GME"], "GME", 3)
    ]


def test_first_seen(spark):
    posts = spark.createDataFrame(
        [("s", "a", ts(2), "late"), ("s", "a", ts(1), "early"), ("t", "a", ts(3), "other forum"), ("s", None, ts(1), "x"),
         ("s", "", ts(1), "y"), (None, "u", ts(2), "blog"), (None, "u", ts(4), "blog again")],
        "subreddit string, id string, ingest_ts timestamp, text string",
    )
    assert bag(mentions.first_seen(posts).select("text")) == [("blog",), ("early",), ("other forum",)]


# --- sentiment


def compound(total):
    return round(total / math.sqrt(total * total + 15), 4)


def test_sentiment_values(spark):
    posts = spark.createDataFrame(
        [("a", "Good, good day"), ("b", "BAD!"), ("c", "nothing"), ("d", ""), ("e", None), ("f", "good bad")],
        "id string, full_text string",
    )
    got = {row["id"]: row["sentiment"] for row in sentiment.post_sentiment(posts, ["id"], lexicon(spark)).collect()}
    assert got == {"a": compound(3.8), "b": compound(-2.5), "c": 0.0, "d": 0.0, "e": 0.0, "f": compound(-0.6)}


def test_sentiment_counts_equal_posts(spark):
    posts = spark.createDataFrame([("a", "good")] * 3 + [("a", "bad")], "id string, full_text string")
    assert bag(sentiment.score_posts(posts, ["id"], lexicon(spark))) == [
        ("a", 1, round(compound(-2.5) * 10000)), ("a", 3, round(compound(1.9) * 10000))
    ]


def test_a_large_lexicon_is_joined_without_broadcast(spark, monkeypatch):
    from marketpulse.operators import sizing

    posts = spark.createDataFrame([(str(i), "good bad day") for i in range(50)], "id string, full_text string")
    small = bag(sentiment.post_sentiment(posts, ["id"], lexicon(spark)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr(
            sentiment, "broadcast_when_small", lambda df: sizing.broadcast_when_small(df, max_rows=1)
        )
        large = sentiment.post_sentiment(posts, ["id"], lexicon(spark))
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert bag(large) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_social_daily_counts_posts_per_ticker_and_keeps_the_null_day(spark):
    posts = spark.createDataFrame(
        [post("a", "V good"), post("a", "V good"), post("b", "V BA bad"), post("c", "BA", created=None)], POST
    )
    marked = mentions.mark_tickers(posts, ["V", "BA"])
    day = D(2024, 1, 1)
    expected = [
        ("BA", day, compound(-2.5), 1), ("BA", None, 0.0, 1),
        ("V", day, pytest.approx((2 * compound(1.9) + compound(-2.5)) / 3, abs=1e-12), 3),
    ]
    by_key = lambda row: (row[0], str(row[1]))
    got = sorted(rows(daily.social_daily(marked, lexicon(spark))), key=by_key)
    assert got == sorted(expected, key=by_key)
    exploded = mentions.explode_mentions(posts, ["V", "BA"], now())
    again = sorted(rows(daily.social_daily_from_mentions(exploded, lexicon(spark))), key=by_key)
    assert again == got
    scored = exploded.join(
        sentiment.post_sentiment(exploded.select("id", "full_text").distinct(), ["id"], lexicon(spark)), "id"
    ).withColumn("day", F.to_date("created_ts"))
    plain = sorted(rows(daily.daily_mean(scored)), key=by_key)
    assert [(t, d, pytest.approx(a), n) for t, d, a, n in got] == plain


def test_scores_of_mentions_are_those_of_their_posts(spark):
    texts = [("V", "V good"), ("V", "V good"), ("BA", "V good"), ("BA", "bad"), ("V", None), ("V", ""), (None, "bad")]
    found = spark.createDataFrame(texts, "ticker string, full_text string")
    apart = bag(sentiment.score_posts(found, ["ticker"], lexicon(spark)))
    assert bag(sentiment.score_mentions(found, ["ticker"], lexicon(spark))) == apart


# --- daily prices


def ticks(spark, *items):
    return spark.createDataFrame([(s, p, t, "x") for s, p, t in items], PRICE_SPEED)


def test_last_price_ties_and_invalid_ticks(spark):
    table = ticks(
        spark, ("A", 1.0, ts(1, 9)), ("A", 3.0, ts(1, 10)), ("A", 2.0, ts(1, 10)), ("A", None, ts(1, 11)),
        (None, 1.0, ts(1)), ("A", 9.0, None), ("A", 5.0, ts(2)), ("B", 7.0, ts(1)), ("B", 7.0, ts(1)),
    )
    d1, d2 = D(2024, 1, 1), D(2024, 1, 2)
    assert bag(daily.last_price_daily(table)) == [("A", d1, 3.0), ("A", d2, 5.0), ("B", d1, 7.0)]
    assert bag(daily.last_price_ties(table)) == [
        ("A", d1, 2.0), ("A", d1, 3.0), ("A", d2, 5.0), ("B", d1, 7.0), ("B", d1, 7.0)
    ]
    assert bag(daily.max_ts_daily(table).select("symbol", "day")) == [("A", d1), ("A", d2), ("B", d1)]


def test_times_stored_as_text(spark):
    table = spark.createDataFrame(
        [("A", 1.0, "2024-01-01T10:00:00Z"), ("A", 2.0, "2024-01-01 09:00:00"), ("A", 3.0, "junk")],
        "symbol string, price double, ingest_ts string",
    )
    assert rows(daily.last_price_daily(table)) == [("A", D(2024, 1, 1), 1.0)]


def test_ties_beyond_the_broadcast_bound(spark, monkeypatch):
    from marketpulse.operators import sizing

    table = ticks(spark, *[(s, float(i), ts(1 + i % 3, i % 2)) for s in "ABC" for i in range(30)])
    expected = bag(daily.last_price_ties(table))
    bounded = sizing.broadcast_when_small
    monkeypatch.setattr(sizing, "broadcast_when_small", lambda df: bounded(df, max_rows=2))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = daily.last_price_ties(table)
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert bag(large) == expected and len(expected) == 45
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@relaxed
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(1, 5), st.integers(1, 3), st.integers(0, 2)), min_size=1, max_size=40))
def test_one_row_per_key_and_contained_in_ties(spark, items):
    table = ticks(spark, *[(s, float(p), ts(d, h)) for s, p, d, h in items])
    one, ties = rows(daily.last_price_daily(table)), rows(daily.last_price_ties(table))
    assert len({row[:2] for row in one}) == len(one) == len({(s, d) for s, _, d, _ in items})
    assert set(one) <= set(ties)
    last = {}
    for s, _, d, h in items:
        last[s, d] = max(last.get((s, d), -1), h)
    assert sorted(ties) == sorted(
        (s, D(2024, 1, d), float(p)) for s, p, d, h in items if h == last[s, d]
    )


def test_joined_keeps_price_days_and_drops_post_days(spark):
    prices = spark.createDataFrame([("A", D(2024, 1, 1), 1.0), ("A", D(2024, 1, 2), None)], "symbol string, day date, price_day_last double")
    social = spark.createDataFrame([("A", D(2024, 1, 1), 0.5, 3), ("A", D(2024, 1, 9), 0.1, 1)], "ticker string, day date, avg_sentiment double, mentions bigint")
    joined = daily.joined_daily(prices, social)
    assert [(f.name, f.dataType) for f in joined.schema] == [(f.name, f.dataType) for f in JOINED_DAILY]
    assert bag(joined) == [("A", D(2024, 1, 1), 1.0, 0.5, 3), ("A", D(2024, 1, 2), None, 0.0, 0)]


# --- signals


def joined(spark, *items):
    return spark.createDataFrame([("A", D(2024, 1, d), p, s, m) for d, p, s, m in items], JOINED_DAILY)


def test_text_signals(spark):
    table = joined(
        spark, (1, 10.0, 0.0, 0), (2, 10.0, 0.5, 60), (3, 9.0, 0.1, 120), (5, 9.0, -0.3, 180), (6, 10.0, 0.3, 300),
        (7, 9.0, 0.9, 350), (8, 8.0, 0.6, 351),
    )
    got = {row["day"].day: row["signal"] for row in signals.investment_signal(table).collect()}
    # 5: the price did not fall, so no SELL; the previous row is day 3. 7: a rise of exactly 50 is no jump.
    assert got == {1: "HOLD", 2: "BUY", 3: "SELL", 5: "HOLD", 6: "HOLD", 7: "HOLD", 8: "HOLD"}
    deltas = {row["day"].day: (row["mentions_delta"], row["price_delta"]) for row in signals.daily_deltas(table).collect()}
    assert deltas[1] == (None, None) and deltas[5] == (60.0, 0.0)


def test_numeric_signals_and_return(spark):
    table = joined(
        spark, (1, 10.0, 0.9, 99), (2, 11.0, 0.20, 10), (3, 11.0, -0.2, 10), (4, 0.0, -0.5, 9), (5, 3.0, 0.5, 20),
        (6, None, 0.5, 20), (7, 3.0, 0.5, 20),
    )
    got = {row["day"].day: (row["daily_return"], row["invest_signal"]) for row in signals.joined_daily_signal(table).collect()}
    assert got == {
        1: (None, 0), 2: (pytest.approx(0.1), 1), 3: (0.0, -1), 4: (-1.0, 0), 5: (None, 0), 6: (None, 0), 7: (None, 0)
    }


def test_codes_drivers_and_lookups(spark):
    table = signals.investment_signal(joined(spark, (1, 10.0, 0.0, 0), (2, 9.0, 0.5, 60), (3, 8.0, 0.0, 160)))
    assert [row["value"] for row in signals.signal_code(table).orderBy("day").collect()] == [0.0, 1.0, -1.0]
    assert rows(serving.signal_latest(table).select("ticker", "value")) == [("A", -1.0)]
    assert rows(serving.signal_last_days(table, "A", 2).select("day", "signal")) == [(D(2024, 1, 3), "SELL"), (D(2024, 1, 2), "BUY")]
    drivers = signals.signal_drivers(table)
    assert drivers.columns == ["ticker", "time", "metric", "value"] and drivers.count() == 9
    assert {row["metric"] for row in drivers.collect()} == {"mentions_delta", "sentiment_delta", "price_delta"}


def test_latest_days_clamps_its_limit(spark):
    table = spark.range(400).select(F.lit("A").alias("ticker"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"), F.col("id").alias("v"))
    assert serving.latest_days(table, "A", ["v"], 1000).count() == 365
    assert rows(serving.latest_days(table, "A", ["v"], -3).select("v")) == [(399,)]
    assert serving.latest_days(table, "A", ["v"]).count() == 30
    assert serving.latest_days(table, "B", ["v"]).count() == 0
    plan = serving.latest_days(table, "A", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_labels_match_as_a_whole(spark):
    table = spark.createDataFrame([("ab",), ("abc",), ("b",)], "topic string")
    assert bag(serving.filter_label(table, "topic", matches="ab|b")) == [("ab",), ("b",)]
    assert bag(serving.filter_label(table, "topic", among=["b", "abc"])) == [("abc",), ("b",)]
    assert bag(serving.filter_label(table, "topic", equals="b")) == [("b",)]


# --- upsert


KEYED = "ticker string, day date, avg_sentiment double, mentions bigint"


def test_upsert_replaces_keeps_and_adds(spark):
    target = spark.createDataFrame([("A", D(2024, 1, 1), 0.1, 1), ("A", D(2024, 1, 2), 0.2, 2)], KEYED)
    delta = spark.createDataFrame([("A", D(2024, 1, 2), None, 5), ("B", D(2024, 1, 1), 0.3, 3)], KEYED)
    got = upsert.upsert(target, delta, ["ticker", "day"])
    assert bag(got) == [("A", D(2024, 1, 1), 0.1, 1), ("A", D(2024, 1, 2), None, 5), ("B", D(2024, 1, 1), 0.3, 3)]
    assert bag(upsert.upsert(got, delta, ["ticker", "day"])) == bag(got)
    counts = delta.select("ticker", "day", "mentions")
    assert bag(jobs.load_mentions(target, counts)) == [
        ("A", D(2024, 1, 1), 0.1, 1), ("A", D(2024, 1, 2), 0.2, 5), ("B", D(2024, 1, 1), 0.0, 3)
    ]


@relaxed
@given(
    st.dictionaries(st.tuples(st.sampled_from("AB"), st.integers(1, 4)), st.integers(0, 9), max_size=8),
    st.dictionaries(st.tuples(st.sampled_from("AB"), st.integers(1, 4)), st.integers(0, 9), max_size=8),
)
def test_upsert_is_a_dictionary_update(spark, old, new):
    table = lambda items: spark.createDataFrame([(t, D(2024, 1, d), 0.5, v) for (t, d), v in items.items()], KEYED)
    expected = sorted((t, D(2024, 1, d), v) for (t, d), v in {**old, **new}.items())
    once = upsert.upsert(table(old), table(new), ["ticker", "day"])
    assert sorted(rows(once.select("ticker", "day", "mentions"))) == expected
    partial = upsert.upsert(table(old), table(new).drop("avg_sentiment"), ["ticker", "day"], {"avg_sentiment": 0.5})
    assert bag(partial) == bag(once)
    assert not sizing.repeated_keys(once, ["ticker", "day"]).count()


@relaxed
@given(st.lists(st.tuples(
    st.one_of(st.none(), st.floats(0, 100)), st.floats(-1, 1), st.integers(0, 300)
), min_size=1, max_size=12))
def test_every_day_gets_one_signal(spark, days):
    table = joined(spark, *[(i + 1, *values) for i, values in enumerate(days)])
    got = signals.investment_signal(table).collect()
    assert len(got) == len(days) and {row["signal"] for row in got} <= {"BUY", "SELL", "HOLD"}
    coded = signals.joined_daily_signal(table).collect()
    assert len(coded) == len(days) and {row["invest_signal"] for row in coded} <= {-1, 0, 1}


def test_upsert_refuses_a_repeated_key(spark):
    target = spark.createDataFrame([], KEYED)
    delta = spark.createDataFrame([("A", D(2024, 1, 1), 0.1, 1)] * 2, KEYED)
    with pytest.raises(ValueError, match="more than once"):
        upsert.upsert(target, delta, ["ticker", "day"])


# --- health


def brute_rate(samples, window):
    out = []
    for i, (t, v) in enumerate(samples):
        inside = [j for j in range(i + 1) if samples[j][0] >= t - window]
        grown = sum(
            samples[b][1] if samples[b][1] < samples[a][1] else samples[b][1] - samples[a][1]
            for a, b in zip(inside, inside[1:])
        )
        took = t - samples[inside[0]][0]
        out.append(None if took == 0 else grown / took)
    return out


@pytest.mark.parametrize("per_chunk", [1, 2, 8])
def test_rate_equals_brute_force(spark, per_chunk):
    rnd = random.Random(per_chunk)
    samples, expected = [], []
    for series in "ab":
        t, v, line = 1_700_000_000, 0.0, []
        for _ in range(150):
            t += rnd.choice([1, 5, 10, 60, 120, 121, 700])
            v = 0.0 if rnd.random() < 0.1 else v + rnd.randint(0, 9)
            line.append((t, v))
        samples += [(series, dt.datetime.fromtimestamp(t, dt.timezone.utc), v) for t, v in line]
        expected += [(series, t, rate) for (t, _), rate in zip(line, brute_rate(line, 120))]
    table = spark.createDataFrame(samples, "topic string, ts timestamp, value double")
    rates = health.counter_rate(table, ["topic"], 120, windows_per_chunk=per_chunk)
    got = sorted((row[0], row[1], row[2]) for row in rates.select("topic", F.unix_seconds("ts"), "rate").collect())
    assert [row[:2] for row in got] == [row[:2] for row in expected]
    assert [row[2] for row in got] == [None if row[2] is None else pytest.approx(row[2]) for row in expected]
    assert any(row[2] is None for row in got) and any(row[2] for row in got)


def test_single_sample_and_reset(spark):
    table = spark.createDataFrame([("a", ts(1), 5.0), ("b", ts(1), 9.0), ("b", ts(1, 0, 0, 10), 4.0)], "topic string, ts timestamp, value double")
    assert bag(health.counter_rate(table, ["topic"]).select("topic", "value", "rate")) == [
        ("a", 5.0, None), ("b", 4.0, 0.4), ("b", 9.0, None)
    ]


def test_latest_rate_is_the_rate_at_the_newest_sample(spark):
    rnd = random.Random(5)
    samples = []
    for series in "abc":
        t = 1_700_000_000
        for _ in range(60):
            t += rnd.choice([10, 30, 100, 130])
            samples.append((series, dt.datetime.fromtimestamp(t, dt.timezone.utc), float(rnd.randint(0, 50))))
    samples += [("alone", dt.datetime(2024, 1, 1), 1.0), ("null", dt.datetime(2024, 1, 1), None)]
    table = spark.createDataFrame(samples, "topic string, ts timestamp, value double")
    every = health.counter_rate(table, ["topic"], 120)
    newest = {}
    for row in sorted(every.collect(), key=lambda row: row["ts"]):
        newest[row["topic"]] = tuple(row)
    assert bag(health.latest_rate(table, ["topic"], 120)) == sorted(newest.values(), key=repr) and len(newest) == 4


def test_datasets(spark, tmp_path):
    full, empty, missing = str(tmp_path / "full"), tmp_path / "empty", str(tmp_path / "missing")
    spark.range(120).repartition(60).write.parquet(full)
    empty.mkdir()
    paths = {"full": full, "empty": str(empty), "missing": missing}
    assert bag(health.dataset_rows(spark, paths)) == [("empty", 0), ("full", 120), ("missing", 0)]
    ages = dict(rows(health.seconds_since_update(spark, paths)))
    assert ages["empty"] == ages["missing"] == float("inf") and 0 <= ages["full"] < 600
    past = F.lit("2000-01-01 00:00:00").cast("timestamp")
    assert dict(rows(health.seconds_since_update(spark, paths, past)))["full"] == 0.0
    checks = {row["dataset"]: (row["active"], row["color"]) for row in health.activity_checks(health.dataset_rows(spark, paths)).collect()}
    assert checks == {"full": (True, "green"), "empty": (False, "red"), "missing": (False, "red")}


def test_other_read_errors_are_not_swallowed(spark, tmp_path):
    from marketpulse.sources.tables import read_table_or_none

    with pytest.raises(Exception):
        read_table_or_none(spark, str(tmp_path), kind="no_such_format")


def test_offsets_from_progress(spark):
    progress = {"sources": [{"endOffset": {"prices_raw": {"0": 7, "1": 9}}}, {"endOffset": {"logOffset": 3}}, {"endOffset": None}]}
    assert bag(health.progress_end_offsets(spark, progress)) == [("prices_raw", 0, 7), ("prices_raw", 1, 9)]


def test_last_not_null(spark):
    table = spark.createDataFrame([("a", ts(1), 1.0), ("a", ts(2), None), ("b", ts(1), None)], "topic string, ts timestamp, value double")
    assert bag(health.last_not_null(table, ["topic"]).select("topic", "value")) == [("a", 1.0)]
