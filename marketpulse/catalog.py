"""Every operator as a query over the given tables: name -> function of (session, table folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketpulse import fixtures as fx
from marketpulse.functions.numbers import first_price, last_close, quote_price
from marketpulse.functions.texts import extract_cashtags, extract_tickers, full_text
from marketpulse.functions.times import day_of, epoch_to_ts, parse_ingest_ts
from marketpulse.operators import daily, decode, health, mentions, seen, sentiment, serving, signals, sizing
from marketpulse.plans import health_report, jobs, views
from marketpulse.schemas import PRICE_SPEED
from marketpulse.session import pin_utc
from marketpulse.sources import feeds, footers, tables, topics
from marketpulse.streaming import increments, jobs as streaming_jobs, listening, replay, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TICKER = "THE"
# Low enough for all three signals to occur in the test data.
MENTIONS_STEP = 5
RATE_WINDOW = fx.DAY_SECONDS


def _query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(pin_utc(spark), sf_dir)

    # A trailing underscore keeps a query apart from the function it calls.
    QUERIES[build.__name__.rstrip("_")] = run
    return run


def _joined(spark, sf):
    return jobs.build_joined(fx.price_ticks(spark, sf), fx.social_posts(spark, sf), fx.lexicon(spark), fx.WATCHLIST)


def _prices(spark, sf):
    return daily.last_price_daily(fx.price_ticks(spark, sf))


def _social(spark, sf):
    return daily.social_daily(mentions.mark_tickers(fx.social_posts(spark, sf), fx.WATCHLIST), fx.lexicon(spark))


def _signals(spark, sf):
    return signals.investment_signal(_joined(spark, sf), mentions_step=MENTIONS_STEP)


def _plain(column: str):
    """A timestamp without zone, which every client shows alike."""
    return F.col(column).cast("timestamp_ntz").alias(column)


def _joined_text(column: str):
    return F.array_join(column, ",").alias(column)


# --- sources and sinks


@_query
def table_scan(spark, sf):
    return tables.read_table(spark, f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@_query
def json_roundtrip(spark, sf):
    return decode.decode_json(topics.encode_json(fx.price_events(spark, sf)), decode.PRICE_EVENT)


@_query
def flatten_listing(spark, sf):
    return feeds.flatten_listing(fx.listing_pages(spark, sf))


@_query
def normalize_posts(spark, sf):
    posts = feeds.normalize_posts(fx.microblog(spark, sf), fx.WATCHLIST)
    return posts.select(
        "source", "uri", "cid", "author_did", "author_handle", "text", "created_at", _joined_text("tickers"), "like_count",
        "repost_count", "reply_count", "id", _plain("created_ts"),
    )


@_query
def merge_feeds(spark, sf):
    ticks = fx.price_ticks(spark, sf)
    bare = ticks.drop("ingest_ts").withColumn("source", F.lit("second"))
    return feeds.merge_feeds(ticks, bare).select("symbol", "price", "source", _plain("ingest_ts"))


@_query
def upsert_prices(spark, sf):
    """All daily prices, then all of them again restated a day later: most keys are replaced, some are new."""
    prices = sizing.settle(_prices(spark, sf))  # stands for a stored table
    target = prices.withColumnRenamed("symbol", "ticker")
    return jobs.load_prices(target, prices.withColumn("day", F.date_add("day", 1)))


@_query
def upsert_mentions(spark, sf):
    """Counts a day later without a sentiment: known keys keep theirs, new ones start at zero."""
    social = sizing.settle(_social(spark, sf))
    delta = social.select("ticker", F.date_add("day", 1).alias("day"), "mentions")
    return jobs.load_mentions(social, delta)


# --- projections and filters


@_query
def decode_prices(spark, sf):
    ticks = decode.decode_prices(fx.price_json(spark, sf), fx.now())
    return ticks.select("symbol", "price", _plain("ingest_ts"), "source")


@_query
def decode_posts(spark, sf):
    return decode.decode_posts(topics.encode_json(fx.social_posts(spark, sf)))


@_query
def valid_ticks(spark, sf):
    return decode.valid_ticks(fx.price_ticks(spark, sf)).select("symbol", "price", "source", _plain("ingest_ts"))


@_query
def mentions_exploded(spark, sf):
    rows = mentions.explode_mentions(fx.social_posts(spark, sf), fx.WATCHLIST, fx.now())
    return rows.select(
        "source", "subreddit", "id", "created_utc", "title", "text", "score", "num_comments", "permalink", "full_text",
        "ticker", _joined_text("tickers"), _plain("created_ts"), _plain("ingest_ts"), "text_length",
    )


@_query
def price_fallback(spark, sf):
    price = first_price("last_price", "lastPrice", "regularMarketPrice", "currentPrice", last_close("history"))
    return fx.quotes(spark, sf).select("event_id", price.alias("price"))


@_query
def parse_quote(spark, sf):
    return fx.events(spark, sf).select("event_id", quote_price("props", "$.k").alias("price"))


@_query
def filter_label(spark, sf):
    return serving.filter_label(health.end_offsets(fx.messages(spark, sf)), "topic", matches="cl.*|vie.")


@_query
def signal_code(spark, sf):
    return signals.signal_code(_signals(spark, sf)).select("ticker", "day", "signal", "value")


@_query
def freshness_band(spark, sf):
    return health.freshness_band(health.staleness(fx.messages(spark, sf), ["topic"], "ts", fx.now()))


@_query
def ticker_list(spark, sf):
    return serving.ticker_list(fx.price_ticks(spark, sf).withColumnRenamed("symbol", "ticker"))


# --- joins and aggregations


@_query
def last_price_ties(spark, sf):
    return daily.last_price_ties(fx.price_ticks_tied(spark, sf))


@_query
def last_price_daily(spark, sf):
    return _prices(spark, sf)


@_query
def max_ts_daily(spark, sf):
    return daily.max_ts_daily(fx.price_ticks(spark, sf)).select("symbol", "day", _plain("max_ingest_ts"))


@_query
def social_daily(spark, sf):
    return _social(spark, sf)


@_query
def joined_daily(spark, sf):
    return _joined(spark, sf)


@_query
def post_sentiment(spark, sf):
    posts = fx.social_posts(spark, sf).select("id", full_text("title", "text").alias("full_text"))
    return sentiment.post_sentiment(posts, ["id"], fx.lexicon(spark))


@_query
def end_offsets(spark, sf):
    return health.end_offsets(fx.messages(spark, sf))


@_query
def offsets_by_topic(spark, sf):
    return health.sum_by(health.end_offsets(fx.messages(spark, sf)), ["topic"], "end_offset")


@_query
def max_staleness(spark, sf):
    ages = health.staleness(fx.messages(spark, sf), ["topic"], "ts", fx.now())
    return health.max_over(ages, "seconds_since_update", "max_seconds")


def _datasets(sf):
    return {
        "prices_speed": f"{sf}/events.parquet", "social_speed": f"{sf}/documents.parquet",
        "microblog": f"{sf}/conversations.parquet", "not_there_yet": f"{sf}/no_such_table.parquet",
    }


@_query
def dataset_rows(spark, sf):
    return health.dataset_rows(spark, _datasets(sf))


@_query
def activity_checks(spark, sf):
    return health.activity_checks(health.dataset_rows(spark, _datasets(sf)))


def _ages(spark, sf):
    """Ages by event time: files' own times differ from machine to machine."""
    ticks = fx.price_ticks(spark, sf).select(F.lit("prices_speed").alias("dataset"), F.col("ingest_ts").alias("ts"))
    posts = fx.social_posts(spark, sf).select(F.lit("social_speed").alias("dataset"), epoch_to_ts("created_utc").alias("ts"))
    return health.staleness(ticks.unionByName(posts), ["dataset"], "ts", fx.now())


@_query
def dataset_health(spark, sf):
    return health_report.dataset_health(spark, _datasets(sf), _ages(spark, sf))


@_query
def overall_freshness(spark, sf):
    return health_report.overall_freshness(_ages(spark, sf))


@_query
def last_not_null(spark, sf):
    ticks = fx.price_ticks(spark, sf)
    return health.last_not_null(ticks, ["symbol"], "price", "ingest_ts").select("symbol", _plain("ingest_ts"), "price")


# --- windows and signals


@_query
def daily_deltas(spark, sf):
    return signals.daily_deltas(_joined(spark, sf))


@_query
def daily_return(spark, sf):
    return signals.daily_return(_joined(spark, sf)).select("ticker", "day", _plain("time"), "daily_return")


@_query
def investment_signal(spark, sf):
    return _signals(spark, sf)


@_query
def joined_daily_signal(spark, sf):
    rows = signals.joined_daily_signal(_joined(spark, sf))
    return rows.select(
        "ticker", "day", _plain("time"), "price_day_last", "mentions", "avg_sentiment", "daily_return", "invest_signal"
    )


@_query
def offset_rate(spark, sf):
    rates = health.counter_rate(fx.counter_samples(spark, sf), ["topic", "partition"], RATE_WINDOW)
    return rates.select("topic", "partition", _plain("ts"), "value", "rate")


# --- lookups


@_query
def prices_latest_n(spark, sf):
    return serving.prices_latest_n(_prices(spark, sf), TICKER, 10)


@_query
def mentions_latest_n(spark, sf):
    return serving.mentions_latest_n(_social(spark, sf), TICKER, 10)


@_query
def signal_latest(spark, sf):
    return serving.signal_latest(_signals(spark, sf)).select("ticker", _plain("time"), "value")


@_query
def signal_last_30(spark, sf):
    return serving.signal_last_days(_signals(spark, sf), TICKER)


@_query
def series_price(spark, sf):
    return serving.series(_joined(spark, sf), TICKER, "price_day_last")


@_query
def series_sentiment(spark, sf):
    return serving.series(_joined(spark, sf), TICKER, "avg_sentiment")


@_query
def series_mentions(spark, sf):
    return serving.series(_joined(spark, sf), TICKER, "mentions")


@_query
def signal_drivers(spark, sf):
    rows = signals.signal_drivers(serving.filter_label(_signals(spark, sf), "ticker", equals=TICKER))
    return rows.select("ticker", _plain("time"), "metric", "value")


# --- scalar functions


@_query
def parse_ingest_ts_(spark, sf):
    rows = fx.events(spark, sf)
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssX"))
        .when(kind == "purchase", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "signup", F.lit("junk"))
    )
    return rows.select("event_id", parse_ingest_ts(text, fx.now()).cast("timestamp_ntz").alias("ingest_ts"))


@_query
def day_bucket(spark, sf):
    return fx.events(spark, sf).select("event_id", day_of("ts").alias("day"))


@_query
def epoch_to_ts_(spark, sf):
    rows = fx.events(spark, sf).withColumn("seconds", F.unix_micros("ts") / F.lit(1e6))
    return rows.select("event_id", epoch_to_ts("seconds").cast("timestamp_ntz").alias("created_ts"))


@_query
def full_text_(spark, sf):
    rows = fx.social_posts(spark, sf).select("id", full_text("title", "text").alias("full_text"))
    return rows.withColumn("text_length", F.length("full_text"))


@_query
def extract_tickers_(spark, sf):
    rows = fx.social_posts(spark, sf).withColumn("tickers", extract_tickers("text", fx.WATCHLIST))
    return rows.select("id", _joined_text("tickers"))


@_query
def extract_cashtags_(spark, sf):
    rows = fx.microblog(spark, sf).withColumn("tickers", extract_cashtags("text", fx.WATCHLIST))
    return rows.select("uri", _joined_text("tickers"))


# --- streams and health


@_query
def dedupe_posts(spark, sf):
    return mentions.first_seen(fx.reposted(spark, sf)).select("subreddit", "id", _plain("ingest_ts"), "text")


@_query
def feed_health(spark, sf):
    report = health_report.feed_health(
        fx.messages(spark, sf), fx.counter_samples(spark, sf), fx.now(), RATE_WINDOW,
        ends=fx.progress_ends(spark, sf),
    )
    # Partition rates are added up in no fixed order.
    return report.withColumn("rate", F.round("rate", 9))


# --- runs of streams, with a stop and a new start in between


@_query
def stream_prices(spark, sf):
    """Messages come in two lots; each is worked through by a run of its own from the same checkpoint."""
    lake = fx.scratch(spark)
    messages = fx.price_json(spark, sf)
    for lot in (0, 1):
        messages.where(F.crc32("value") % 2 == lot).write.mode("append").parquet(f"{lake}/raw")
        replay.store_prices(spark, f"{lake}/raw", f"{lake}/ticks", f"{lake}/checkpoint", fx.now())
    ticks = tables.read_table(spark, f"{lake}/ticks", PRICE_SPEED)
    return ticks.select("symbol", "price", _plain("ingest_ts"), "source")


DEDUPE_DELAY = "10 days"


@_query
def stream_dedupe(spark, sf):
    """Half of the posts, then all of them: known ones are dropped, and so are those that the watermark has passed."""
    lake = fx.scratch(spark)
    posts = fx.reposted_at_once(spark, sf).select("subreddit", "id", F.col("ingest_ts").alias("seen_at"), "num_comments")
    reports = []
    for lot in (posts.where("num_comments % 2 = 0"), posts):
        lot.write.mode("append").parquet(f"{lake}/posts")
        feed = spark.readStream.schema(posts.schema).parquet(f"{lake}/posts").drop("num_comments")
        reports += replay.store_new_posts(feed, f"{lake}/kept", f"{lake}/checkpoint", mentions.POST_KEY, DEDUPE_DELAY, "seen_at")
    kept = tables.read_table(spark, f"{lake}/kept", posts.drop("num_comments").schema)
    return kept.select("subreddit", "id", _plain("seen_at"), F.lit(replay.late_rows(reports)).cast("bigint").alias("late_rows"))


@_query
def dedupe_across_runs(spark, sf):
    """Two thirds of the posts, and later all of them again: the second run stores the ones it has not got."""
    lake = fx.scratch(spark)
    posts = fx.reposted(spark, sf)
    known = F.substring("id", 2, 20).cast("bigint") % 3 > 0
    for run, lot in ((1, posts.where(known)), (2, posts)):
        seen.store_unseen(spark, lot.withColumn("run", F.lit(run)), f"{lake}/posts", f"{lake}/keys")
    return tables.read_table(spark, f"{lake}/posts").select("subreddit", "id", _plain("ingest_ts"), "text", "run")


@_query
def stream_upsert(spark, sf):
    """Daily prices, the same a day later, and corrected ones of one ticker: three batches into a table by key."""
    lake = fx.scratch(spark)
    prices = sizing.settle(_prices(spark, sf).withColumnRenamed("symbol", "ticker"))
    changes = [
        prices, prices.withColumn("day", F.date_add("day", 1)),
        prices.where(F.col("ticker") == TICKER).withColumn("price_day_last", F.col("price_day_last") + 1),
    ]
    schema = prices.withColumn("batch_no", F.lit(0)).schema
    for number, change in enumerate(changes):
        change.withColumn("batch_no", F.lit(number)).select(schema.fieldNames()).write.mode("append").parquet(f"{lake}/changes")
        feed = spark.readStream.schema(schema).parquet(f"{lake}/changes")
        replay.finish(store.start_upsert(feed, f"{lake}/table", f"{lake}/checkpoint", schema, ["ticker", "day"], "batch_no", replay.ALL_THERE_IS))
    return store.read_days(spark, f"{lake}/table", schema).select("ticker", "day", "price_day_last")


@_query
def stream_merge_feeds(spark, sf):
    """Two producers with a watermark each, one of them without a source of its own, as one stored feed."""
    lake = fx.scratch(spark)
    ticks = fx.price_ticks(spark, sf)
    other = ticks.drop("source")
    for name, lot in (("first", ticks), ("second", other)):
        lot.write.parquet(f"{lake}/{name}")
    producers = [spark.readStream.schema(lot.schema).parquet(f"{lake}/{name}") for name, lot in (("first", ticks), ("second", other))]
    merged = replay.merged_stream(producers, "ingest_ts", ["1 hour", "2 days"])
    replay.finish(streaming_jobs.start_append(merged, f"{lake}/merged", f"{lake}/checkpoint", trigger=replay.ALL_THERE_IS))
    return tables.read_table(spark, f"{lake}/merged", ticks.schema).select("symbol", "price", "source", _plain("ingest_ts"))


def _in_lots(rows, path, lots=3, made_of=lambda lot: lot):
    """Write rows, or what is made of them, as three lots, one after another; what follows each lot runs in between."""
    lot_of = F.pmod(F.xxhash64(*rows.columns), F.lit(lots))
    for lot in range(lots):
        made_of(rows.where(lot_of == lot)).write.mode("append").parquet(path)
        yield lot


@_query
def increment_prices(spark, sf):
    lake = fx.scratch(spark)
    ticks = fx.price_ticks(spark, sf).select(PRICE_SPEED.fieldNames())
    for _ in _in_lots(ticks, f"{lake}/ticks"):
        replay.finish(increments.start_prices_daily(spark, f"{lake}/ticks", f"{lake}/daily", f"{lake}/checkpoint", replay.ALL_THERE_IS))
    return increments.read_prices_daily(spark, f"{lake}/daily")


@_query
def increment_social(spark, sf):
    lake = fx.scratch(spark)

    def mentioned(posts):
        # Of the mentions table, the columns that the increment reads.
        return mentions.explode_mentions(posts, fx.WATCHLIST, fx.now()).select("ticker", "created_ts", "full_text")

    # Posts are dealt before tickers are looked for, so each is searched once.
    for _ in _in_lots(fx.social_posts(spark, sf), f"{lake}/mentions", made_of=mentioned):
        replay.finish(increments.start_social_daily(
            spark, f"{lake}/mentions", fx.lexicon(spark), f"{lake}/daily", f"{lake}/checkpoint", replay.ALL_THERE_IS
        ))
    return increments.read_social_daily(spark, f"{lake}/daily")


def _offset_samples(spark, sf):
    """Samples of a run over four lots of messages, each of eight days, taken by a listener and appended to a table."""
    lake = fx.scratch(spark)
    rows = fx.messages(spark, sf)
    places = [tuple(row) for row in rows.select("topic", "partition").distinct().orderBy("topic", "partition").collect()]
    for lot in range(4):
        rows.where(F.least(F.expr("(day(ts) - 1) div 8"), F.lit(3)) == lot).write.mode("append").parquet(f"{lake}/messages")
        feed = listening.observe_offsets(spark.readStream.schema(rows.schema).parquet(f"{lake}/messages"), places, "ts")
        with listening.listening(spark) as listener:
            replay.finish(streaming_jobs.start_append(feed, f"{lake}/stored", f"{lake}/checkpoint", replay.ALL_THERE_IS))
        listener.append_to(spark, f"{lake}/samples")
    return tables.read_table(spark, f"{lake}/samples", listening.SAMPLES)


@_query
def sampled_end_offsets(spark, sf):
    return listening.sampled_end_offsets(_offset_samples(spark, sf))


SAMPLED_WINDOW = 12 * fx.DAY_SECONDS


@_query
def sampled_offset_rate(spark, sf):
    samples = listening.offset_samples(_offset_samples(spark, sf))
    rates = health.counter_rate(samples, ["topic", "partition"], SAMPLED_WINDOW)
    return rates.select("topic", "partition", _plain("ts"), "value", "rate")


# --- storage layouts and metadata


def _joined_on_buckets(spark, sf):
    lake = fx.scratch(spark)
    sides = {"prices": _prices(spark, sf).withColumnRenamed("symbol", "ticker"), "social": _social(spark, sf)}
    names = {side: tables.write_bucketed(rows, f"{lake}/{side}", ["ticker"], ["day"], 8) for side, rows in sides.items()}
    session = tables.bucket_session(spark)
    return daily.joined_daily(session.table(names["prices"]), session.table(names["social"]))


@_query
def bucketed_signals(spark, sf):
    return signals.investment_signal(_joined_on_buckets(spark, sf), mentions_step=MENTIONS_STEP)


@_query
def bucketed_returns(spark, sf):
    return signals.daily_return(_joined_on_buckets(spark, sf)).select("ticker", "day", _plain("time"), "daily_return")


@_query
def footer_stats(spark, sf):
    return footers.footer_stats(spark, f"{sf}/events.parquet", ["event_id", "user_id", "value"])


@_query
def footer_rows(spark, sf):
    return footers.footer_rows(spark, _datasets(sf))


@_query
def footer_newest_by_day(spark, sf):
    """Ticks stored by day with their time as a whole number, whose bounds footers hold."""
    path = f"{fx.scratch(spark)}/ticks"
    stored = fx.price_ticks(spark, sf).select(F.unix_micros("ingest_ts").alias("ingest_us"), day_of("ingest_ts").alias("day"))
    tables.write_table(stored, path, ["day"])
    found = footers.footer_stats(spark, path, ["ingest_us"], ["day"])
    return found.select("day", "rows", F.timestamp_micros("max_ingest_us").cast("timestamp_ntz").alias("newest"))


@_query
def file_health(spark, sf):
    """Files of events stored by type, seen 400 seconds after the newest was written."""
    path = f"{fx.scratch(spark)}/events"
    fx.events(spark, sf).select("event_id", "event_type").repartition("event_type").write.partitionBy("event_type").parquet(path)
    later = F.lit(footers.newest_file(spark, path).first()["modified"]) + F.expr("INTERVAL 400 SECONDS")
    report = health.freshness_band(footers.file_report(spark, path, later))
    return report.groupBy("folder", "band").agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))


@_query
def sql_signal_last_30(spark, sf):
    views.register_views(_joined(spark, sf), mentions_step=MENTIONS_STEP)
    views.register_lookups(spark)
    return spark.sql(f"SELECT * FROM signal_last_days('{TICKER}', 30)")
