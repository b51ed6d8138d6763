"""Streams against their batch transforms, restarts, Parquet sinks, jobs and the publishing transaction."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from marketpulse import fixtures as fx
from marketpulse.operators import decode, mentions
from marketpulse.plans import jobs
from marketpulse.schemas import MENTION_SPEED, PRICE_SPEED
from marketpulse.session import STREAM_CONF
from marketpulse.sources import jdbc, tables, topics
from marketpulse.streaming import jobs as streams

SF_DIR = "/root/testdata/sf0.001"
RAW = T.StructType([T.StructField("value", T.BinaryType())])
ONCE = {"availableNow": True}


def fixed_now():
    return F.lit(fx.NOW).cast("timestamp")


def bag(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def drain(df, out, checkpoint, **how):
    query = streams.start_append(df, out, checkpoint, trigger=ONCE, **how)
    query.awaitTermination()
    return query


def write_raw(spark, path, events):
    rows = [(json.dumps(event).encode(),) for event in events]
    spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(path)


# --- streams


def test_price_stream_equals_batch_and_survives_a_restart(spark, tmp_path):
    raw, out, checkpoint = (str(tmp_path / name) for name in ("raw", "out", "checkpoint"))
    messages = fx.price_json(spark, SF_DIR)
    messages.repartition(4).write.parquet(raw)
    source = lambda: spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(raw)
    drain(streams.price_stream(source(), fixed_now()), out, checkpoint, files_per_batch=1, name="prices")
    expected = bag(decode.decode_prices(messages, fixed_now()))
    assert bag(spark.read.parquet(out)) == expected
    drain(streams.price_stream(source(), fixed_now()), out, checkpoint)
    assert bag(spark.read.parquet(out)) == expected
    write_raw(spark, raw, [{"symbol": "NEW", "price": 1.0, "source": "y"}, {"symbol": "NO_PRICE"}])
    drain(streams.price_stream(source(), fixed_now()), out, checkpoint)
    again = spark.read.parquet(out)
    assert again.count() == len(expected) + 1
    assert again.where("symbol = 'NEW'").first()["ingest_ts"] is not None
    assert [f.name for f in again.schema] == PRICE_SPEED.fieldNames()


def test_mention_stream_equals_batch(spark, tmp_path):
    raw, out, checkpoint = (str(tmp_path / name) for name in ("raw", "out", "checkpoint"))
    posts = topics.encode_json(fx.social_posts(spark, SF_DIR))
    posts.repartition(3).write.parquet(raw)
    source = spark.readStream.schema(RAW).parquet(raw)
    drain(streams.mention_stream(source, fx.WATCHLIST, fixed_now()), out, checkpoint)
    batch = mentions.explode_mentions(decode.decode_posts(posts), fx.WATCHLIST, fixed_now())
    stored = spark.read.parquet(out)
    assert stored.select(*batch.columns).exceptAll(batch).isEmpty()
    assert stored.count() == batch.count() > 900
    assert set(stored.columns) == set(MENTION_SPEED.fieldNames())


def test_repeats_are_dropped_across_batches_and_restarts(spark, tmp_path):
    raw, out, checkpoint = (str(tmp_path / name) for name in ("raw", "out", "checkpoint"))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == list(STREAM_CONF.values())[0]
    day = 86_400.0
    event = lambda ident, created, sub="s": {"subreddit": sub, "id": ident, "created_utc": created, "text": "V"}
    blog = lambda uri: {"source": "bluesky", "uri": uri, "text": "V", "created_at": "2024-01-02T03:04:05Z", "tickers": ["V"]}
    start = lambda: drain(
        streams.mention_stream(spark.readStream.schema(RAW).parquet(raw), ["V"], fixed_now(), dedupe_delay="1 day"),
        out, checkpoint,
    )
    write_raw(spark, raw, [event("a", 100 * day), event("a", 100 * day), event("b", 100 * day), event(None, 1.0), event("", 1.0), blog("u")])
    start()
    # "old" was written long before the others, and still counts as new.
    write_raw(spark, raw, [event("a", 100 * day), event("a", 100 * day, "other"), event("old", 1 * day), blog("u"), blog("w")])
    start()
    assert bag(spark.read.parquet(out).select("subreddit", "id", F.col("created_ts").cast("string"))) == sorted([
        ("other", "a", "1970-04-11 00:00:00"), ("s", "a", "1970-04-11 00:00:00"), ("s", "b", "1970-04-11 00:00:00"),
        ("s", "old", "1970-01-02 00:00:00"), (None, "u", "2024-01-02 03:04:05"), (None, "w", "2024-01-02 03:04:05"),
    ], key=repr)


def test_repeats_by_event_time_drop_late_posts(spark, tmp_path):
    raw, out, checkpoint = (str(tmp_path / name) for name in ("raw", "out", "checkpoint"))
    schema = "id string, at timestamp"
    write = lambda *rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(raw)
    start = lambda: drain(
        streams.drop_repeats(spark.readStream.schema(schema).parquet(raw), ["id"], "1 day", event_time="at"), out, checkpoint
    )
    write(("a", dt.datetime(2024, 1, 10)), ("b", dt.datetime(2024, 1, 10)))
    start()
    write(("a", dt.datetime(2024, 1, 10)), ("late", dt.datetime(2024, 1, 1)), ("c", dt.datetime(2024, 1, 9, 12)))
    start()
    assert bag(spark.read.parquet(out).select("id")) == [("a",), ("b",), ("c",)]


def test_topic_options():
    options = topics.topic_options("b:9092", "prices_raw,social_raw", min_partitions=32, max_per_trigger=1000)
    assert options == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "prices_raw,social_raw", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "minPartitions": "32", "maxOffsetsPerTrigger": "1000",
    }


def test_bounded_batch_reads():
    options = topics.topic_options("b:9092", "t", starting='{"t":{"0":7}}', ending="latest")
    assert options["startingOffsets"] == '{"t":{"0":7}}' and options["endingOffsets"] == "latest"
    with pytest.raises(ValueError, match="no end"):
        topics.read_topic(None, "b:9092", "t", ending="latest")


class Recorder:
    """Stands in for a reader or writer: keeps what it is told and does nothing."""

    def __init__(self):
        self.said, self.done = {}, None

    def format(self, kind):
        self.said["format"] = kind
        return self

    def options(self, **options):
        self.said.update(options)
        return self

    def option(self, key, value):
        self.said[key] = value
        return self

    def save(self):
        self.done = "save"

    def start(self):
        self.done = "start"

    def load(self):
        self.done = "load"
        return self


class Sent:
    def __init__(self, streaming):
        self.isStreaming, self.write, self.writeStream = streaming, Recorder(), Recorder()

    def select(self, *_):
        return self


@pytest.mark.parametrize("streaming", [False, True])
def test_write_topic_options(spark, monkeypatch, streaming):
    events = Sent(streaming)
    topics.write_topic(events, "b:9092", "out", checkpoint="/chk")
    used = events.writeStream if streaming else events.write
    assert used.done == ("start" if streaming else "save")
    assert used.said["kafka.bootstrap.servers"] == "b:9092" and used.said["topic"] == "out" and used.said["format"] == "kafka"
    assert used.said.get("checkpointLocation") == ("/chk" if streaming else None)


def test_read_served_options():
    session = type("Session", (), {})()
    session.read = Recorder()
    jdbc.read_served(session, "jdbc:x", "served", {"user": "u"}, day_bounds=("2024-01-01", "2024-02-01"), connections=4)
    said = session.read.said
    assert session.read.done == "load" and said["dbtable"] == "served" and said["user"] == "u"
    assert (said["partitionColumn"], said["lowerBound"], said["upperBound"], said["numPartitions"]) == (
        "day", "2024-01-01", "2024-02-01", "4"
    )
    session.read = Recorder()
    jdbc.read_served(session, "jdbc:x", "served", {})
    assert "partitionColumn" not in session.read.said and session.read.said["pushDownPredicate"] == "true"


def test_run_until_any_ends(spark, tmp_path):
    spark.streams.resetTerminated()
    source = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    running = streams.start_append(source, str(tmp_path / "a"), str(tmp_path / "ca"))
    ending = streams.start_append(source, str(tmp_path / "b"), str(tmp_path / "cb"), trigger=ONCE)
    streams.run_until_any_ends(spark)
    assert running.isActive and not ending.isActive
    running.stop()
    spark.streams.resetTerminated()


# --- Parquet sinks and jobs


def test_overwrite_by_day(spark, tmp_path):
    path = str(tmp_path / "t")
    day = lambda n: dt.date(2024, 1, n)
    put = lambda rows, **how: tables.write_table(
        spark.createDataFrame(rows, "ticker string, v int, day date"), path, ["day"], **how
    )
    first = [("A", n, day(n)) for n in (1, 2, 3, 4)] + [("A", 0, None)]
    put(first)
    put([("A", 9, day(3))], since="2024-01-02")
    assert bag(spark.read.parquet(path)) == [("A", 1, day(1)), ("A", 9, day(3))], "days in range that came out empty go"
    put([("B", 5, None), ("B", 2, day(2))], since="2024-01-02")
    assert bag(spark.read.parquet(path)) == bag(
        spark.createDataFrame([("A", 1, day(1)), ("B", 2, day(2)), ("B", 5, None)], "ticker string, v int, day date")
    )
    put([("C", 1, day(4))])
    assert bag(spark.read.parquet(path)) == [("C", 1, day(4))], "a full run leaves nothing of what was there"
    flat = str(tmp_path / "flat")
    tables.write_table(spark.range(5), flat)
    tables.write_table(spark.range(2), flat)
    assert spark.read.parquet(flat).count() == 2


def test_stored_jobs_equal_the_direct_composition(spark, tmp_path):
    lake = lambda name: str(tmp_path / name)
    ticks, posts = fx.price_ticks(spark, SF_DIR), fx.social_posts(spark, SF_DIR)
    decode.valid_ticks(ticks).write.parquet(lake("ticks"))
    mentions.explode_mentions(posts, fx.WATCHLIST, fixed_now()).write.parquet(lake("mentions"))
    lexicon = fx.lexicon(spark)
    jobs.run_prices_daily(spark, lake("ticks"), lake("prices"))
    jobs.run_social_daily(spark, lake("mentions"), lexicon, lake("social"))
    jobs.run_joined_daily(spark, lake("prices"), lake("social"), lake("joined"))
    expected = bag(jobs.build_joined(ticks, posts, lexicon, fx.WATCHLIST))
    assert bag(spark.read.parquet(lake("joined"))) == expected and len(expected) == 366

    jobs.run_prices_daily(spark, lake("ticks"), lake("prices_by_day"), by_day=True)
    jobs.run_prices_daily(spark, lake("ticks"), lake("prices_by_day"), since="2024-01-20", by_day=True)
    jobs.run_social_daily(spark, lake("mentions"), lexicon, lake("social_by_day"), by_day=True)
    jobs.run_joined_daily(spark, lake("prices_by_day"), lake("social_by_day"), lake("joined_by_day"), by_day=True)
    whole = bag(spark.read.parquet(lake("joined_by_day")))
    jobs.run_joined_daily(
        spark, lake("prices_by_day"), lake("social_by_day"), lake("joined_by_day"), since="2024-01-20", by_day=True
    )
    assert bag(spark.read.parquet(lake("joined_by_day"))) == whole
    by_day = spark.read.parquet(lake("joined_by_day"))
    assert bag(by_day.select("ticker", "day", "price_day_last", "avg_sentiment", "mentions")) == expected
    with pytest.raises(ValueError):
        jobs.run_prices_daily(spark, lake("ticks"), lake("prices"), since="2024-01-20")


# --- publishing, against a stand-in for the database


class FakeConnection:
    def __init__(self, fail_on=None):
        self.log, self.fail_on = [], fail_on

    def setAutoCommit(self, value):
        self.log.append(f"autocommit {value}")

    def createStatement(self):
        return self

    def execute(self, sql):
        if self.fail_on and sql.startswith(self.fail_on):
            raise RuntimeError("refused")
        self.log.append(sql)

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def published(spark, path, connection):
    staged = []
    stage = lambda df, url, table, properties, connections: staged.append((table, df.columns, bag(df)))
    done = jobs.run_publish(
        spark, path, "jdbc:x", "joined_daily", {}, connect=lambda *_: connection, stage=stage
    )
    return done, staged


def test_publish(spark, tmp_path):
    path = str(tmp_path / "joined")
    assert published(spark, path, FakeConnection()) == (False, [])
    rows = [(1, "A", dt.date(2024, 1, 1), 1.0, 0.5), (2, "A", None, 2.0, 0.5), (3, None, dt.date(2024, 1, 1), 2.0, 0.5)]
    spark.createDataFrame(
        rows, "mentions bigint, ticker string, day date, price_day_last double, avg_sentiment double"
    ).write.parquet(path)
    connection = FakeConnection()
    done, staged = published(spark, path, connection)
    assert done and staged == [
        ("joined_daily__staging", list(jdbc.JOINED_COLUMNS), [("A", dt.date(2024, 1, 1), 1.0, 0.5, 1)])
    ]
    names = ", ".join(jdbc.JOINED_COLUMNS)
    assert connection.log == [
        "autocommit False", "LOCK TABLE joined_daily IN EXCLUSIVE MODE", "TRUNCATE TABLE joined_daily",
        f"INSERT INTO joined_daily ({names}) SELECT {names} FROM joined_daily__staging", "close", "commit", "close",
    ]


def test_merge_into_a_keyed_table(spark):
    connection, staged = FakeConnection(), []
    counts = spark.createDataFrame([("A", dt.date(2024, 1, 1), 3), ("A", None, 4)], "ticker string, day date, mentions bigint")
    jdbc.merge_jdbc(
        counts, "jdbc:x", "social_daily", {}, ["ticker", "day", "mentions"], connect=lambda *_: connection,
        stage=lambda df, url, table, *_: staged.append((table, bag(df))),
    )
    assert staged == [("social_daily__staging", [("A", dt.date(2024, 1, 1), 3)])]
    assert connection.log == [
        "autocommit False",
        "INSERT INTO social_daily (ticker, day, mentions) SELECT ticker, day, mentions FROM social_daily__staging "
        "ON CONFLICT (ticker, day) DO UPDATE SET mentions = EXCLUDED.mentions",
        "close", "commit", "close",
    ]


def test_failed_publish_rolls_back(spark, tmp_path):
    path = str(tmp_path / "joined")
    fx_rows = [("A", dt.date(2024, 1, 1), 1.0, 0.5, 1)]
    spark.createDataFrame(
        fx_rows, "ticker string, day date, price_day_last double, avg_sentiment double, mentions bigint"
    ).write.parquet(path)
    connection = FakeConnection(fail_on="INSERT")
    with pytest.raises(RuntimeError):
        published(spark, path, connection)
    assert connection.log[-3:] == ["close", "rollback", "close"] and "commit" not in connection.log


def test_checkpoint_folder_comes_from_the_session(spark):
    from marketpulse.session import ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark)
    assert folder and ensure_checkpoint_dir(spark) == folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or folder.startswith(("file:", named))
    assert os.path.isdir(folder.replace("file:", "", 1))
