"""Runs that go on from earlier ones, and what plans read: keyed tables of streams, key indexes, buckets, footers, metadata."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from marketpulse import fixtures as fx
from marketpulse.catalog import QUERIES
from marketpulse.operators import mentions, seen
from marketpulse.plans import views
from marketpulse.schemas import LAST_PRICES, PRICE_SPEED
from marketpulse.sources import footers, tables
from marketpulse.streaming import increments, listening, replay, store
from marketpulse.streaming.jobs import start_append

SF_DIR = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 2)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bag(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


ROWS = "ticker string, v int, day date"


def rows(spark, *values):
    return spark.createDataFrame(values, ROWS)


def last_wins(old, new):
    from marketpulse.operators.upsert import upsert

    return upsert(old, new, ["ticker", "day"])


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    path, schema = str(tmp_path / "t"), rows(spark).schema
    table = lambda: bag(store.read_days(spark, path, schema))
    put = lambda batch, *values: store.merge_batch(rows(spark, *values), batch, path, schema, last_wins)
    assert table() == [] and store.committed_batches(spark, path) == []
    assert put(0, ("A", 1, DAY), ("A", 1, None), ("B", 1, DAY), ("C", 1, dt.date(2024, 1, 3)))
    assert put(1, ("A", 2, DAY), ("D", 2, None))
    expected = sorted([("A", 2, DAY), ("B", 1, DAY), ("C", 1, dt.date(2024, 1, 3)), ("A", 1, None), ("D", 2, None)], key=repr)
    assert table() == expected
    assert not put(1, ("A", 9, DAY)) and table() == expected, "a batch that is run again is known by its id"
    # A batch that failed before its marker was written counts for nothing, and is written anew.
    assert put(2, ("A", 3, DAY))
    os.remove(os.path.join(path, "batch=2", store.MARKER))
    assert table() == expected
    assert put(2, ("A", 4, DAY)) and ("A", 4, DAY) in table() and ("B", 1, DAY) in table()
    assert store.newest_days(spark, path) == {"2024-01-02": 2, "2024-01-03": 0, store.NO_DAY: 1}


def test_only_the_days_of_a_batch_are_read_and_written(spark, tmp_path):
    path, schema = str(tmp_path / "t"), rows(spark).schema
    store.merge_batch(rows(spark, *[("A", n, dt.date(2024, 1, n)) for n in range(1, 21)]), 0, path, schema, last_wins)
    assert len(store.read_days(spark, path, schema, ["2024-01-05"]).inputFiles()) == 1
    store.merge_batch(rows(spark, ("A", 0, dt.date(2024, 1, 5))), 1, path, schema, last_wins)
    assert [name for name in os.listdir(os.path.join(path, "batch=1")) if "=" in name] == ["day=2024-01-05"]
    assert store.read_days(spark, path, schema).count() == 20


def test_upsert_stream_keeps_the_last_row_of_a_key(spark, tmp_path):
    lake = str(tmp_path)
    schema = spark.createDataFrame([], "ticker string, v int, day date, at int").schema
    for lot in ([("A", 1, DAY, 1), ("A", 2, DAY, 3), ("A", 3, DAY, 2), ("B", 1, None, 1)], [("A", 0, DAY, 0), ("B", 5, None, None)]):
        spark.createDataFrame(lot, schema).write.mode("append").parquet(f"{lake}/in")
        feed = spark.readStream.schema(schema).parquet(f"{lake}/in")
        replay.finish(store.start_upsert(feed, f"{lake}/t", f"{lake}/c", schema, ["ticker", "day"], "at", replay.ALL_THERE_IS))
    assert bag(store.read_days(spark, f"{lake}/t", schema)) == sorted([("A", 0, DAY, 0), ("B", 5, None, None)], key=repr)
    with pytest.raises(ValueError, match="day"):
        store.start_upsert(None, "", "", schema, ["ticker"], "at")


def test_increments_read_new_files_only(spark, tmp_path):
    lake = str(tmp_path)
    ticks = fx.price_ticks(spark, SF_DIR).select(PRICE_SPEED.fieldNames())
    lots = [ticks.where(F.dayofmonth("ingest_ts") <= 10), ticks.where(F.dayofmonth("ingest_ts") > 10), ticks.limit(0), ticks.limit(7)]
    sizes = []
    for lot in lots:
        lot.write.mode("append").parquet(f"{lake}/ticks")
        sizes.append(replay.input_rows(replay.finish(
            increments.start_prices_daily(spark, f"{lake}/ticks", f"{lake}/daily", f"{lake}/c", replay.ALL_THERE_IS)
        )))
    # New files are scanned for the newest times and once more for the prices at them.
    assert sizes == [2 * lot.count() for lot in lots], "each run reads the files that were added before it, and no other"
    assert bag(increments.read_prices_daily(spark, f"{lake}/daily")) == bag(QUERIES["last_price_daily"](spark, SF_DIR))
    late = spark.createDataFrame([("THE", 5e9, dt.datetime(2024, 1, 3, 23, 59, 59, 999999), "s"), ("THE", float("nan"), None, "s")], PRICE_SPEED)
    late.write.mode("append").parquet(f"{lake}/ticks")
    replay.finish(increments.start_prices_daily(spark, f"{lake}/ticks", f"{lake}/daily", f"{lake}/c", replay.ALL_THERE_IS))
    got = increments.read_prices_daily(spark, f"{lake}/daily").where("symbol = 'THE' AND day = DATE'2024-01-03'")
    assert [row["price_day_last"] for row in got.collect()] == [5e9]
    assert store.read_days(spark, f"{lake}/daily", LAST_PRICES).groupBy("symbol", "day").count().where("count > 1").isEmpty()


def test_known_keys_are_found_by_a_bloom_filter(spark, tmp_path):
    index_path = str(tmp_path / "keys")
    posts = seen.indexed_day(mentions.first_seen(fx.reposted(spark, SF_DIR))).withColumns(seen.named_keys(mentions.POST_KEY))
    names = list(seen.named_keys(mentions.POST_KEY))
    posts.select(*names, "day").write.partitionBy("day").parquet(index_path)
    batch = seen.settle_as_table(posts.where("num_comments = 7"))
    with seen.with_conf(spark, seen.BLOOM_CONF):
        known = seen.known_keys(spark.read.parquet(index_path), batch, names)
        text = plan(known)
        assert known.count() == batch.count() > 0
    assert "might_contain" in text and "bloom_filter_agg" in text, "the index is filtered by the batch's ids"
    assert "dynamicpruning" in text, "folders of other days are not read"
    assert "text" not in text.split("ReadSchema")[1].split("\n")[0]
    assert spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold") != "0"


def test_posts_are_stored_once_over_many_runs(spark, tmp_path):
    lake = str(tmp_path)
    schema = "subreddit string, id string, created_utc double, ingest_ts timestamp, text string"
    at = dt.datetime(2024, 1, 5)
    put = lambda *values: seen.store_unseen(spark, spark.createDataFrame([(*v, at, "t") for v in values], schema), f"{lake}/posts", f"{lake}/keys")
    put(("s", "a", 1e9), ("s", "a", 1e9), ("s", None, 1e9), ("s", "", 1e9), (None, "a", None))
    put(("s", "a", 1e9), ("t", "a", 1e9), (None, "a", None), ("s", "b", None))
    put()
    put(("s", "b", None), ("t", "a", 1e9))
    stored = bag(spark.read.parquet(f"{lake}/posts").select("subreddit", "id", "text"))
    assert stored == sorted([("s", "a", "t"), (None, "a", "t"), ("t", "a", "t"), ("s", "b", "t")], key=repr)


def test_late_rows_are_counted(spark, tmp_path):
    lake = str(tmp_path)
    schema = "id string, at timestamp"
    reports = []
    for lot in ([("a", dt.datetime(2024, 1, 10))], [("b", dt.datetime(2024, 1, 1)), ("c", dt.datetime(2024, 1, 2)), ("a", dt.datetime(2024, 1, 10))]):
        spark.createDataFrame(lot, schema).write.mode("append").parquet(f"{lake}/in")
        feed = spark.readStream.schema(schema).parquet(f"{lake}/in")
        reports += replay.store_new_posts(feed, f"{lake}/out", f"{lake}/c", ["id"], "1 day", "at")
    assert bag(spark.read.parquet(f"{lake}/out").select("id")) == [("a",)]
    assert replay.late_rows(reports) == 2 and replay.input_rows(reports) == 4


@pytest.mark.parametrize("slowest_counts, expected", [(True, ["a", "b", "late"]), (False, ["a", "b"])])
def test_a_late_feed(spark, tmp_path, slowest_counts, expected):
    """One producer is ten days behind. Its posts are kept while the slowest feed's watermark counts, and late otherwise."""
    lake, schema = str(tmp_path), "id string, at timestamp"
    ahead, behind = [("a", dt.datetime(2024, 1, 20)), ("b", dt.datetime(2024, 1, 21))], [("late", dt.datetime(2024, 1, 10))]
    for lots in (([ahead[0]], [("late0", dt.datetime(2024, 1, 9))]), ([ahead[1]], behind)):
        for name, lot in zip(("x", "y"), lots):
            spark.createDataFrame(lot, schema).write.mode("append").parquet(f"{lake}/{name}")
        feeds = [spark.readStream.schema(schema).parquet(f"{lake}/{name}") for name in ("x", "y")]
        merged = replay.merged_stream(feeds, "at", ["1 day", "1 day"], slowest_counts).dropDuplicatesWithinWatermark(["id"])
        replay.finish(start_append(merged, f"{lake}/out", f"{lake}/c", replay.ALL_THERE_IS))
    assert bag(spark.read.parquet(f"{lake}/out").where("id <> 'late0'").select("id")) == [(i,) for i in expected]
    spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")
    with pytest.raises(ValueError, match="delay"):
        replay.merged_stream(feeds, "at", ["1 day"])


@pytest.mark.parametrize("name", ["bucketed_signals", "bucketed_returns"])
def test_buckets_join_and_lag_without_a_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "Exchange" not in text and "SortMergeJoin" in text and "Window" in text
    assert text.count("Bucketed: true") == 2


def test_footers_answer_counts_and_bounds(spark, tmp_path):
    text = plan(QUERIES["footer_stats"](spark, SF_DIR))
    for pushed in ("COUNT(*)", "MIN(event_id)", "MAX(event_id)", "MIN(value)", "MAX(value)"):
        assert pushed in text.split("PushedAggregation")[1].split("]")[0]
    assert "max(ingest_us)" in plan(QUERIES["footer_newest_by_day"](spark, SF_DIR)).split("PushedAggregation")[1].lower()
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != "", "the caller's session stays as it is"
    missing = str(tmp_path / "none")
    assert footers.footer_stats(spark, missing, ["a"]).first().asDict() == {"rows": 0, "min_a": None, "max_a": None}
    with pytest.raises(ValueError, match="not there"):
        footers.footer_stats(spark, missing, ["a"], ["day"])


def test_file_report_reads_no_column(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(4).write.parquet(path)
    newest = footers.newest_file(spark, path).first()["modified"]
    report = footers.file_report(spark, path, F.lit(newest) + F.expr("INTERVAL 7 SECONDS"))
    assert "ReadSchema: struct<>" in plan(report)
    got = report.collect()
    assert {r["file"] for r in got} == {name for name in os.listdir(path) if name.endswith(".parquet")}
    assert all(r["bytes"] == os.path.getsize(os.path.join(path, r["file"])) and r["folder"] == "" for r in got)
    assert sum(r["rows"] for r in got) == 100 and min(r["seconds_since_update"] for r in got) == 7.0


def test_lookups_for_sql(spark, tmp_path):
    path = str(tmp_path / "joined")
    QUERIES["joined_daily"](spark, SF_DIR).write.parquet(path)
    views.register_views(spark.read.parquet(path), mentions_step=5)
    views.register_lookups(spark)
    days = spark.read.parquet(path).where("ticker = 'THE'").count()
    count = lambda call: spark.sql(f"SELECT * FROM {call}").count()
    assert count("signal_last_days('THE', 30)") == min(days, 30) and count("signal_last_days('THE')") == min(days, 30)
    assert count("prices_last_days('THE', 0)") == 1 and count("prices_last_days('THE', -5)") == 1
    assert count("mentions_last_days('THE', 100000)") == min(days, 365) and count("prices_last_days('NONE', 3)") == 0
    newest = spark.sql("SELECT max(day) FROM prices_last_days('THE', 1)").first()[0]
    assert newest == spark.read.parquet(path).where("ticker = 'THE'").agg(F.max("day")).first()[0]
    assert "EqualTo(ticker,THE)" in plan(spark.sql("SELECT * FROM signal_last_days('THE', 3)"))


def test_listener_samples(spark, tmp_path):
    lake = str(tmp_path)
    schema = "topic string, partition int, offset bigint, ts timestamp"
    values = [("a", 0, n, dt.datetime(2024, 1, 1, n)) for n in range(5)] + [("a", 1, 9, dt.datetime(2024, 1, 1))]
    spark.createDataFrame(values, schema).write.parquet(f"{lake}/in")
    with listening.listening(spark) as listener:
        feed = listening.observe_offsets(spark.readStream.schema(schema).parquet(f"{lake}/in"), [("a", 0), ("a", 1), ("b", 0)], "ts")
        replay.finish(start_append(feed, f"{lake}/out", f"{lake}/c", replay.ALL_THERE_IS, name="offsets"))
    listener.append_to(spark, f"{lake}/samples")
    samples = spark.read.parquet(f"{lake}/samples")
    assert bag(listening.sampled_end_offsets(samples)) == [("a", 0, 5), ("a", 1, 10)]
    assert {row["ts"] for row in listening.offset_samples(samples).collect()} == {dt.datetime(2024, 1, 1, 4)}
    # A run ends with a batch without rows.
    assert samples.where("metric = 'input_rows' AND labels['query'] = 'offsets'").agg(F.sum("value")).first()[0] == 6.0
    assert listener.take(spark).isEmpty()
