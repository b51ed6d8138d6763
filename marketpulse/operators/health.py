"""Feed and dataset health."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from marketpulse.functions.numbers import ACTIVITY_STEPS, DATASET_AGE_STEPS, band
from marketpulse.operators.sizing import at_newest, broadcast_when_small, settle
from marketpulse.sources.tables import read_table_or_none


def end_offsets(messages: DataFrame) -> DataFrame:
    """(topic, partition, end_offset) from a batch read of topics: the next offset to be written.

    For a running stream the query progress holds the same numbers without a scan: see `progress_end_offsets`.
    """
    last = messages.groupBy("topic", "partition").agg(F.max("offset").alias("last"))
    return last.select("topic", "partition", (F.col("last") + 1).alias("end_offset"))


def sum_by(samples: DataFrame, labels: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """Sum over all labels but the given ones."""
    return samples.groupBy(*labels).agg(F.sum(value).alias(name or value))


def max_over(samples: DataFrame, value: str, name: str | None = None) -> DataFrame:
    return samples.agg(F.max(value).alias(name or value))


def last_not_null(samples: DataFrame, labels: Sequence[str], value: str = "value", ts: str = "ts") -> DataFrame:
    """The newest value of each series that is not null; of several at one instant the highest."""
    kept = samples.where(F.col(value).isNotNull() & F.col(ts).isNotNull()).select(*labels, ts, value)
    return at_newest(kept, labels, ts).groupBy(*labels, ts).agg(F.max(value).alias(value))


def dataset_rows(spark: SparkSession, datasets: Mapping[str, str]) -> DataFrame:
    """(dataset, rows) by a full count of each Parquet dataset; 0 for one that is not there yet."""
    counts = []
    for name, path in datasets.items():
        table = read_table_or_none(spark, path)
        counted = spark.range(1).select(F.lit(0).cast("bigint").alias("rows")) if table is None else table.agg(
            F.count("*").alias("rows")
        )
        counts.append(counted.select(F.lit(name).alias("dataset"), "rows"))
    return reduce(DataFrame.unionByName, counts)


def age_seconds(moment: Column | str, now: Column) -> Column:
    """Seconds from `moment` to `now`, at least 0; infinite for a null moment."""
    moment = F.col(moment) if isinstance(moment, str) else moment
    age = (F.unix_micros(now) - F.unix_micros(moment)) / F.lit(1e6)
    return F.when(moment.isNull(), F.lit(float("inf"))).otherwise(F.greatest(age, F.lit(0.0)))


def seconds_since_update(spark: SparkSession, datasets: Mapping[str, str], now: Column | None = None) -> DataFrame:
    """(dataset, seconds_since_update): age of the newest file, at least 0, infinite when there is none.

    Only file metadata is read. Spark skips marker files such as _SUCCESS.
    """
    now = F.current_timestamp() if now is None else now
    ages = []
    for name, path in datasets.items():
        files = read_table_or_none(spark, path, kind="binaryFile", recursiveFileLookup="true")
        newest = (
            spark.range(1).select(F.lit(None).cast("timestamp").alias("newest")) if files is None
            else files.agg(F.max("modificationTime").alias("newest"))
        )
        ages.append(newest.select(F.lit(name).alias("dataset"), age_seconds("newest", now).alias("seconds_since_update")))
    return reduce(DataFrame.unionByName, ages)


def staleness(rows: DataFrame, labels: Sequence[str], ts: str, now: Column) -> DataFrame:
    """(labels, seconds_since_update) from the newest event time of each group, at least 0."""
    newest = rows.groupBy(*labels).agg(F.max(ts).alias("_newest"))
    return newest.select(*labels, age_seconds("_newest", now).alias("seconds_since_update"))


def activity_checks(counts: DataFrame) -> DataFrame:
    """Adds active (has rows) and its color to (dataset, rows)."""
    return counts.withColumn("active", F.col("rows") > 0).withColumn("color", band("rows", ACTIVITY_STEPS))


def freshness_band(ages: DataFrame, steps=DATASET_AGE_STEPS) -> DataFrame:
    """Adds band to a table with seconds_since_update."""
    return ages.withColumn("band", band("seconds_since_update", steps))


def counter_rate(
    samples: DataFrame, labels: Sequence[str], window_seconds: int = 120, ts: str = "ts", value: str = "value",
    windows_per_chunk: int = 4,
) -> DataFrame:
    """(labels, ts, value, rate): per-second growth of a counter over the window that ends at each sample.

    A sample lower than the one before it is a reset and counts in full. The growth is summed between the first and
    the last sample in the window and divided by the time between them; fewer than two samples give null. Growth is not
    extrapolated to the window's edges, as Prometheus' rate() would. Samples of a series should differ in time.

    A series is cut into chunks of time of several windows each. A chunk also gets the samples of one window before it,
    so no window is cut, and a hot series spreads over as many tasks as it has chunks. Inside a chunk growth is a
    running total, and the start of each window is found by one more ordered pass, so the work is linear in the samples,
    where a sliding frame would visit each sample once per window that covers it.
    """
    span = int(window_seconds * 1_000_000)
    chunk = span * windows_per_chunk
    labels = list(labels)
    ticks = samples.where(F.col(ts).isNotNull() & F.col(value).isNotNull()).select(
        *labels, F.unix_micros(F.col(ts).cast("timestamp")).alias("_t"), F.col(value).cast("double").alias("_v")
    )
    own = F.expr(f"(_t - pmod(_t, {chunk}L)) div {chunk}L")
    # A sample in the last window of its chunk goes to the next chunk as well, but is only answered for in its own.
    places = F.when(
        F.pmod("_t", F.lit(chunk)) >= chunk - span,
        F.array(F.struct(own.alias("chunk"), F.lit(True).alias("home")), F.struct((own + 1).alias("chunk"), F.lit(False).alias("home"))),
    ).otherwise(F.array(F.struct(own.alias("chunk"), F.lit(True).alias("home"))))
    placed = ticks.select(*labels, "_t", "_v", F.inline(places).alias("_chunk", "_home"))

    parts = Window.partitionBy(*labels, "_chunk")
    forward = parts.orderBy("_t", "_v")
    before = F.lag("_v").over(forward)
    gain = F.when(before.isNull(), 0.0).when(F.col("_v") < before, F.col("_v")).otherwise(F.col("_v") - before)
    climbed = placed.withColumn("_gain", gain).select(
        *labels, "_chunk", "_home", "_t", "_v",
        F.sum("_gain").over(forward.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_climb"),
    )

    # Each sample is seen twice: as a point that windows can start at, and, shifted back by the window, as a question
    # for the first point from there on. Read from the newest to the oldest, that point is the last one passed. The two
    # are told apart by the lowest bit of the sort key, so that a point comes before a question of the same instant.
    point, question = F.shiftleft("_t", 1) + 1, F.shiftleft(F.col("_t") - span, 1)
    marked = climbed.select(
        *labels, "_chunk", "_t", "_v", "_climb",
        F.explode(F.when(F.col("_home"), F.array(point, question)).otherwise(F.array(point))).alias("_at"),
    )
    is_point = F.col("_at").bitwiseAND(1) == 1
    backward = parts.orderBy(F.desc("_at"), F.desc("_climb")).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def at_start(column: str) -> Column:
        return F.last(F.when(is_point, F.col(column)), ignorenulls=True).over(backward)

    answered = marked.select(
        *labels, "_t", "_v", "_at",
        (F.col("_climb") - at_start("_climb")).alias("_growth"),
        ((F.col("_t") - at_start("_t")) / F.lit(1e6)).alias("_elapsed"),
    ).where(~is_point)
    return answered.select(
        *labels, F.timestamp_micros("_t").alias(ts), F.col("_v").alias(value),
        F.when(F.col("_elapsed") > 0, F.col("_growth") / F.col("_elapsed")).alias("rate"),
    )


def latest_rate(
    samples: DataFrame, labels: Sequence[str], window_seconds: int = 120, ts: str = "ts", value: str = "value"
) -> DataFrame:
    """(labels, ts, value, rate) at the newest sample of each series only.

    The newest time of every series is found by a partial aggregate, written out and broadcast when counted small; then
    only the samples of one window per series are shuffled and sorted, and not the whole history.
    """
    labels = list(labels)
    kept = samples.where(F.col(ts).isNotNull() & F.col(value).isNotNull())
    newest = settle(kept.groupBy(*labels).agg(F.max(ts).alias("_newest")))
    recent = kept.join(broadcast_when_small(newest), labels).where(
        F.unix_micros(ts) >= F.unix_micros("_newest") - int(window_seconds * 1_000_000)
    )
    rates = counter_rate(recent.select(*labels, ts, value), labels, window_seconds, ts, value)
    last = rates.groupBy(*labels).agg(F.max(F.struct(ts, value, "rate")).alias("_last"))
    return last.select(*labels, "_last.*")


def progress_end_offsets(spark: SparkSession, progress: Mapping) -> DataFrame:
    """(topic, partition, end_offset) from a streaming query's progress report, without reading any message."""
    rows = []
    for source in progress.get("sources", []):
        offsets = source.get("endOffset")
        if isinstance(offsets, Mapping):
            for topic, parts in offsets.items():
                if isinstance(parts, Mapping):
                    rows += [(topic, int(part), int(offset)) for part, offset in parts.items()]
    return spark.createDataFrame(rows, "topic string, partition int, end_offset bigint")
