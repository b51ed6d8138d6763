"""Health figures: one row per topic, one per dataset, and one for all datasets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketpulse.functions.numbers import ACTIVITY_STEPS, DATASET_AGE_STEPS, FRESHNESS_STEPS, UP_LABELS, band, mapped
from marketpulse.operators.health import (
    activity_checks, age_seconds, dataset_rows, end_offsets, freshness_band, latest_rate, max_over, seconds_since_update,
    sum_by,
)


def feed_health(
    messages: DataFrame, samples: DataFrame, now: Column, window_seconds: int = 120, ends: DataFrame | None = None
) -> DataFrame:
    """(topic, end_offset, rows, seconds_since_update, age_band, activity, rate).

    `messages` holds (topic, ts) of what has been stored and is read once, for counts and ages; `samples` a counter per
    (topic, partition) over time. `rate` is the rate at the newest sample of each partition, summed. `ends` holds
    (topic, partition, end_offset) from a query's progress or a bounded read of the topics; without it the offsets in
    `messages` are searched for the last ones. What is joined is one row per topic.
    """
    ends = end_offsets(messages) if ends is None else ends
    counted = messages.groupBy("topic").agg(F.count("*").alias("rows"), F.max("ts").alias("newest"))
    topics = sum_by(ends, ["topic"], "end_offset").join(counted, "topic", "left").fillna({"rows": 0})
    rate = sum_by(latest_rate(samples, ["topic", "partition"], window_seconds), ["topic"], "rate")
    return (
        topics.withColumn("seconds_since_update", age_seconds("newest", now))
        .join(rate, "topic", "left")
        .select(
            "topic", "end_offset", "rows", "seconds_since_update",
            band("seconds_since_update", DATASET_AGE_STEPS).alias("age_band"),
            band("rows", ACTIVITY_STEPS).alias("activity"),
            "rate",
        )
    )


def dataset_health(spark: SparkSession, datasets: Mapping[str, str], ages: DataFrame | None = None) -> DataFrame:
    """(dataset, rows, active, color, status, seconds_since_update, band) for each Parquet dataset.

    Ages are those of the newest files, or come as `ages` (dataset, seconds_since_update), as of event times; a dataset
    that has none is infinitely old.
    """
    ages = seconds_since_update(spark, datasets) if ages is None else ages
    checked = activity_checks(dataset_rows(spark, datasets)).withColumn("status", mapped(F.col("active").cast("int"), UP_LABELS))
    return freshness_band(checked.join(ages, "dataset", "left").fillna({"seconds_since_update": float("inf")}))


def overall_freshness(ages: DataFrame) -> DataFrame:
    """(max_seconds, band): the oldest dataset on the ladder for all of them."""
    return max_over(ages, "seconds_since_update", "max_seconds").withColumn("band", band("max_seconds", FRESHNESS_STEPS))
