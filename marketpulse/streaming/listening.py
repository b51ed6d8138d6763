"""Metric samples of running streams, taken from the reports that Spark sends to a listener."""

from __future__ import annotations

import threading
import time
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQueryListener

SAMPLES = T.StructType([
    T.StructField("metric", T.StringType()), T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("ts", T.TimestampType()), T.StructField("value", T.DoubleType()),
])
# The observed value that gives a sample's time, in microseconds; without it the batch's own time counts.
AT = "at_us"


def label_text(labels: Mapping[str, Any]) -> str:
    """Labels as the name of an observed value: `topic=a,partition=0`."""
    return ",".join(f"{key}={value}" for key, value in sorted(labels.items()))


def labels_of(text: str) -> dict[str, str]:
    return dict(part.split("=", 1) for part in text.split(",") if "=" in part)


def observe_offsets(stream: DataFrame, places: list[tuple[str, int]], ts: str | None = None) -> DataFrame:
    """A stream of messages that reports the end offset of each (topic, partition) that occurs in a batch.

    The values are aggregates over rows that pass by in any case; no batch is read twice.
    """
    values = [
        F.max(F.when((F.col("topic") == topic) & (F.col("partition") == partition), F.col("offset") + 1)).alias(
            label_text({"topic": topic, "partition": partition})
        )
        for topic, partition in places
    ]
    if ts is not None:
        values.append(F.max(F.unix_micros(ts)).alias(AT))
    return stream.observe("end_offset", *values)


class SampleListener(StreamingQueryListener):
    """Collects (metric, labels, ts, value) from progress reports until they are taken out or appended to a table."""

    def __init__(self) -> None:
        self._rows: list[tuple] = []
        self._running = 0
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._running += 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._running -= 1

    def onQueryProgress(self, event) -> None:
        report = event.progress
        at = datetime.fromisoformat(report.timestamp.replace("Z", "+00:00"))
        rows = [("input_rows", {"query": report.name or str(report.id)}, at, float(report.numInputRows))]
        for metric, observed in report.observedMetrics.items():
            found = observed.asDict()
            moment = found.pop(AT, None)
            when = at if moment is None else datetime.fromtimestamp(moment / 1e6, timezone.utc)
            rows += [(metric, labels_of(text), when, float(value)) for text, value in found.items() if value is not None]
        with self._lock:
            self._rows += rows

    def settled(self, seconds: float = 60.0) -> bool:
        """Wait until the reports of all queries that have ended are in. Reports come in order, the end after the batches."""
        end = time.monotonic() + seconds
        while time.monotonic() < end:
            with self._lock:
                if self._running == 0:
                    return True
            time.sleep(0.05)
        return False

    def take(self, spark: SparkSession) -> DataFrame:
        """The samples since the last call."""
        with self._lock:
            rows, self._rows = self._rows, []
        return spark.createDataFrame(rows, SAMPLES)

    def append_to(self, spark: SparkSession, path: str) -> None:
        self.take(spark).coalesce(1).write.mode("append").parquet(path)


@contextmanager
def listening(spark: SparkSession) -> Iterator[SampleListener]:
    """A listener for the time of the block; at its end the reports of finished queries are in."""
    listener = SampleListener()
    spark.streams.addListener(listener)
    try:
        yield listener
        if not listener.settled():
            raise TimeoutError("the reports of finished queries did not come")
    finally:
        spark.streams.removeListener(listener)


def offset_samples(samples: DataFrame) -> DataFrame:
    """(topic, partition, ts, value): the end offsets among the samples, as the counters that rates are taken from."""
    label = lambda name: F.col("labels")[name]
    return samples.where("metric = 'end_offset'").select(
        label("topic").alias("topic"), label("partition").cast("int").alias("partition"), "ts", "value"
    )


def sampled_end_offsets(samples: DataFrame) -> DataFrame:
    """(topic, partition, end_offset) from the samples of a run, without reading any message."""
    ends: Column = F.max("value").cast("bigint")
    return offset_samples(samples).groupBy("topic", "partition").agg(ends.alias("end_offset"))
