"""Kafka topics. The connector jar is the cluster's to provide (`spark.jars.packages`)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def topic_options(
    brokers: str, topics: str, min_partitions: int | None = None, max_per_trigger: int | None = None,
    starting: str = "earliest", ending: str | None = None,
) -> dict[str, str]:
    """Source options: from the earliest offset, going on when the broker has already deleted old messages.

    `min_partitions` lets several tasks read a topic that has fewer partitions than the cluster has cores. `starting` and
    `ending` bound a read by offsets ("earliest", "latest", or JSON of topic, partition and offset); only a batch has an
    end. A batch from a query's last known offsets on reads the newest messages without the ones before.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topics,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if ending is not None:
        options["endingOffsets"] = ending
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_topic(spark: SparkSession, brokers: str, topics: str, streaming: bool = True, **limits: int | str) -> DataFrame:
    """Messages of one topic, or of several separated by commas; `value` holds the JSON bytes."""
    if streaming and limits.get("ending") is not None:
        raise ValueError("a stream has no end: read a batch")
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**topic_options(brokers, topics, **limits)).load()


def encode_json(events: DataFrame) -> DataFrame:
    """Each row as one JSON document in `value`. Nulls are written out, as producers do."""
    return events.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).cast("binary").alias("value"))


def write_topic(events: DataFrame, brokers: str, topic: str, checkpoint: str | None = None):
    """Send rows to a topic: at once for a batch, as a running query for a stream (which needs a checkpoint)."""
    options = {"kafka.bootstrap.servers": brokers, "topic": topic}
    encoded = encode_json(events)
    if not events.isStreaming:
        return encoded.write.format("kafka").options(**options).save()
    return encoded.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()
