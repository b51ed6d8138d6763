"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that can be changed on a running session.
RUNTIME_CONF = {
    # Days are cut in UTC, whatever the cluster's own zone is.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot join key (one text copied a million times, one busy ticker) over several tasks.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rewrites only the day folders that a job touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Settings for streams: de-duplication state lives in RocksDB on local disk, with small changelog uploads,
# so the number of keys inside the watermark is not limited by executor heap.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Files of settled intermediate results go when the last plan that reads them is gone.
START_CONF = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def build_session(app_name: str = "marketpulse", conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above; `conf` wins over them. Shuffle width is left to the cluster and AQE."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**START_CONF, **RUNTIME_CONF, **STREAM_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Make a session that somebody else built cut days in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names; a private one only for a local master."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        named = tempfile.mkdtemp(prefix="marketpulse-checkpoint-")
    context.setCheckpointDir(named)
    return named
