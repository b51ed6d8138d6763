"""De-duplication against everything that earlier runs have stored.

Beside the stored posts lies an index of their keys, in folders by day. A new batch asks it which of its keys are known:
the index is semi-joined with the batch's keys, so only folders of the batch's days are listed, and a Bloom filter of the
batch's ids, which Spark makes at run time, drops nearly all other keys while the index is scanned. Stored texts are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketpulse.functions.times import epoch_to_ts
from marketpulse.operators.mentions import POST_KEY, first_seen
from marketpulse.operators.sizing import settle_as_table
from marketpulse.sources.tables import read_table_or_none

# From which size of the index on a scan gets a Bloom filter, and up to which size of a batch one is made. The batch is not
# broadcast, however small: Spark makes such filters for joins that shuffle, and the plan is to be the same at every size.
BLOOM_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
}

# Stands for the day of a post that has no time.
NO_TIME = "0001-01-01"


@contextmanager
def with_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings for the plans that are made and run inside the block."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def named_keys(keys: Sequence[str]) -> dict[str, Column]:
    """The columns that the index holds besides the day. A null has a value there, so that it joins and can be filtered."""
    return {f"key_{key}": F.coalesce(key, F.lit("")) for key in keys}


def indexed_day(posts: DataFrame) -> DataFrame:
    """Posts with `day`, the day on which they were written; posts without a time share a day of their own."""
    return posts.withColumn("day", F.coalesce(F.to_date(epoch_to_ts("created_utc")), F.lit(NO_TIME).cast("date")))


def known_keys(index: DataFrame, batch: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows of the index whose day and key occur in the batch. What is left of both sides is shuffled."""
    wanted = batch.where(F.col(names[-1]) != "").select("day", *names)
    return index.join(wanted.hint("merge"), ["day", *names], "left_semi").select("day", *names)


def store_unseen(spark: SparkSession, posts: DataFrame, path: str, index_path: str, keys: Sequence[str] = POST_KEY) -> None:
    """Append the posts that no run has stored yet, each once, and their keys to the index.

    Posts without an id are dropped, and of copies inside the batch the first seen counts. The posts are written before
    their keys: a run that fails between the two leaves posts that the next run takes for new, never keys without posts.
    """
    names = list(named_keys(keys))
    batch = settle_as_table(indexed_day(first_seen(posts, keys)).withColumns(named_keys(keys)))
    index = read_table_or_none(spark, index_path, schema=batch.select(*names, "day").schema)
    if index is not None:
        with with_conf(spark, BLOOM_CONF):
            known = settle_as_table(known_keys(index, batch, names))
        batch = settle_as_table(batch.join(known, ["day", *names], "left_anti"))
    batch.select(*posts.columns).write.mode("append").parquet(path)
    batch.select(*names, "day").hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(index_path)
