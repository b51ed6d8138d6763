"""Parquet tables: scan, tolerant scan, overwrite."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

# Error conditions that mean "nothing has been written there yet".
_NO_DATA_YET = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, kind: str = "parquet", **options: str
) -> DataFrame:
    """Scan of a table. Give the schema where it is known: no footer has to be read to infer it."""
    reader = spark.read.format(kind).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_table_or_none(spark: SparkSession, path: str, **kwargs) -> DataFrame | None:
    """Like `read_table`, but None where no data has been written yet. Any other error is raised."""
    try:
        return read_table(spark, path, **kwargs)
    except AnalysisException as error:
        if error.getCondition() in _NO_DATA_YET:
            return None
        raise


def _folder_files(spark: SparkSession, path: str) -> dict[str, frozenset[str]]:
    """Partition folder name -> names of its files, for the folders right below `path`; empty where there is none."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return {}
    return {
        folder.getPath().getName(): frozenset(file.getPath().getName() for file in fs.listStatus(folder.getPath()))
        for folder in fs.listStatus(root)
        if folder.isDirectory() and "=" in folder.getPath().getName()
    }


def _drop_folder(spark: SparkSession, path: str, name: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path, name)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), since: str | None = None) -> None:
    """Replace a Parquet table whole, or, with `since`, only its folders from that value of the partition column on.

    A limited run also drops the folders in its range that the new result has no row for; the folder of nulls is always
    in range. They go after the new ones are written, so a run that fails in between leaves the old rows.

    Partitioned output is first gathered by its folders, so each day gets few large files; AQE splits a day that is too
    large for one.
    """
    if not partition_by:
        if since is not None:
            raise ValueError("`since` needs a partition column")
        df.write.mode("overwrite").parquet(path)
        return
    spark = df.sparkSession
    before = _folder_files(spark, path) if since is not None else {}
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if since is None else "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    after = _folder_files(spark, path) if since is not None else {}
    for name, files in before.items():
        value = name.split("=", 1)[1]
        if after.get(name) == files and (value >= since or value == "__HIVE_DEFAULT_PARTITION__"):
            _drop_folder(spark, path, name)


def write_bucketed(df: DataFrame, path: str, by: Sequence[str], order: Sequence[str], buckets: int) -> str:
    """Store a table in buckets of `by`, each sorted by `by` and `order`, and give the name it is known under.

    Rows are dealt out by the same hash as the buckets, so every bucket is one file.
    """
    name = f"bucketed_{uuid4().hex}"
    writer = df.repartition(buckets, *by).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *by).sortBy(*by, *order).saveAsTable(name)
    return name


# Joins may use a partitioning by some of their keys, and no side is broadcast where buckets meet anyway.
BUCKET_CONF = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.sources.bucketing.enabled": "true",
}


def bucket_session(spark: SparkSession) -> SparkSession:
    """A session of its own over the same cluster and tables, in which joins and windows on bucketed tables do not shuffle."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    for key, value in BUCKET_CONF.items():
        session.conf.set(key, value)
    return session
