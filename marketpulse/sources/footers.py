"""What can be told of Parquet tables without reading their rows: from file footers and from file metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketpulse.operators.health import age_seconds
from marketpulse.sources.tables import read_table_or_none

# Aggregates reach the footers through the second generation of file sources only.
FOOTER_CONF = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of its own over the same cluster, in which plain counts, minima and maxima are answered from footers."""
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(key, spark.conf.get(key))
    for key, value in FOOTER_CONF.items():
        session.conf.set(key, value)
    return session


def footer_stats(spark: SparkSession, path: str, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, rows, min_c and max_c for each column): by partition columns, or one row for the whole table.

    Footers hold exact bounds of whole numbers, floats, booleans and dates; other columns would be read. A table that
    is not there yet gives no group, or one row of zero and nulls.
    """
    session = footer_session(spark)
    found = [F.count(F.lit(1)).alias("rows")]
    table = read_table_or_none(session, path)
    if table is None:
        if by:
            raise ValueError(f"{path} is not there yet, so its partition columns are not known")
        nothing = [F.lit(None).cast("bigint").alias(f"{bound}_{c}") for c in columns for bound in ("min", "max")]
        return session.range(1).select(F.lit(0).cast("bigint").alias("rows"), *nothing)
    for column in columns:
        found += [F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}")]
    return (table.groupBy(*by) if by else table).agg(*found)


def footer_rows(spark: SparkSession, datasets: Mapping[str, str]) -> DataFrame:
    """(dataset, rows) like `dataset_rows`, from the footers; 0 for a dataset that is not there yet."""
    session = footer_session(spark)
    counts = []
    for name, path in datasets.items():
        table = read_table_or_none(session, path)
        counted = session.range(1).select(F.lit(0).cast("bigint").alias("rows")) if table is None else table.agg(F.count(F.lit(1)).alias("rows"))
        counts.append(counted.select(F.lit(name).alias("dataset"), "rows"))
    return reduce(DataFrame.unionByName, counts)


def file_report(spark: SparkSession, path: str, now: Column) -> DataFrame:
    """(folder, file, bytes, rows, seconds_since_update) for each file of a Parquet table that holds rows.

    Spark's hidden metadata column names the file of every row, so no listing is needed beside the scan's own, and no
    column of the table is read. `folder` is the partition folder that the file lies in, empty right below the table.
    """
    file = F.col("_metadata")
    rows = spark.read.parquet(path).select(
        file["file_path"].alias("place"), file["file_name"].alias("file"), file["file_size"].alias("bytes"),
        file["file_modification_time"].alias("modified"),
    )
    counted = rows.groupBy("place", "file", "bytes", "modified").agg(F.count(F.lit(1)).alias("rows"))
    folder = F.element_at(F.split("place", "/"), -2)
    return counted.select(
        F.when(folder.contains("="), folder).otherwise("").alias("folder"), "file", "bytes", "rows", age_seconds("modified", now).alias("seconds_since_update")
    )


def newest_file(spark: SparkSession, path: str) -> DataFrame:
    """(modified): when the newest file of a table was written."""
    return spark.read.parquet(path).agg(F.max("_metadata.file_modification_time").alias("modified"))
