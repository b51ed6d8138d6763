"""Keyed tables that streams keep up to date, batch by batch, exactly once.

A table is a folder with one folder for each batch, `batch=<id>`, and in it one for each day that the batch touched,
`day=<day>`, which holds that day's rows whole. A day's rows are those of the newest batch that has the day, so a batch
rewrites the days it touches and no other. The batch id stands beside the data in the folder's name, and the batch counts
once the writer has put its marker file there: a batch that is run again after a failure finds its id committed and
changes nothing, or finds no marker and writes the folder anew.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from marketpulse.operators.sizing import settle
from marketpulse.operators.upsert import upsert

MARKER = "_SUCCESS"
# The folder of rows without a day, as Parquet writers name it.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _file_system(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def committed_batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the batches that have been written whole, in order."""
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return []
    names = [folder.getPath().getName() for folder in fs.listStatus(root) if folder.isDirectory()]
    made = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(
        int(name.split("=", 1)[1]) for name in names if name.startswith("batch=") and fs.exists(made(f"{path}/{name}", MARKER))
    )


def newest_days(spark: SparkSession, path: str) -> dict[str, int]:
    """Name of a day's folder -> the newest committed batch that holds it. Lists folders and reads no file."""
    fs, _ = _file_system(spark, path)
    made = spark._jvm.org.apache.hadoop.fs.Path
    return {
        folder.getPath().getName().split("=", 1)[1]: batch
        for batch in committed_batches(spark, path)
        for folder in fs.listStatus(made(f"{path}/batch={batch}"))
        if folder.isDirectory() and folder.getPath().getName().startswith("day=")
    }


def read_days(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[str] | None = None) -> DataFrame:
    """The table as of its last committed batch, or its rows of some days; an empty table where there is none yet."""
    newest = newest_days(spark, path)
    folders = [f"{path}/batch={batch}/day={day}" for day, batch in sorted(newest.items()) if days is None or day in days]
    if not folders:
        return spark.createDataFrame([], schema)
    # The base path makes `day` a column again; `batch` goes.
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.fieldNames())


def commit_batch(rows: DataFrame, path: str, batch: int) -> None:
    """Write the whole days of a batch; a folder that a failed run left without its marker is replaced."""
    writer = rows.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("day").parquet(f"{path}/batch={batch}")


def days_of(rows: DataFrame) -> list[str]:
    """Names of the folders of the days in `rows`."""
    return [NO_DAY if row["day"] is None else str(row["day"]) for row in rows.select("day").distinct().collect()]


Merge = Callable[[DataFrame, DataFrame], DataFrame]


def merge_batch(rows: DataFrame, batch: int, path: str, schema: T.StructType, merge: Merge) -> bool:
    """Merge a batch into the table: `merge(old rows of its days, its rows)`. False if the batch has been there before."""
    spark = rows.sparkSession
    if batch in committed_batches(spark, path):
        return False
    rows = settle(rows)
    old = read_days(spark, path, schema, days_of(rows))
    commit_batch(merge(old, rows).select(*schema.fieldNames()), path, batch)
    return True


def start_merge(
    stream: DataFrame, path: str, checkpoint: str, schema: T.StructType, merge: Merge, trigger: dict | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """A stream that merges each of its batches into the table at `path`; `prepare` reduces a batch first."""
    def put(rows: DataFrame, batch: int) -> None:
        merge_batch(prepare(rows) if prepare else rows, batch, path, schema, merge)

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def start_upsert(
    stream: DataFrame, path: str, checkpoint: str, schema: T.StructType, keys: Sequence[str], order: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """A stream of rows put in by key: the last row of a key by `order` counts; `keys` must name the day.

    Inside a batch a window keeps the last row of each key (pruned in the map tasks first), of several at one instant
    always the same one; between batches the later batch wins.
    """
    if "day" not in keys:
        raise ValueError("the table is kept by day, so the day must be one of the keys")
    columns = schema.fieldNames()

    def last_of_each_key(rows: DataFrame) -> DataFrame:
        newest = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(order), *[F.desc_nulls_last(c) for c in columns])
        return rows.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").select(*columns)

    return start_merge(stream, path, checkpoint, schema, lambda old, new: upsert(old, new, keys), trigger, last_of_each_key)
