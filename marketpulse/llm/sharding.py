"""Two-pass external shuffle of records into shards.

Pass one scatters the records uniformly into buckets of a size that fits a task's memory, by a seeded hash of the
record. Pass two shuffles each bucket with Fisher and Yates' algorithm (NumPy's permutation) and writes it. One bucket
after another, the records then stand in a random order, and shards take equal runs of that order: the law `rows`.

A bucket's records are put into one order before they are shuffled, and the generator is seeded by the bucket, so a task
that runs again after an executor is lost gives the same result.

Records with equal ids or equal texts are spread like any others, as the hash covers all columns. Records equal in every
column share a bucket, unless their copies alone would fill it: then each copy is spread by its number. Null ids and texts count as values. An empty table gives no row. Of more shards than records some
stay empty. Columns of the input that are called shard or slot give way to the new ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from marketpulse.llm.common import utf8_bytes

BUCKET_BYTES = 32 << 20
SEED = 20_240_601
# Copies of a repeated record that a task writes out at a time.
COPIES_PER_RUN = 1000


def record_size(text: Column | str) -> Column:
    return utf8_bytes(text) + F.lit(8)


def scattered(docs: DataFrame, n_buckets: int, seed: int) -> Column:
    """The bucket of a record; xxhash64 covers every column, so neither a hot id nor a hot text fills a bucket."""
    return F.pmod(F.xxhash64(F.lit(seed), *docs.columns), F.lit(n_buckets)).cast("int")


def bucket_sizes(placed: DataFrame, bucket_name: str, text: str) -> dict[int, tuple[int, int]]:
    """Rows and bytes of each bucket."""
    sizes = placed.groupBy(F.col(bucket_name).alias("_at")).agg(F.count("*").alias("n"), F.sum(record_size(text)).alias("size"))
    return {row["_at"]: (row["n"], row["size"]) for row in sizes.toLocalIterator()}


def repeated_records(docs: DataFrame, text: str, bucket_bytes: int, seed: int) -> list[int]:
    """Hashes of records whose copies hold more than a bucket's bytes: fewer than there are buckets."""
    sizes = docs.groupBy(F.xxhash64(F.lit(seed), *docs.columns).alias("_h")).agg(
        F.count("*").alias("n"), F.sum(record_size(text)).alias("size")
    )
    return [row["_h"] for row in sizes.where((F.col("size") > bucket_bytes) & (F.col("n") > 1)).select("_h").collect()]


def spread_copies(docs: DataFrame, bucket_name: str, n_buckets: int, seed: int) -> DataFrame:
    """Every copy of `docs` with a bucket by its number. Copies are counted, dealt out in runs, and written out again."""
    counted = docs.groupBy(F.struct(*[docs[c] for c in docs.columns]).alias("_row")).agg(F.count("*").alias("_n"))
    runs = counted.select("_row", "_n", F.explode(F.sequence(F.lit(0), F.col("_n") - 1, F.lit(COPIES_PER_RUN))).alias("_from"))
    # The runs of one record go to many tasks before they become copies.
    dealt = runs.repartition(F.xxhash64("_row", "_from"))
    last = F.least(F.col("_from") + COPIES_PER_RUN, F.col("_n")) - 1
    copies = dealt.select("_row", F.explode(F.sequence("_from", last)).alias("_copy"))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "_row", "_copy"), F.lit(n_buckets)).cast("int")
    return copies.select("_row.*", bucket.alias(bucket_name))


def shuffle_shards(
    docs: DataFrame, n_shards: int, text: str = "text", bucket_bytes: int = BUCKET_BYTES, seed: int = SEED
) -> DataFrame:
    """`docs` with shard (0 to n_shards - 1) and slot (from 0 on, without gaps) after a uniform shuffle of all rows.

    The bytes are summed first, for the number of buckets, and the rows of each bucket are counted, which gives where it
    begins in the whole order: a number for each bucket, not for each record. Both passes read columns only.
    """
    import numpy as np
    import pyarrow as pa

    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    bucket_name = "_bucket"
    while bucket_name in docs.columns:
        bucket_name += "_"
    total = docs.agg(F.sum(record_size(text)).alias("bytes"), F.count("*").alias("rows")).first()
    n_buckets = max(1, -(-(total["bytes"] or 0) // bucket_bytes))
    placed = docs.withColumn(bucket_name, scattered(docs, n_buckets, seed))
    held = bucket_sizes(placed, bucket_name, text)
    over = [bucket for bucket, (_, size) in held.items() if size > 2 * bucket_bytes]
    repeated = repeated_records(placed.where(F.col(bucket_name).isin(over)).drop(bucket_name), text, bucket_bytes, seed) if over else []
    if repeated:
        is_repeated = F.xxhash64(F.lit(seed), *docs.columns).isin(repeated)
        placed = placed.where(~is_repeated).unionByName(spread_copies(docs.where(is_repeated), bucket_name, n_buckets, seed))
        held = bucket_sizes(placed, bucket_name, text)
    counts = {bucket: n for bucket, (n, _) in held.items()}
    starts, at = [], 0
    for bucket in range(n_buckets):
        starts.append(at)
        at += counts.get(bucket, 0)
    each, more = divmod(at, n_shards)
    begins = spark.sparkContext.broadcast(np.array(starts, dtype=np.int64))
    columns = docs.columns
    by = [(name, "ascending") for name, kind in docs.dtypes if kind in ("bigint", "int", "string", "double", "date", "timestamp")]
    schema = StructType([*docs.schema.fields, StructField("shard", IntegerType()), StructField("slot", LongType())])

    def fisher_yates(key: tuple, records: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        records = records.select(columns).sort_by(by) if by else records.select(columns)
        order = np.random.default_rng([seed, bucket]).permutation(len(records))
        rank = begins.value[bucket] + np.arange(len(records), dtype=np.int64)
        # The first `more` shards hold one row more than the others.
        long_run = more * (each + 1)
        shard = np.where(rank < long_run, rank // (each + 1), more + (rank - long_run) // max(each, 1))
        first = shard * each + np.minimum(shard, more)
        taken = records.take(pa.array(order))
        return taken.append_column("shard", pa.array(shard.astype(np.int32))).append_column("slot", pa.array(rank - first))

    return placed.groupBy(bucket_name).applyInArrow(fisher_yates, schema)


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Shuffled records as Parquet, one folder for each shard; in a file rows stand in the order of their slots."""
    shuffled.repartition("shard", F.floor(F.col("slot") / 1_000_000)).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).mode("overwrite").parquet(path)
