"""Small helpers that the operators share."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from marketpulse.session import ensure_checkpoint_dir

# Fixed values of the contracts: what separates words, and A-Z to a-z without touching other letters.
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_schema(df: DataFrame, key: str, rest: str) -> StructType:
    """The key's column as it is, and the columns that `rest` declares; the key may be a struct of any columns."""
    return StructType([StructField(key, df.schema[key].dataType), *StructType.fromDDL(rest).fields])


def settle(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet to the shared checkpoint folder and read on from there: computed once, lineage cut.

    Unlike the files of `checkpoint()`, these are compressed, readers skip columns, and the planner knows their size.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column | str) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column | str) -> Column:
    """Words between blanks, an empty array for null; the split leaves an empty first or last piece, which goes."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def bind(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, however often the body names it.

    The fold over no elements only hands its start value to its last step. Taking the one element of a transformed array
    would do the same, but Spark then works out the type of the whole body for every row.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda bound, _: bound, body)


def utf8_bytes(text: Column | str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def held_out(doc_id: Column | str) -> Column:
    """Rows whose labels nobody learns from: crc32 of the id as text leaves 1 when divided by 3."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame, label: Column, key: str = "doc_id") -> DataFrame:
    """(_id, label): the highest label of each id, without those that are held out or null."""
    return labels.where(~held_out(key)).select(F.col(key).alias("_id"), label.alias("label")).where("label IS NOT NULL").groupBy(
        "_id"
    ).agg(F.max("label").alias("label"))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: Column, rows: int, max_bytes: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(text, label): at most `rows` training documents of at most `max_bytes` together, in whole texts.

    Labels that are held out or null are left out, of several labels of one id the highest counts, and rows equal in id
    and text count once. Documents are taken by the hash of id and text, so the sample is the same in every run and does
    not depend on partitions. One that does not fit the rest of the bytes is passed over, and others take its place. If
    there are labelled documents and none fits, that is an error.
    """
    spark = docs.sparkSession
    ids = training_labels(labels, label, key)
    hashed = docs.select(F.col(key).alias("_id"), F.xxhash64(key, text).alias("_h"), F.coalesce(text, F.lit("")).alias("text"))
    # Ids, hashes and sizes are joined, not texts.
    sized = settle(hashed.select("_id", "_h", F.octet_length("text").alias("n")).distinct().join(ids, "_id").select("_h", "n", "label"))
    kept: list[tuple[int, int]] = []
    last, left = None, max_bytes
    while len(kept) < rows:
        # What is too large now never fits later, so each page may leave it out.
        page = sized.where((F.col("n") <= left) & (F.lit(True) if last is None else F.col("_h") > last))
        page = page.orderBy("_h").limit(rows - len(kept)).collect()
        if not page:
            break
        for row in page:
            last = row["_h"]
            if row["n"] <= left:
                kept.append((row["_h"], row["label"]))
                left -= row["n"]
    if not kept and rows and not sized.isEmpty():
        raise ValueError(f"none of the labelled documents fits {max_bytes} bytes")
    chosen = F.broadcast(spark.createDataFrame(kept, "_h bigint, label int"))
    return hashed.join(chosen, "_h").select("_id", "text", "label").distinct().select("text", "label")
