"""Views that present the given test tables in the layouts of the feeds. Only checks and benchmarks use them."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketpulse.session import ensure_checkpoint_dir
from marketpulse.sources.tables import read_table
from marketpulse.sources.topics import encode_json

# The test prose holds no real ticker, so frequent words stand in for symbols; some of them never occur.
WATCHLIST = "THE AND THAT WAS FOR WITH THIS ARE FROM THAN THEN THEM SHE HER HIS THEY HAD NOT BUT YOU".split()
LEXICON_ROWS = [
    ("thble", 19), ("thtion", -15), ("thing", 22), ("than", -21), ("eron", 31), ("thes", -12), ("thea", 14),
    ("thor", -27), ("est", 9), ("ther", -8),
]
NOW = "2024-01-31 00:00:00"
DAY_SECONDS = 86_400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors reach."""
    return f"{ensure_checkpoint_dir(spark)}/run-{uuid4().hex}"


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def lexicon(spark: SparkSession) -> DataFrame:
    """An inline SQL table: its size is known without a job, and no Python worker has to start to read it."""
    rows = ", ".join(f"('{term}', {val10})" for term, val10 in LEXICON_ROWS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS lexicon(term, val10)")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def price_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbols = F.array(*[F.lit(symbol) for symbol in WATCHLIST])
    return events(spark, sf_dir).select(
        F.element_at(symbols, (F.col("user_id") % len(WATCHLIST) + 1).cast("int")).alias("symbol"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("price"),
        F.col("event_type").alias("source"),
        F.col("ts").alias("ingest_ts"),
    )


def price_ticks_tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times cut to the hour, so many ticks share the last one."""
    return price_ticks(spark, sf_dir).withColumn("ingest_ts", F.date_trunc("hour", "ingest_ts"))


def price_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as the producer sends them: the time is ISO text."""
    text = F.date_format("ingest_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return price_ticks(spark, sf_dir).withColumn("ingest_ts", text)


def price_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_json(price_events(spark, sf_dir))


def social_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    seconds = (doc * doc % 30) * DAY_SECONDS + doc * 7919 % DAY_SECONDS
    ident = F.concat(F.lit("d"), doc.cast("string"))
    return table(spark, sf_dir, "documents").select(
        F.lit("reddit").alias("source"),
        F.col("source").alias("subreddit"),
        ident.alias("id"),
        (F.lit(1704067200.0) + seconds).alias("created_utc"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        "text",
        F.col("n_chars").cast("int").alias("score"),
        (doc % 100).cast("int").alias("num_comments"),
        F.concat(F.lit("/r/"), "source", F.lit("/"), ident).alias("permalink"),
    )


def reposted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All posts, polled three times: twice at the instant they were written, and once an hour later."""
    posts = social_posts(spark, sf_dir)
    seen = posts.withColumn("ingest_ts", F.timestamp_seconds("created_utc"))
    again = F.timestamp_seconds(F.col("created_utc") + 3600)
    return seen.unionByName(seen).unionByName(posts.withColumn("ingest_ts", again))


def reposted_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All posts, polled twice at the instant they were written."""
    seen = social_posts(spark, sf_dir).withColumn("ingest_ts", F.timestamp_seconds("created_utc"))
    return seen.unionByName(seen)


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts as pages of a forum listing. A page holds one run of 100 doc_ids of a forum, so never more than 100 posts.

    Posts in Spanish have lost their id, and those in French their title.
    """
    docs = table(spark, sf_dir, "documents")
    child = F.struct(
        F.struct(
            F.when(F.col("lang") != "es", F.concat(F.lit("d"), F.col("doc_id").cast("string"))).alias("id"),
            (F.lit(1704067200.0) + F.col("doc_id") * 61).alias("created_utc"),
            F.when(F.col("lang") != "fr", F.split_part("text", F.lit("\n"), F.lit(1))).alias("title"),
            F.col("text").alias("selftext"),
            F.col("n_chars").alias("score"),
            (F.col("doc_id") % 100).alias("num_comments"),
            F.concat(F.lit("/r/d"), F.col("doc_id").cast("string")).alias("permalink"),
        ).alias("data")
    )
    pages = docs.groupBy("source", F.expr("doc_id div 100").alias("page")).agg(F.collect_list(child).alias("children"))
    value = F.to_json(F.struct(F.struct("children").alias("data")))
    return pages.select(F.col("source").alias("subreddit"), value.alias("value"))


def microblog(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return table(spark, sf_dir, "conversations").select(
        uri.alias("uri"),
        F.md5(uri).alias("cid"),
        F.concat(F.lit("did:"), "role").alias("author_did"),
        F.col("role").alias("author_handle"),
        F.concat(F.lit("$"), F.upper("text")).alias("text"),
        F.date_format(F.timestamp_seconds(F.lit(1705312800) + F.col("conv_id") * 60), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.col("turn").alias("likeCount"),
        F.lit(0).cast("bigint").alias("repostCount"),
        (F.col("turn") + 1).alias("replyCount"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as topic messages; offsets have gaps, as in a compacted topic."""
    return events(spark, sf_dir).select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), "ts",
    )


def progress_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(topic, partition, end_offset) as a query's progress gives it. Offsets are event ids, so each ends after its last."""
    last = messages(spark, sf_dir).groupBy("topic", "partition").agg(F.max("offset").alias("last"))
    return last.select("topic", "partition", (F.col("last") + 1).alias("end_offset"))


def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A counter per (topic, partition) that keeps being reset."""
    return messages(spark, sf_dir).select("topic", "partition", "ts", (F.col("offset") % 50).cast("double").alias("value"))


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes in which every field is missing or zero now and then."""
    i, value = F.col("event_id"), F.col("value")
    history = F.array(
        F.struct((F.col("ts") - F.expr("INTERVAL 1 MINUTE")).alias("ts"), value.alias("close")),
        F.struct(F.col("ts").alias("ts"), (value + 3).alias("close")),
    )
    return events(spark, sf_dir).select(
        "event_id",
        F.when(i % 4 != 0, F.when(i % 7 == 0, 0.0).otherwise(value)).alias("last_price"),
        F.when(i % 5 != 0, F.when(i % 7 == 0, 0.0).otherwise(value + 1)).alias("lastPrice"),
        F.when(i % 3 == 0, value + 2).alias("regularMarketPrice"),
        F.when(i % 13 == 0, 0.0).alias("currentPrice"),
        F.when(i % 11 == 0, history).alias("history"),
    )
