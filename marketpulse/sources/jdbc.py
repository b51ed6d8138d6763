"""Relational targets: staging write, publication in one transaction, reading back.

Needs a classic (not Connect) session, because the transaction runs through the driver's JVM.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

JOINED_COLUMNS = ("ticker", "day", "price_day_last", "avg_sentiment", "mentions")

# Fixed value: how the PostgreSQL target is locked while it is refilled.
POSTGRES_LOCK = "LOCK TABLE {target} IN EXCLUSIVE MODE"


def write_jdbc_staging(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], connections: int = 8
) -> None:
    """Replace the staging table. `connections` bounds how many executors write to the database at once."""
    writer = df.write.format("jdbc").options(**properties).option("numPartitions", str(connections))
    writer.option("url", url).option("dbtable", table).mode("overwrite").save()


def swap_statements(
    target: str, staging: str, columns: Sequence[str], lock: str | None = POSTGRES_LOCK, clear: str = "TRUNCATE TABLE"
) -> list[str]:
    """The publishing transaction: under the lock, rows leave and come, while table, views and grants stay."""
    names = ", ".join(columns)
    statements = [lock.format(target=target)] if lock else []
    return statements + [f"{clear} {target}", f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging}"]


def merge_statements(target: str, staging: str, columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    """Insert from staging, or update the other columns where the key is there already (PostgreSQL)."""
    names, key = ", ".join(columns), ", ".join(keys)
    updates = ", ".join(f"{column} = EXCLUDED.{column}" for column in columns if column not in keys)
    insert = f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging}"
    return [f"{insert} ON CONFLICT ({key}) DO UPDATE SET {updates}"]


def run_in_transaction(connection, statements: Sequence[str]) -> None:
    """Run the statements on a java.sql.Connection: all of them or none. Closes it."""
    try:
        connection.setAutoCommit(False)
        try:
            statement = connection.createStatement()
            try:
                for sql in statements:
                    statement.execute(sql)
            finally:
                statement.close()
            connection.commit()
        except Exception:
            connection.rollback()
            raise
    finally:
        connection.close()


def open_connection(spark: SparkSession, url: str, properties: Mapping[str, str]):
    jvm = spark._jvm
    login = jvm.java.util.Properties()
    for key, value in properties.items():
        if key != "driver":
            login.setProperty(key, value)
    return jvm.java.sql.DriverManager.getConnection(url, login)


def publishable(df: DataFrame, columns: Sequence[str] = JOINED_COLUMNS) -> DataFrame:
    """The target's columns in its order, with `day` as a date; rows without a full key stay out."""
    return df.withColumn("day", F.to_date("day")).dropna(subset=["ticker", "day"]).select(*columns)


def publish_jdbc(
    df: DataFrame, url: str, target: str, properties: Mapping[str, str], columns: Sequence[str] = JOINED_COLUMNS,
    staging: str | None = None, lock: str | None = POSTGRES_LOCK, clear: str = "TRUNCATE TABLE", connections: int = 8,
    connect=open_connection, stage=write_jdbc_staging,
) -> None:
    """Write to a staging table from the executors, then swap it into `target` in one transaction."""
    staging = staging or f"{target}__staging"
    stage(publishable(df, columns), url, staging, properties, connections)
    statements = swap_statements(target, staging, columns, lock, clear)
    run_in_transaction(connect(df.sparkSession, url, properties), statements)


def merge_jdbc(
    df: DataFrame, url: str, target: str, properties: Mapping[str, str], columns: Sequence[str],
    keys: Sequence[str] = ("ticker", "day"), staging: str | None = None, connections: int = 8,
    connect=open_connection, stage=write_jdbc_staging,
) -> None:
    """Write to a staging table from the executors, then upsert it into `target` by key in one transaction.

    Columns of the target that are not named keep their values, or take the table's defaults in a new row.
    """
    staging = staging or f"{target}__staging"
    stage(publishable(df, columns), url, staging, properties, connections)
    run_in_transaction(connect(df.sparkSession, url, properties), merge_statements(target, staging, columns, keys))


def read_served(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str], day_bounds: tuple[str, str] | None = None,
    connections: int = 8,
) -> DataFrame:
    """The served table. Filters on it are run by the database; with `day_bounds` several tasks read a day range each."""
    reader = spark.read.format("jdbc").options(**properties).option("url", url).option("dbtable", table)
    reader = reader.option("pushDownPredicate", "true").option("pushDownLimit", "true")
    if day_bounds:
        reader = reader.options(
            partitionColumn="day", lowerBound=day_bounds[0], upperBound=day_bounds[1], numPartitions=str(connections)
        )
    return reader.load()
