"""Size checks that come before a broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, functions as F

from marketpulse.session import ensure_checkpoint_dir

# Rows of a few dozen bytes; a million of them stay far below what one executor can hold.
BROADCAST_ROWS = 1_000_000


def settle(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and read on from there: computed once, lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settle_as_table(df: DataFrame) -> DataFrame:
    """Like `settle`, but as Parquet files: the planner knows their size and can filter and prune what it reads of them."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/settled-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_when_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it has been counted to be small, else unchanged for a shuffled join.

    Counts at most `max_rows + 1` rows. Give it a table or a settled result, so that counting is cheap.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def repeated_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count: empty for a table that honours its key."""
    return table.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def at_newest(rows: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The rows that stand at the newest `ts` of their keys, all of them; null keys are a group, a null `ts` is none.

    The newest times are found by a hash aggregate, so no row is sorted; they are written once and broadcast when
    counted small, and the rows are filtered in place. Beyond the bound the join shuffles, and AQE splits what is skewed.
    """
    peaks = settle(rows.groupBy(*keys).agg(F.max(ts).alias(ts)))
    named = broadcast_when_small(peaks.select(*[F.col(name).alias(f"_peak_{name}") for name in (*keys, ts)]))
    same = F.col(ts) == F.col(f"_peak_{ts}")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_peak_{key}"))
    return rows.join(named, same, "left_semi")
