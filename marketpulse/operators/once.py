"""Keeping Spark from computing a costly column several times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a costly column that later filters and projections read instead of computing it again.

    The optimizer moves a filter on a plain computed column below the projection, with a copy of the whole expression,
    and copies it once more for every field taken out of it. Neither passes an explode, here of one element per row.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))
