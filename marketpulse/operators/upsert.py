"""Insert-or-update by key on DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F

from marketpulse.operators.sizing import BROADCAST_ROWS, settle


def upsert(
    target: DataFrame, delta: DataFrame, keys: Sequence[str], defaults: Mapping[str, Any] | None = None
) -> DataFrame:
    """`target` with the rows of `delta` put in by key. Keys are compared null-safe: a null is a key like any other.

    Columns that `delta` has replace those of a row with the same key; columns it lacks keep the row's value, and take
    their value from `defaults` (else null) in a new row. A key that `delta` holds twice is an error, as it would be in
    a keyed table, and so is a column that the target lacks.

    The delta is written out and counted once. If it has few rows, its keys, and only they, are broadcast, and then the
    target is not shuffled; rows that get new values, at most as many as the delta has, are joined by a shuffle.
    """
    keys, defaults = list(keys), dict(defaults or {})
    unknown = [column for column in delta.columns if column not in target.columns]
    if unknown:
        raise ValueError(f"the delta has columns that the target lacks: {unknown}")
    delta = settle(delta)
    counted = delta.groupBy(*keys).agg(F.count("*").alias("rows"))
    sizes = counted.agg(F.max("rows").alias("most"), F.count("*").alias("keys")).first()
    if (sizes["most"] or 0) > 1:
        twice = counted.where("rows > 1").first()
        raise ValueError(f"the delta holds a key more than once: {twice.asDict()}")
    named = delta.select(*[F.col(key).alias(f"_new_{key}") for key in keys])
    if sizes["keys"] <= BROADCAST_ROWS:
        named = F.broadcast(named)
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_new_{key}"))
    kept = target.join(named, same, "left_anti")
    missing = [column for column in target.columns if column not in delta.columns]
    if not missing:
        return kept.unionByName(delta.select(*target.columns))

    values = [column for column in delta.columns if column not in keys]
    old = settle(target.join(named, same, "left_semi").select(*keys, *missing))
    news = delta.select(*[F.col(key).alias(f"_new_{key}") for key in keys], *[F.col(c).alias(f"_value_{c}") for c in values])
    kinds = {field.name: field.dataType for field in target.schema.fields}
    changed = old.join(news, same).select(*keys, *missing, *[F.col(f"_value_{c}").cast(kinds[c]).alias(c) for c in values])
    known = old.select(*[F.col(key).alias(f"_new_{key}") for key in keys])
    added = delta.join(known, same, "left_anti").select(
        *[
            F.lit(defaults.get(column)).cast(kinds[column]).alias(column) if column in missing
            else F.col(column).cast(kinds[column]).alias(column)
            for column in target.columns
        ]
    )
    return kept.unionByName(changed.select(*target.columns)).unionByName(added)
