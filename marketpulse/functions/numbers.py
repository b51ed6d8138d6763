"""Numeric and coding columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Signal codes and up/down labels.
SIGNAL_CODES = {"SELL": -1, "HOLD": 0, "BUY": 1}
UP_LABELS = {0: "DOWN", 1: "UP"}

# Threshold steps (label below the first step, then label from each step on), in seconds or rows.
DATASET_AGE_STEPS = ("green", [(300, "yellow"), (900, "red")])
FRESHNESS_STEPS = ("green", [(900, "yellow"), (1800, "red")])
ACTIVITY_STEPS = ("red", [(1, "green")])

# Fixed value: where a quote response keeps its price.
QUOTE_PATH = "$['Global Quote']['05. price']"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def first_price(
    fast: Column | str, fast_alt: Column | str, info: Column | str, info_alt: Column | str, last_close: Column | str
) -> Column:
    """The first usable price of a quote: two pairs of alternative fields, then the last close.

    Within a pair a zero in the first field counts as missing, a zero in the second is taken as the price.
    """
    return F.coalesce(
        F.nullif(_col(fast), F.lit(0.0)), _col(fast_alt), F.nullif(_col(info), F.lit(0.0)), _col(info_alt),
        _col(last_close),
    )


def last_close(history: Column | str) -> Column:
    """The close of the newest bar in an array<struct<ts, close>>; null for an empty or missing array."""
    return F.array_max(_col(history)).getField("close")


def quote_price(body: Column | str, path: str = QUOTE_PATH) -> Column:
    """The price in a JSON quote response as a double; missing or malformed gives null."""
    return F.get_json_object(_col(body), path).try_cast("double")


def mapped(value: Column | str, table: Mapping) -> Column:
    """Value mapping by a small fixed table; anything else gives null."""
    value, result = _col(value), None
    for key, code in table.items():
        test = value == F.lit(key)
        result = F.when(test, F.lit(code)) if result is None else result.when(test, F.lit(code))
    return result


def band(value: Column | str, steps: tuple[str, Sequence[tuple[float, str]]]) -> Column:
    """The label of the highest step that `value` reaches."""
    value, (label, ladder) = _col(value), steps
    result = None
    for bound, name in sorted(ladder, reverse=True):
        test = value >= F.lit(bound)
        result = F.when(test, F.lit(name)) if result is None else result.when(test, F.lit(name))
    return F.lit(label) if result is None else result.otherwise(F.lit(label))
