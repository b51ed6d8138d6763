"""Time columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the first timestamp pattern that the price feed is read with.
FEED_TS_PATTERN = "yyyy-MM-dd'T'HH:mm:ssX"

# Largest epoch second whose microseconds still fit a bigint; anything beyond is a broken value.
_MAX_EPOCH_SECOND = 9_000_000_000_000


def parse_ingest_ts(text: Column | str, now: Column | None = None) -> Column:
    """Feed timestamp text to a timestamp; text that cannot be read becomes `now`.

    The ISO reading goes first: it takes what producers send (fractions, `+00:00`, `Z`). The pattern, which raises
    and catches an error for each text it refuses, is only tried on what is left.
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(
        F.try_to_timestamp(text),
        F.try_to_timestamp(text, F.lit(FEED_TS_PATTERN)),
        F.current_timestamp() if now is None else now,
    )


def epoch_to_ts(seconds: Column | str) -> Column:
    """Epoch seconds to a timestamp, the fraction dropped; NaN and out-of-range values give null, not an error."""
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    in_range = F.abs(seconds) <= F.lit(float(_MAX_EPOCH_SECOND))
    return F.timestamp_seconds(F.when(in_range, seconds).try_cast("bigint"))


def day_of(moment: Column | str) -> Column:
    """The UTC day of a timestamp."""
    return F.to_date(moment)
