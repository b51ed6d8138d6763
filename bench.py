"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run once to warm up and then timed over $BENCH_RUNS runs (default 3), the best of which counts; medians are
given beside. A run includes building the plan, any size check, and writing the whole result to Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketpulse.catalog import QUERIES  # noqa: E402
from marketpulse.session import build_session  # noqa: E402

HEADLINE = [
    "decode_prices", "decode_posts", "flatten_listing", "dedupe_posts", "extract_tickers", "extract_cashtags",
    "mentions_exploded", "post_sentiment", "last_price_daily", "last_price_ties", "social_daily", "joined_daily",
    "investment_signal", "joined_daily_signal", "signal_last_30", "upsert_prices", "offset_rate", "feed_health",
    "last_not_null", "upsert_mentions", "normalize_posts", "merge_feeds",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "marketpulse-bench",
        {
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, medians = {}, {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name], medians[name] = round(min(times[1:]), 3), round(median(times[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "medians": medians, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
