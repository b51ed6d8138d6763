"""marketpulse: price ticks and social posts turned into daily trading signals, as Spark DataFrame jobs."""
