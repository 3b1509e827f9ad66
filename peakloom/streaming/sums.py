"""Incremental group sums: the additive statistics, kept up by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_sums(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Per day and event type, count and sum of values; works on a batch frame and, with a watermark, on a stream."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        e = e.withWatermark("ts", late)
    g = e.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return g.select(F.col("w.start").alias("day"), "event_type", "n", "total")
