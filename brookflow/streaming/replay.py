"""Windowed aggregation of a measurement stream. The batch engine has no streams; this is an addition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed(events: DataFrame, window: str = "1 day", late: str = "2 hours") -> DataFrame:
    """(window, event_type, n, total) of events(ts, event_type, value), tumbling windows with a watermark; for batches and streams alike."""
    grouped = events.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type")
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
