"""Event-time activity buckets on Structured Streaming (an extension; SURVEY §7.8).

Forward fill and the percentile need a whole title, so they run on completed buckets in batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bucket_means(events: DataFrame, interval: str = "1 day", late: str = "1 hour") -> DataFrame:
    """``events(ts, title_id, motion)`` to (title_id, start, mean, samples) by tumbling windows.

    Rows later than ``late`` behind the watermark are dropped by Spark; null motion isn't counted.
    """
    windows = events.withWatermark("ts", late).groupBy(F.window("ts", interval), "title_id")
    means = windows.agg(F.avg("motion").alias("mean"), F.count("motion").alias("samples"))
    return means.select("title_id", F.col("window.start").alias("start"), "mean", "samples")
