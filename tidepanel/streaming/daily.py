"""Daily demand from an event stream, with late events up to a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_rollup(events: DataFrame, ts: str, series: str, value: str, late: str = "2 days") -> DataFrame:
    """Works on streams and tables alike; on a stream, a day is final once the watermark has passed it."""
    rows = events.withColumn("event_time", F.col(ts).cast("timestamp"))
    rows = rows.withWatermark("event_time", late) if events.isStreaming else rows
    return rows.groupBy(F.window("event_time", "1 day").alias("day"), F.col(series).cast("string").alias("series_id")).agg(F.sum(value).alias("y"), F.count(F.lit(1)).alias("n")).select("series_id", F.to_date("day.start").alias("ts"), "y", "n")
