"""Event streams to bars: watermarked windows with open, high, low, close and count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_bars(events: DataFrame, at: str = "ts", value: str = "value", series: str = "event_type", size: str = "1 hour", late: str = "2 hours", tie: str = "event_id") -> DataFrame:
    """Works on a stream and on a table alike; on a stream, rows later than the watermark are dropped by Spark. Of events of
    the same time the first and the last by `tie` open and close a bar."""
    rows = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    place = F.struct(at, tie)
    bars = rows.groupBy(F.window(at, size).alias("w"), F.col(series).alias("series_id")).agg(
        F.min_by(value, place).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"),
        F.max_by(value, place).alias("close"), F.count("*").alias("volume"),
    )
    return bars.select("series_id", F.col("w.start").alias("start"), "open", "high", "low", "close", "volume")
