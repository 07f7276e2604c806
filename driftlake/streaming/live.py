"""Streaming variants of segmentation and hour bucketing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def live_segments(rows: DataFrame, by: list[str], at: str, max_gap: str = "120 seconds 1 microsecond", late: str = "10 minutes", min_size: int = 5) -> DataFrame:
    """Session windows of a stream: runs without a step of more than two minutes, of at least ``min_size`` rows."""
    marked = rows.withWatermark(at, late)
    window = F.session_window(at, max_gap)
    runs = marked.groupBy(*by, window.alias("w")).agg(F.count("*").alias("size"), F.min(at).alias("start_time"), F.max(at).alias("end_time"))
    return runs.where(F.col("size") >= min_size).drop("w")


def live_hours(rows: DataFrame, by: list[str], at: str, late: str = "10 minutes") -> DataFrame:
    """Rows and mean confidence of each hour of a stream."""
    marked = rows.withWatermark(at, late)
    hours = marked.groupBy(*by, F.window(at, "1 hour").alias("w")).agg(F.count("*").alias("lines"), F.avg("confidence").alias("mean_confidence"))
    return hours.select(*by, F.col("w.start").alias("hour"), "lines", "mean_confidence")
