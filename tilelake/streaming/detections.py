"""Detections as they arrive: windowed class statistics with late data, over Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.filters import large_enough


def class_counts(detections: DataFrame, window: str = "1 hour", late: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Rows and mean confidence by window and class of large enough boxes; windows close ``late`` after their end."""
    rows = detections.withWatermark(ts, late).where(large_enough())
    return rows.groupBy(F.window(ts, window).alias("w"), "class_name").agg(F.count("*").alias("n"), F.avg("conf").alias("mean_conf")).select("w.start", "w.end", "class_name", "n", "mean_conf")
