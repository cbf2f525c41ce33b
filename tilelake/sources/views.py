"""Detections laid over the event table, for tables that hold no images, and plain table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

CLASSES = {"error": "excl", "signup": "lp", "purchase": "mild", "click": "moderate"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detections(events: DataFrame, tight: bool = False) -> DataFrame:
    """One box per event, eight neighbours to a group; tight boxes overlap enough for high thresholds."""
    g, k, e = F.floor(F.col("event_id") / 8.0).cast("bigint"), F.col("event_id") % 8, F.col("event_id")
    dx, dy = (k * 2, k) if tight else (k * 9, k * 5)
    w, h = (60 + e * 31 % 20, 60 + e * 17 % 20) if tight else (8 + e * 31 % 180, 8 + e * 17 % 180)
    x, y = g * 7919 % 15872 + dx, g * 10007 % 15872 + dy
    name = F.lit("background")
    for kind, value in CLASSES.items():
        name = F.when(F.col("event_type") == kind, value).otherwise(name)
    return events.select(
        e.alias("det_id"), (g % 20).alias("slide_id"), name.alias("class_name"), x.cast("double").alias("x1"), y.cast("double").alias("y1"), (x + w).cast("double").alias("x2"), (y + h).cast("double").alias("y2"), (F.lit(0.3) + F.col("value") / 1000).alias("conf")
    )
