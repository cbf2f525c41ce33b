"""Predicates on detections. All are column expressions, so Catalyst moves them to the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.boxes import cell

CELL = 512


def large_enough(least: float = 20) -> Column:
    """Width and height of at least ``least``, inclusive."""
    return (F.col("x2") - F.col("x1") >= least) & (F.col("y2") - F.col("y1") >= least)


def area_band(least: float = 100, most: float = 50_000) -> Column:
    return ((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).between(least, most)


def not_class(name: str = "excl") -> Column:
    return F.col("class_name") != name


def not_background(name: str = "background") -> Column:
    return F.lower("class_name") != name


def not_short(classes: tuple[str, ...] = ("lp",), least: int = 8) -> Column:
    """False for these classes' polygons of 1..least - 1 vertices; null and empty polygons pass."""
    return ~(F.col("class_name").isin(*classes) & F.coalesce(F.size("polygon"), F.lit(0)).between(1, least - 1))


def cells_beyond(detections: DataFrame, only: str = "excl", size: float = CELL) -> DataFrame:
    """Detections without those in cells that hold no class but ``only``; a mixed cell keeps all of its rows."""
    own = Window.partitionBy("slide_id", cell("x1", size), cell("y1", size))
    return detections.withColumn("_other", F.max(F.col("class_name") != only).over(own)).where("_other").drop("_other")


def in_window(most: float = 20_000, size: float = CELL) -> Column:
    """The origin of the detection's cell is under ``most`` on both axes."""
    return (cell("x1", size) * size < most) & (cell("y1", size) * size < most)


def of_models(tiles: DataFrame, models: DataFrame) -> DataFrame:
    """Tiles with the models of their window size; models are a small dimension, whose size Spark checks itself."""
    return tiles.join(models, F.col("size") == F.col("window_size"))


def confident(detections: DataFrame, models: DataFrame, model_col: str = "model_path") -> DataFrame:
    """Detections at or above the least confidence of their model."""
    return detections.join(models.select(model_col, "min_conf"), model_col).where("conf >= min_conf").drop("min_conf")


def top_by_confidence(detections: DataFrame, keys: list[str], n: int = 100) -> DataFrame:
    """The n most confident detections of each key, which is what a detector reports at most; ties by det_id."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("conf"), "det_id"))
    return detections.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
