"""The runs of the engine as compositions: one plan from tiles to polygons, and the region workflow."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import rings
from ..operators import filters, inference, merge, regions, report, tiling
from ..operators.graph import stored
from ..schemas import BOX


def standard(tiles: DataFrame, models: DataFrame, load: inference.Detector, tissue: str = "spread", most_tiles: int | None = None, measured: report.Measured | None = None) -> DataFrame:
    """Tissue filter, detection by every model, size and cell filters, union by class; measured gets the times of the stages."""
    run = measured or report.Measured()
    kept = tiling.with_tissue(tiles, tissue)
    kept = tiling.numbered(kept.drop("patch_id")) if most_tiles is None else tiling.first_tiles(kept.drop("patch_id"), most_tiles)
    raw = run.stored(inference.detected(run.seen(kept), models, load), "inference")
    found = run.stored(filters.cells_beyond(inference.decided(raw, models).select(*merge.COLUMNS)), "filter")
    return run.stored(merge.united(found), "merge")


def improved(tiles: DataFrame, models: DataFrame, load: inference.Detector, classes: tuple[str, ...] = ("lp",), measured: report.Measured | None = None) -> DataFrame:
    """Saturation filter, fixed confidence and overlap of 0.7, area band, improved merging, adaptive simplification; measured
    gets the times of the stages."""
    run = measured or report.Measured()
    kept = tiling.numbered(tiling.with_tissue(tiles, "saturation").drop("patch_id"))
    raw = run.stored(inference.detected(run.seen(kept), models, load), "inference")
    found = run.stored(inference.decided(raw, models, iou=0.7, conf=0.7, band=True).select(*merge.COLUMNS), "filter")
    out = run.stored(merge.merged(found, improved=True, classes=classes), "merge")
    simple = out.withColumn("_s", merge.adaptively_simplified("polygon"))
    metrics = F.when(F.coalesce(F.size("polygon"), F.lit(0)) > 3, F.struct(*[f"_s.{c}" for c in ("original_points", "simplified_points", "area_preserved", "perimeter_preserved", "complexity", "method", "tolerance_used", "iterations")]))
    return run.stored(simple.withColumn("simplification_metrics", metrics).withColumn("polygon", F.coalesce("_s.polygon", "polygon")).drop("_s"), "simplify")


def region_workflow(thumbnails: DataFrame, slides: DataFrame, k: int = 6, least: int = 1000) -> DataFrame:
    """Components of thumbnails, clustered, bounded, scaled to the slide and numbered from the origin."""
    parts = stored(regions.tissue_components(thumbnails, least), "components")
    found = regions.scaled(regions.bounds(regions.clustered(parts, k)), slides)
    return regions.renumbered(found.withColumn("region_ord", F.col("cluster")))


def minimum(detections: DataFrame) -> DataFrame:
    """Size filter, cell filter, statistics by slide and class."""
    return report.class_statistics(filters.cells_beyond(detections.where(filters.large_enough())))


def rewritten(detections: DataFrame, most: int = 60) -> DataFrame:
    """Stored detections again: invalid polygons go, the others are simplified and their boxes follow them."""
    kept = detections.where(merge.is_valid("polygon")).withColumn("polygon", merge.smart_simplified("polygon", most))
    return kept.withColumns(dict(zip(BOX, rings.bounds(F.col("polygon")))))


def annotations(detections: DataFrame, n: int | None = None, within: float | None = None) -> DataFrame:
    """What is drawn on each tile: detections of the n fullest cells (all, if none), relative to the cell, with colours."""
    cells = report.cells_ranked(detections, n, within=within).withColumnRenamed("n", "n_in_cell").drop("first_det_id")
    return report.coloured(report.tile_relative(detections.where(filters.not_class()))).join(cells, ["slide_id", "i", "j"])
