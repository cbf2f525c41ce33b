"""Regions of slides: numbering, look-up, statistics and detection from thumbnails."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .tiling import ELLIPSE, closed_opened, hue, saturation


def renumbered(regions: DataFrame, grid: bool = True) -> DataFrame:
    """grid_id 1.. by distance of the centre from the origin within each slide; ties by region_ord. With grid, the place in rows of 3 (up to 6 regions) or 2."""
    cx, cy = (F.col("x_min") + F.col("x_max")) / 2, (F.col("y_min") + F.col("y_max")) / 2
    out = regions.withColumns({"center_x": cx, "center_y": cy}).withColumn("distance", F.sqrt(F.col("center_x") * F.col("center_x") + F.col("center_y") * F.col("center_y")))
    out = out.withColumn("grid_id", F.row_number().over(Window.partitionBy("slide_id").orderBy("distance", "region_ord")))
    if not grid:
        return out
    across = F.when(F.count("*").over(Window.partitionBy("slide_id")) <= 6, 3).otherwise(2)
    i = F.col("grid_id") - 1
    return out.withColumn("grid_position", F.concat(F.lit("("), (F.floor(i / across) + 1).cast("string"), F.lit(", "), (i % across + 1).cast("string"), F.lit(")")))


def by_id(regions: DataFrame, id: int = 1, column: str = "id") -> DataFrame:
    """The first region of each slide with this id, or none."""
    first = F.row_number().over(Window.partitionBy("slide_id").orderBy("region_ord"))
    return regions.where(F.col(column) == id).withColumn("_n", first).where("_n = 1").drop("_n")


def statistics(regions: DataFrame, step_x: int | None = None, step_y: int | None = None) -> DataFrame:
    """Per slide: count, area, mean width and height, speed-up of doing one region, grid; no row without regions."""
    grid = F.lit(f"{step_x or 0}x{step_y or 0}")
    out = regions.groupBy("slide_id").agg(F.count("*").alias("n_regions"), F.sum(F.col("width") * F.col("height")).alias("total_area"), F.avg("width").alias("mean_width"), F.avg("height").alias("mean_height"))
    return out.withColumn("speed_up", F.col("n_regions")).withColumn("grid", grid)


def recommendations(regions: DataFrame, step: int | None = None, cell: tuple[int, int] | None = None) -> DataFrame:
    """What doing one region instead of all saves: speed-up and percent of time, to one decimal; the region of id 1 with
    its name ("N/A" if there is none), and the grid's step and cell ("N/A" without one)."""
    first = by_id(regions, 1).select("slide_id", F.col("name").alias("_name"))
    out = statistics(regions).join(first, "slide_id", "left")
    grid = F.lit(step if step is not None else "N/A").cast("string").alias("grid_step"), F.lit(f"{cell[0]}x{cell[1]}" if cell else "N/A").alias("cell_size")
    return out.select("slide_id", "n_regions", "speed_up", F.round(100 - F.lit(100.0) / F.col("n_regions"), 1).alias("time_reduction"), F.lit(1).alias("recommended_id"), F.coalesce("_name", F.lit("N/A")).alias("recommended_name"), *grid)


def grid_cell(x, y, step_x: int | None, step_y: int | None):
    """(i, j) of a position on the regions' grid; (0, 0) without one."""
    return [(F.floor(F.col(v) / s) if s else F.lit(0)).cast("bigint").alias(n) for v, s, n in ((x, step_x, "i"), (y, step_y, "j"))]


def bounds(components: DataFrame, key: str = "cluster") -> DataFrame:
    """Bounding box, id, name and number of components of each cluster; width, height and area are those of the box."""
    out = components.groupBy("slide_id", key).agg(F.min("x_min").alias("x_min"), F.min("y_min").alias("y_min"), F.max("x_max").alias("x_max"), F.max("y_max").alias("y_max"), F.count("*").alias("component_count"))
    out = out.withColumns({"id": (F.col(key) + 1).cast("int"), "width": F.col("x_max") - F.col("x_min"), "height": F.col("y_max") - F.col("y_min")})
    return out.withColumns({"name": F.concat(F.lit("Биоптат "), F.col("id").cast("string")), "area": F.col("width") * F.col("height")})


def scaled(regions: DataFrame, slides: DataFrame, side: int = 1024) -> DataFrame:
    """Thumbnail pixels to slide pixels by each slide's own size; corners, width, height and area are each cut towards zero."""
    met = regions.join(slides.select("slide_id", F.col("width").alias("_w"), F.col("height").alias("_h")), "slide_id")
    sx, sy = F.col("_w") / side, F.col("_h") / side
    w, h = F.col("x_max") - F.col("x_min"), F.col("y_max") - F.col("y_min")
    cut = {"x_min": F.col("x_min") * sx, "y_min": F.col("y_min") * sy, "x_max": F.col("x_max") * sx, "y_max": F.col("y_max") * sy, "width": w * sx, "height": h * sy, "area": w * h * sx * sy}
    return met.withColumns({c: v.cast("bigint") for c, v in cut.items()}).drop("_w", "_h")


def mask_cells(regions: DataFrame, size: int = 512) -> DataFrame:
    """Cells that a region's half-open mask touches; a mask is never rastered in pixels."""
    last = lambda v: F.floor((F.col(v) - 1) / size).cast("bigint")
    first = lambda v: F.floor(F.col(v) / size).cast("bigint")
    some = regions.where("x_max > x_min and y_max > y_min")
    return some.withColumn("i", F.explode(F.sequence(first("x_min"), last("x_max")))).withColumn("j", F.explode(F.sequence(first("y_min"), last("y_max")))).select("slide_id", "id", "i", "j")


def labelled(mask: np.ndarray) -> np.ndarray:
    """Components of a mask with eight neighbours, 1.. in reading order; 0 outside."""
    h, w = mask.shape
    label = np.where(mask, np.arange(1, h * w + 1).reshape(h, w), 0)
    while True:
        padded = np.pad(label, 1)
        best = label
        for i in range(3):
            for j in range(3):
                near = padded[i : i + h, j : j + w]
                best = np.where((near > 0) & (near < best), near, best)
        best = np.where(mask, best, 0)
        flat = np.concatenate([[0], best.ravel()])
        best = np.where(mask, flat[best], 0)  # a label's own place points at a better one
        if (best == label).all():
            break
        label = best
    kinds = np.unique(label[mask])
    return np.where(mask, np.searchsorted(kinds, label) + 1, 0)


def components_of(image: np.ndarray, least: int = 1000) -> list[dict]:
    """Tissue components of an RGB thumbnail: saturated, not too dark pixels, closed and opened, of at least ``least`` pixels."""
    ok = (saturation(image) >= 30) & (image.max(axis=-1) >= 30) & (hue(image) <= 180)
    label = labelled(closed_opened(ok, np.ones((5, 5), bool)))
    out = []
    for k in range(1, label.max(initial=0) + 1):
        y, x = np.nonzero(label == k)
        if len(y) >= least:
            out.append({"component": len(out), "area": len(y), "cx": float(x.mean()), "cy": float(y.mean()), "x_min": int(x.min()), "y_min": int(y.min()), "x_max": int(x.max()) + 1, "y_max": int(y.max()) + 1})
    return out


def tissue_components(thumbnails: DataFrame, least: int = 1000) -> DataFrame:
    """Components of each slide's thumbnail (slide_id, height, width, channels, image); thumbnails have a fixed size."""
    from .tiling import decoded

    def run(batches):
        for t in batches:
            rows = [{"slide_id": r.slide_id, **c} for r in t.itertuples() for c in components_of(decoded(r.image, r.height, r.width, r.channels), least)]
            yield pd.DataFrame(rows, columns=["slide_id", "component", "area", "cx", "cy", "x_min", "y_min", "x_max", "y_max"])

    return thumbnails.mapInPandas(run, "slide_id bigint, component int, area bigint, cx double, cy double, x_min bigint, y_min bigint, x_max bigint, y_max bigint")


def _kmeans(at: np.ndarray, k: int, tries: int, seed: int) -> np.ndarray:
    """Clusters of points, the best of some runs from spread-out starts; numbered by their first points."""
    rng = np.random.default_rng(seed)
    best, cost = np.zeros(len(at), np.int64), np.inf
    for _ in range(tries):
        centre = at[[rng.integers(len(at))]]
        while len(centre) < k:
            far = ((at[:, None] - centre[None]) ** 2).sum(axis=2).min(axis=1)
            pick = rng.choice(len(at), p=far / far.sum()) if far.sum() > 0 else rng.integers(len(at))
            centre = np.concatenate([centre, at[[pick]]])
        for _ in range(300):
            away = ((at[:, None] - centre[None]) ** 2).sum(axis=2)
            label = away.argmin(axis=1)
            new = np.stack([at[label == j].mean(axis=0) if (label == j).any() else centre[j] for j in range(k)])
            if (new == centre).all():
                break
            centre = new
        if (total := away[np.arange(len(at)), label].sum()) < cost:
            best, cost = label, total
    kinds, first = np.unique(best, return_index=True)
    return np.argsort(np.argsort(first))[np.searchsorted(kinds, best)]


def clustered(components: DataFrame, k: int = 6, tries: int = 10, seed: int = 42, order: str = "component") -> DataFrame:
    """Components with the cluster of their centroid among those of their slide, the best of some k-means runs; none of
    a slide with fewer than k. Clusters are numbered by their first component.

    A slide's components come from a thumbnail of fixed size and are at most a thousand, so a slide is one pandas group.
    """
    names = components.columns

    def run(t: pd.DataFrame) -> pd.DataFrame:
        if len(t) < k:
            return t.iloc[:0].assign(cluster=pd.Series([], dtype="int32"))
        t = t.sort_values(order, kind="stable")
        return t.assign(cluster=_kmeans(t[["cx", "cy"]].to_numpy(np.float64), k, tries, seed).astype("int32"))[[*names, "cluster"]]

    schema = T.StructType([*components.schema.fields, T.StructField("cluster", T.IntegerType())])
    return components.groupBy("slide_id").applyInPandas(run, schema)
