"""Detectors over tiles: one batched Python stage, with the detector loaded once per worker."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions import geometry as g
from .filters import area_band, large_enough, of_models, top_by_confidence
from .merge import points_of
from .suppress import suppressed
from .tiling import decoded

RAW = "slide_id bigint, patch_id bigint, tile_x bigint, tile_y bigint, model_path string, class_id int, class_name string, x1 double, y1 double, x2 double, y2 double, conf double, polygon array<struct<x:double,y:double>>, error string"
#: (model_path, images) -> per image a list of (class_id, class_name, box, conf, mask or None)
Detector = Callable[[str], Callable[[list[np.ndarray]], list[list[tuple]]]]


#: What this worker process has loaded, by run and model; a new run drops those of the one before.
LOADED: dict[tuple[str, str], Callable] = {}


def _detector(run_id: str, path: str, load: Detector) -> Callable:
    if (run_id, path) not in LOADED:
        for old in [k for k in LOADED if k[0] != run_id]:
            del LOADED[old]
        LOADED[run_id, path] = load(path)
    return LOADED[run_id, path]


def detected(tiles: DataFrame, models: DataFrame, load: Detector, batch: int = 8, permissive: bool = True) -> DataFrame:
    """Raw detections of every tile by every model of its size, boxes and polygons in slide pixels.

    load(model_path) is called once per worker process and model, whatever the number of tasks. Tiles of a model are
    gathered over the frames of a task until they make a batch, so all batches but a task's last are whole; at most a
    batch for each model waits. permissive: a failing model or batch gives a row with its
    error instead of none; else it raises.
    """
    run_id = uuid.uuid4().hex  # detectors of other runs, which may load in another way, are not this one's

    names = [c.split()[0] for c in RAW.split(", ")]

    def hits(path: str, part: list) -> list[tuple]:
        try:
            found = _detector(run_id, path, load)([decoded(r.image, r.height, r.width, r.channels) for r in part])
        except Exception as e:
            if not permissive:
                raise
            return [(r.slide_id, r.patch_id, r.x, r.y, path, *[None] * 8, f"{type(e).__name__}: {e}") for r in part]
        out = []
        for r, own in zip(part, found):
            for class_id, name, (x1, y1, x2, y2), conf, mask in own:
                ring = g.mask_ring(mask, r.x, r.y) if mask is not None else None
                out.append((r.slide_id, r.patch_id, r.x, r.y, path, class_id, name or f"class_{class_id}", x1 + r.x, y1 + r.y, x2 + r.x, y2 + r.y, conf, None if ring is None else points_of(ring), None))
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[str, list] = {}  # tiles of each model until they make a whole batch
        for t in frames:
            out: list[tuple] = []
            for r in t.itertuples():
                held = waiting.setdefault(r.model_path, [])
                held.append(r)
                if len(held) == batch:
                    out += hits(r.model_path, waiting.pop(r.model_path))
            yield pd.DataFrame(out, columns=names)
        for path in sorted(waiting):
            yield pd.DataFrame(hits(path, waiting[path]), columns=names)

    cols = ["slide_id", "patch_id", "x", "y", "height", "width", "channels", "image", "model_path"]
    return of_models(tiles, models).select(*cols).mapInPandas(run, RAW)


def decided(raw: DataFrame, models: DataFrame, iou: float = 0.5, most: int = 100, band: bool = False, conf: float | None = None) -> DataFrame:
    """What a detector reports: confidence, suppression by tile, model and class, at most ``most`` per tile and model, size."""
    rows = raw.where("error is null").join(models.select("model_path", "min_conf"), "model_path").where(F.col("conf") >= (F.lit(conf) if conf is not None else F.col("min_conf"))).drop("min_conf")
    rows = rows.withColumn("det_id", F.monotonically_increasing_id())
    from .graph import stored

    rows = stored(rows, "raw")  # numbers must not change between uses
    kept = suppressed(rows, iou, ("slide_id", "patch_id", "model_path", "class_name"))
    kept = top_by_confidence(kept, ["slide_id", "patch_id", "model_path"], most)
    return kept.where(area_band() if band else large_enough())


def dark_spots(path: str):
    """A deterministic stand-in for a detector, without weights: each dark component is a detection of the model's name."""
    from .regions import labelled

    name = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]

    def run(images: list[np.ndarray]) -> list[list[tuple]]:
        out = []
        for image in images:
            gray = image.mean(axis=-1)
            label = labelled(gray < 128)
            hits = []
            for k in range(1, label.max(initial=0) + 1):
                y, x = np.nonzero(label == k)
                hits.append((0, name, (float(x.min()), float(y.min()), float(x.max() + 1), float(y.max() + 1)), float(1 - gray[y, x].mean() / 255), (label == k).astype(float)))
            out.append(hits)
        return out

    return run
