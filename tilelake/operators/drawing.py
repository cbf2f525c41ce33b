"""Drawing of boxes and rings on tiles, from tables of shapes.

A shape is dealt to the tiles it touches. Heaps of a tile's shapes are rastered apart, each to an image of which shape is
uppermost at each pixel, and these images are laid over each other by the order of the shapes; a tile with very many
shapes is so worked on by many tasks. The tile's own pixels come last, by a join on (slide_id, x, y).
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.geometry import opened
from .graph import by_component, stored
from .union import flat

#: Shapes of a tile that are rastered together.
HEAP = 4096
LAYER = "slide_id bigint, x bigint, y bigint, layer binary"


def filled(ring: np.ndarray, size: int) -> np.ndarray:
    """Pixels of a size x size tile whose centres lie in a ring (even-odd), by scan lines."""
    out = np.zeros((size, size), bool)
    a, b = ring, np.concatenate((ring[1:], ring[:1]))
    low, high = np.minimum(a[:, 1], b[:, 1]), np.maximum(a[:, 1], b[:, 1])
    first = np.clip(np.ceil(low - 0.5), 0, size).astype(int)
    last = np.clip(np.ceil(high - 0.5), 0, size).astype(int)  # the upper end is left to the next edge
    n = last - first
    edge = np.repeat(np.arange(len(a)), n)
    y = first[edge] + np.arange(len(edge)) - np.repeat(np.cumsum(n) - n, n)
    t = (y + 0.5 - a[edge, 1]) / (b - a)[edge, 1]
    x = np.clip(np.ceil(a[edge, 0] + t * (b - a)[edge, 0] - 0.5), 0, size).astype(int)
    turns = np.zeros((size, size + 1), int)
    np.add.at(turns, (y, x), 1)
    out[:] = np.cumsum(turns, axis=1)[:, :size] % 2 == 1
    return out


def outlined(ring: np.ndarray, size: int, width: int = 2) -> np.ndarray:
    """Pixels of a tile within half the width of a ring's edges, measured along the steeper axis, ends included."""
    out = np.zeros((size, size), bool)
    lo, hi = -(width // 2), width - width // 2
    for (x1, y1), (x2, y2) in zip(ring, np.concatenate((ring[1:], ring[:1]))):
        flat_ = abs(x2 - x1) >= abs(y2 - y1)
        if not flat_:
            x1, y1, x2, y2 = y1, x1, y2, x2
        if x1 > x2:
            x1, y1, x2, y2 = x2, y2, x1, y1
        u = np.arange(max(int(np.floor(x1)) + lo, 0), min(int(np.floor(x2)) + hi, size))
        v = np.floor(y1 + (np.clip(u, x1, x2) - x1) * ((y2 - y1) / (x2 - x1) if x2 > x1 else 0.0)).astype(int)
        for k in range(lo, hi):
            ok = (v + k >= 0) & (v + k < size)
            out[(v[ok] + k, u[ok]) if flat_ else (u[ok], v[ok] + k)] = True
    return out


def layers(shapes: DataFrame, size: int, fill: bool = False, width: int = 2) -> DataFrame:
    """(slide_id, x, y, layer): for each tile that a shape touches, an image (deflated, 12 bytes a pixel: order and colour) of
    the uppermost shape at each pixel.

    Shapes are (slide_id, det_id, polygon, colour as #RRGGBB); a higher det_id lies above a lower one. Boxes are polygons of
    their corners. fill: the inside is drawn, else an outline.
    """
    rows = shapes.where(F.size("polygon") > 0).select("slide_id", F.col("det_id").alias("id"), flat("polygon").alias("xy"), F.conv(F.substring("colour", 2, 6), 16, 10).cast("int").alias("colour"))
    of = lambda axis: F.filter(F.col("xy"), lambda v, i: i % 2 == axis)
    cell = lambda v, off: F.floor((v + F.lit(float(off))) / F.lit(size)).cast("bigint")
    reach = 0 if fill else width
    span = lambda axis: F.sequence(cell(F.array_min(of(axis)), -reach), cell(F.array_max(of(axis)), reach))
    rows = rows.withColumn("x", F.explode(span(0))).withColumn("y", F.explode(span(1))).withColumns({"x": F.col("x") * size, "y": F.col("y") * size}).where("x >= 0 and y >= 0")
    many = rows.groupBy("slide_id", "x", "y").agg(F.ceil(F.count("*") / HEAP).alias("heaps"))
    dealt = stored(rows.join(many, ["slide_id", "x", "y"]).withColumn("heap", F.pmod(F.xxhash64("id"), F.col("heaps"))).drop("heaps"), "shapes")

    def raster(t: pd.DataFrame) -> pd.DataFrame:
        order, colour = np.full((size, size), -1, np.int64), np.zeros((size, size), np.int32)
        base = np.array([t.x.iloc[0], t.y.iloc[0]], float)
        for r in t.sort_values("id", kind="stable").itertuples(index=False):
            ring = opened(np.asarray(r.xy, np.float64).reshape(-1, 2)) - base
            on = filled(ring, size) if fill else outlined(ring, size, width)
            order[on], colour[on] = r.id, r.colour
        return pd.DataFrame([(t.slide_id.iloc[0], t.x.iloc[0], t.y.iloc[0], _packed(order, colour))], columns=["slide_id", "x", "y", "layer"])

    def over(t: pd.DataFrame) -> pd.DataFrame:
        order, colour = _unpacked(t["layer"].iloc[0], size)
        for data in t["layer"].iloc[1:]:
            o, c = _unpacked(data, size)
            up = o > order
            order[up], colour[up] = o[up], c[up]
        return pd.DataFrame([(t.slide_id.iloc[0], t.x.iloc[0], t.y.iloc[0], _packed(order, colour))], columns=["slide_id", "x", "y", "layer"])

    heaps = stored(by_component(dealt, raster, LAYER, keys=("slide_id", "x", "y", "heap"), rows=1000), "layers")
    return by_component(heaps, over, LAYER, keys=("slide_id", "x", "y"), rows=200)


def _packed(order: np.ndarray, colour: np.ndarray) -> bytes:
    return zlib.compress(order.tobytes() + colour.tobytes(), 1)


def _unpacked(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(data)
    return np.frombuffer(raw, np.int64, size * size).reshape(size, size).copy(), np.frombuffer(raw, np.int32, size * size, 8 * size * size).reshape(size, size).copy()


def drawn(tiles: DataFrame, layer: DataFrame, size: int, opacity: float = 1.0) -> DataFrame:
    """The tiles (slide_id, x, y, height, width, channels, image) with what is drawn on them; tiles nothing is drawn on stay."""
    met = tiles.join(layer, ["slide_id", "x", "y"], "left")

    @F.pandas_udf("binary")
    def mixed(image: pd.Series, height: pd.Series, width: pd.Series, channels: pd.Series, layer: pd.Series) -> pd.Series:
        out = []
        for i, h, w, c, data in zip(image, height, width, channels, layer):
            if data is not None:
                order, colour = _unpacked(data, size)
                on = order[:h, :w] >= 0
                a = np.frombuffer(i, np.uint8).reshape(h, w, c).copy()
                ink = np.stack([colour[:h, :w] >> s & 255 for s in (16, 8, 0)], axis=-1)[on]
                a[on, :3] = np.rint(a[on, :3] * (1 - opacity) + ink * opacity).astype(np.uint8)
                i = a.tobytes()
            out.append(i)
        return pd.Series(out, dtype=object)

    return met.withColumn("image", mixed("image", "height", "width", "channels", "layer")).drop("layer")


def pixel_counts(layer: DataFrame, size: int) -> DataFrame:
    """(slide_id, colour, n): pixels of each colour on a slide."""

    def run(frames):
        for t in frames:
            rows = []
            for s, data in zip(t.slide_id, t["layer"]):
                order, colour = _unpacked(data, size)
                v, n = np.unique(colour[order >= 0], return_counts=True)
                rows += [(s, f"#{int(c):06X}", int(k)) for c, k in zip(v, n)]
            yield pd.DataFrame(rows, columns=["slide_id", "colour", "n"])

    return layer.mapInPandas(run, "slide_id bigint, colour string, n bigint").groupBy("slide_id", "colour").agg(F.sum("n").alias("n"))
