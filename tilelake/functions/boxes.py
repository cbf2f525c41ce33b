"""Box algebra as column expressions, all inside whole-stage code generation.

A box is given by the prefix of its four columns: "" for x1..y2, "a_" for a_x1..a_y2.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def corners(p: str = "") -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(f"{p}{c}") for c in ("x1", "y1", "x2", "y2"))


def area(p: str = "") -> Column:
    x1, y1, x2, y2 = corners(p)
    return (x2 - x1) * (y2 - y1)


def center(p: str = "") -> tuple[Column, Column]:
    x1, y1, x2, y2 = corners(p)
    return (x1 + x2) / 2, (y1 + y2) / 2


def intersection(a: str, b: str) -> Column:
    """Area in common; 0 for boxes that only touch."""
    ax1, ay1, ax2, ay2 = corners(a)
    bx1, by1, bx2, by2 = corners(b)
    w = F.greatest(F.lit(0.0), F.least(ax2, bx2) - F.greatest(ax1, bx1))
    h = F.greatest(F.lit(0.0), F.least(ay2, by2) - F.greatest(ay1, by1))
    return w * h


def intersects(a: str, b: str) -> Column:
    """Whether boxes share area: touching is not intersecting."""
    return intersection(a, b) > 0


def iou(a: str, b: str) -> Column:
    """Intersection over union; 0 where the union is empty."""
    i = intersection(a, b)
    u = area(a) + area(b) - i
    return F.when(u > 0, i / u).otherwise(0.0)


def union(a: str, b: str) -> list[Column]:
    """The smallest box around both, as x1..y2."""
    ax1, ay1, ax2, ay2 = corners(a)
    bx1, by1, bx2, by2 = corners(b)
    return [F.least(ax1, bx1).alias("x1"), F.least(ay1, by1).alias("y1"), F.greatest(ax2, bx2).alias("x2"), F.greatest(ay2, by2).alias("y2")]


def cell(x: Column | str, size: float) -> Column:
    """Index of the grid cell that holds a coordinate: floor, also below zero."""
    x = F.col(x) if isinstance(x, str) else x
    return F.floor(x / F.lit(size)).cast("bigint")


def shifted(dx: Column | str, dy: Column | str, sign: int = 1) -> dict[str, Column]:
    """x1..y2 moved by an offset: +1 from tile to slide, -1 from slide to tile."""
    dx, dy = (F.col(v) if isinstance(v, str) else v for v in (dx, dy))
    x1, y1, x2, y2 = corners()
    return {"x1": x1 + sign * dx, "y1": y1 + sign * dy, "x2": x2 + sign * dx, "y2": y2 + sign * dy}
