"""Ring functions as higher-order column expressions. Rings are open: the first vertex is not repeated."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def _next(ring: Column) -> Column:
    """The vertex after each, the first after the last."""
    return F.concat(F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, F.lit(1), F.lit(1)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def signed_area(ring: Column) -> Column:
    """Shoelace area around the first vertex, which keeps far-away rings exact."""
    o = ring[0]
    return _sum(F.zip_with(ring, _next(ring), lambda p, q: (p["x"] - o["x"]) * (q["y"] - o["y"]) - (q["x"] - o["x"]) * (p["y"] - o["y"]))) / 2


def area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def perimeter(ring: Column) -> Column:
    return _sum(F.zip_with(ring, _next(ring), lambda p, q: F.sqrt((p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"]))))


def bounds(ring: Column) -> list[Column]:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return [F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2")]


def translated(ring: Column, dx: Column, dy: Column) -> Column:
    return F.transform(ring, lambda p: F.struct((p["x"] + dx).alias("x"), (p["y"] + dy).alias("y")))


def key_points(ring: Column, below: float = 165.0) -> Column:
    """The first vertex, where the closed ring begins and ends, and those whose angle is under ``below`` degrees; a vertex
    equal to a neighbour has none."""
    n = F.size(ring)

    def sharp(p: Column, i: Column) -> Column:
        a, b = F.get(ring, i - 1), F.get(ring, (i + 1) % n)
        ux, uy, vx, vy = a["x"] - p["x"], a["y"] - p["y"], b["x"] - p["x"], b["y"] - p["y"]
        lengths = F.sqrt(ux * ux + uy * uy) * F.sqrt(vx * vx + vy * vy)
        cos = (ux * vx + uy * vy) / lengths
        angle = F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cos))))
        return F.when(i == 0, True).when(lengths > 0, angle < below).otherwise(False)

    return F.filter(ring, sharp)


def roughness(ring: Column) -> Column:
    """Mean distance of the vertices but the first from the chord between their neighbours on the closed ring, where these
    differ, over the square root of the area."""
    n = F.size(ring)

    def off(p: Column, i: Column) -> Column:
        a, b = F.get(ring, i - 1), F.get(ring, (i + 1) % n)
        chord = F.sqrt((b["x"] - a["x"]) * (b["x"] - a["x"]) + (b["y"] - a["y"]) * (b["y"] - a["y"]))
        cross = F.abs((b["x"] - a["x"]) * (a["y"] - p["y"]) - (a["x"] - p["x"]) * (b["y"] - a["y"]))
        return F.when((i > 0) & (chord > 0), cross / chord)

    far = F.filter(F.transform(ring, off), lambda v: v.isNotNull())
    return F.when((n > 2) & (area(ring) > 0) & (F.size(far) > 0), _sum(far) / F.size(far) / F.sqrt(area(ring))).otherwise(0.0)


def metrics(ring: Column) -> Column:
    """Points (the closing one counts), area, perimeter, compactness, complexity, roughness and the two flags, as one struct.

    One fold over the vertices adds up the shoelace terms, the lengths, and for the roughness the distances from the
    chords with their number.
    """
    n = F.size(ring)
    zero = F.struct(F.lit(0.0).alias("twice"), F.lit(0.0).alias("length"), F.lit(0.0).alias("far"), F.lit(0).alias("chords"))

    def step(acc: Column, i: Column) -> Column:
        o, p, q, b = F.get(ring, F.lit(0)), F.get(ring, i), F.get(ring, (i + 1) % n), F.get(ring, i - 1)
        dx, dy = q["x"] - p["x"], q["y"] - p["y"]
        cx, cy = q["x"] - b["x"], q["y"] - b["y"]
        chord = F.sqrt(cx * cx + cy * cy)
        counts = (i > 0) & (chord > 0)
        away = F.abs(cx * (b["y"] - p["y"]) - (b["x"] - p["x"]) * cy) / chord
        return F.struct(
            (acc["twice"] + (p["x"] - o["x"]) * (q["y"] - o["y"]) - (q["x"] - o["x"]) * (p["y"] - o["y"])).alias("twice"), (acc["length"] + F.sqrt(dx * dx + dy * dy)).alias("length"),
            (acc["far"] + F.when(counts, away).otherwise(0.0)).alias("far"), (acc["chords"] + F.when(counts, 1).otherwise(0)).alias("chords"),
        )

    def finish(acc: Column) -> Column:
        a, p = F.abs(acc["twice"]) / 2, acc["length"]
        rough = F.when((n > 2) & (a > 0) & (acc["chords"] > 0), acc["far"] / acc["chords"] / F.sqrt(a)).otherwise(0.0)
        return F.struct(
            (n + 1).alias("n_points"), a.alias("area"), p.alias("perimeter"), F.when(p > 0, 4 * math.pi * a / (p * p)).otherwise(0.0).alias("compactness"),
            F.when(a > 0, p / F.sqrt(a)).otherwise(0.0).alias("complexity"), rough.alias("roughness"), (n + 1 < 10).alias("is_simple"), (n + 1 > 100).alias("is_complex"),
        )

    return F.aggregate(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), zero, step, finish)


def vertex_steps(ring: Column) -> Column:
    """Difference of each vertex from the one before, for all but the first."""
    return F.zip_with(F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0))), lambda q, p: F.struct((q["x"] - p["x"]).alias("dx"), (q["y"] - p["y"]).alias("dy")))
