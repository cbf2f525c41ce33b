import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilelake.functions import geometry as g
from tilelake.operators import drawing, pixels
from tilelake.sources import files, slides

SHAPES = "slide_id long, det_id long, polygon array<struct<x:double,y:double>>, colour string"


def star(cx, cy, r, n):
    t = np.linspace(0, 2 * np.pi, 2 * n, endpoint=False)
    k = np.where(np.arange(2 * n) % 2, r, r / 3)
    return np.stack([cx + k * np.cos(t), cy + k * np.sin(t)], axis=1)


def test_filling_against_containment():
    y, x = np.mgrid[:40, :40] + 0.5
    at = np.stack([x.ravel(), y.ravel()], axis=1)
    for ring in (star(20.03, 19.01, 15.7, 5), star(2.11, 35.3, 14.2, 4), np.array([(3, 4), (30, 4), (30, 22), (3, 22)], float), star(200.0, 10.0, 5.0, 3)):
        assert (drawing.filled(ring, 40).ravel() == g.contains([ring], at)).all()


def test_outlines():
    box = np.array([(5, 6), (25, 6), (25, 16), (5, 16)], float)
    on = drawing.outlined(box, 32, 1)
    y, x = np.nonzero(on)
    want = {(a, b) for a in range(5, 26) for b in (6, 16)} | {(a, b) for b in range(6, 17) for a in (5, 25)}
    assert set(zip(x.tolist(), y.tolist())) == want
    thick = drawing.outlined(box, 32, 2)
    assert thick[on].all() and thick.sum() > on.sum() and not thick[10:12, 10:20].any()
    slanted = drawing.outlined(np.array([(0, 0), (31, 31), (0, 31)], float), 32, 1)
    assert all(slanted[k, k] for k in range(31))


@pytest.mark.parametrize("heap", [4096, 3])
def test_layers_over_tiles(spark, monkeypatch, heap):
    monkeypatch.setattr(drawing, "HEAP", heap)
    rng = np.random.default_rng(0)
    shapes = [star(*rng.uniform(0, 100, 2), rng.uniform(3, 30), int(rng.integers(3, 7))) for _ in range(40)]
    colours = [f"#{int(c):06X}" for c in rng.integers(0, 1 << 24, 40)]
    rows = spark.createDataFrame([(0, i, [tuple(p) for p in s.tolist()], c) for i, (s, c) in enumerate(zip(shapes, colours))] + [(0, 99, None, "#FFFFFF")], SHAPES)
    layer = drawing.layers(rows, 32, fill=True)
    blank = np.full((96, 96, 3), 200, np.uint8)
    tiles = spark.createDataFrame([(0, x, y, 32, 32, 3, blank[:32, :32].tobytes()) for x in range(0, 96, 32) for y in range(0, 96, 32)], pixels.GRID)
    want = blank.copy()
    for s, c in zip(shapes, colours):
        want[drawing.filled(s, 96)] = [int(c[k : k + 2], 16) for k in (1, 3, 5)]
    for r in drawing.drawn(tiles, layer, 32).collect():
        assert r.image == want[r.y : r.y + 32, r.x : r.x + 32].tobytes()
    half = drawing.drawn(tiles, drawing.layers(rows.limit(0), 32), 32, 0.5)
    assert half.count() == 9 and half.first().image == blank[:32, :32].tobytes()


def test_sink_lists_what_was_committed(spark, tmp_path):
    rng = np.random.default_rng(1)
    images = [rng.integers(0, 256, (8, 9, 3), dtype=np.uint8) for _ in range(12)]
    rows = spark.createDataFrame([(f"a_{i}_0.png", 8, 9, 3, a.tobytes()) for i, a in enumerate(images)], "name string, height int, width int, channels int, image binary").repartition(4)
    folder = f"file://{tmp_path}/out"
    assert files.listing(spark, folder).count() == 0
    files.write(rows, folder)
    got = {r.name: r.image for r in files.read(spark, folder).collect()}
    assert got == {f"a_{i}_0.png": a.tobytes() for i, a in enumerate(images)}
    with pytest.raises(Exception):
        broken = rows.withColumn("image", F.when(F.col("name") == "a_7_0.png", F.lit(b"x")).otherwise(F.col("image"))).withColumn("name", F.concat(F.lit("b"), "name"))
        files.write(broken, folder)
    assert any(n.startswith("ba_") for _, _, names in os.walk(tmp_path) for n in names)  # files of the failed job lie there
    assert {r.name for r in files.listing(spark, folder).collect()} == set(got)
    files.write(rows.limit(1).withColumn("name", F.lit("c.png")), folder)
    assert files.listing(spark, folder).count() == 13
    files.write(rows.limit(1).withColumn("name", F.lit("d.png")), folder, "overwrite")
    assert [r.name for r in files.listing(spark, folder).collect()] == ["d.png"]


def test_other_filters_of_png():
    import struct
    import zlib

    a = np.random.default_rng(2).integers(0, 256, (5, 6, 3), dtype=np.uint8)
    pad = np.zeros((6, 7, 3), int)
    pad[1:, 1:] = a
    lines = []
    for y in range(5):
        left, up, diag = pad[y + 1, :-1], pad[y, 1:], pad[y, :-1]
        p = left + up - diag
        paeth = np.where((abs(p - left) <= abs(p - up)) & (abs(p - left) <= abs(p - diag)), left, np.where(abs(p - up) <= abs(p - diag), up, diag))
        guess = [0 * left, left, up, (left + up) // 2, paeth][y]
        lines.append(bytes([y]) + ((a[y] - guess) % 256).astype(np.uint8).tobytes())
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 6, 5, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")
    assert (files.unpacked(data) == a).all() and (files.unpacked(slides._png(a)) == a).all()
    with pytest.raises(ValueError):
        files.unpacked(b"GIF")
