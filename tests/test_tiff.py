import numpy as np
import pytest

from tilelake.operators import tiling
from tilelake.sources import slides, tiff


def drawn(h, w, channels=3, seed=0):
    return np.random.default_rng(seed).integers(0, 256, (h, w, channels), dtype=np.uint8)


@pytest.mark.parametrize("channels,deflate,difference,big", [(3, True, False, False), (3, True, True, True), (1, False, True, False), (4, False, False, True)])
def test_round_trip(tmp_path, channels, deflate, difference, big):
    image = drawn(70, 101, channels)
    path = tiff.saved(tiff.encoded([image, image[::2, ::2], image[::4, ::4]], 32, deflate, difference, big, 0.5), str(tmp_path), "a.tiff")
    t = tiff.Tiff(path)
    assert (t.width, t.height, t.levels, round(t.mpp, 9)) == (101, 70, 3, 0.5) and t.downsamples == [1.0, 101 / 51, 101 / 26]
    assert (t.region(0, 0, 101, 70) == image).all() and (t.region(13, 29, 50, 31) == image[29:60, 13:63]).all()
    assert (t.region(5, 7, 20, 20, 1) == image[::2, ::2][7:27, 5:25]).all()
    beyond = t.region(90, 60, 20, 20)
    assert (beyond[:10, :11] == image[60:, 90:]).all() and not beyond[10:].any() and not beyond[:, 11:].any()
    assert [p.rsplit("/", 1)[-1] for p in tiff.listed(str(tmp_path))] == ["a.tiff"]


def test_strips_and_other_byte_order(tmp_path):
    import struct

    image = drawn(10, 7, 1)
    strips = [image[i : i + 4].tobytes() for i in range(0, 10, 4)]
    head, at, places = b"MM" + struct.pack(">HI", 42, 8 + sum(map(len, strips))), 8, []
    for s in strips:
        places.append(at)
        at += len(s)
    tags = [(256, 3, 1, struct.pack(">HH", 7, 0)), (257, 3, 1, struct.pack(">HH", 10, 0)), (258, 3, 1, struct.pack(">HH", 8, 0)), (259, 3, 1, struct.pack(">HH", 1, 0)), (277, 3, 1, struct.pack(">HH", 1, 0)), (278, 3, 1, struct.pack(">HH", 4, 0))]
    table = at + 2 + 12 * 8 + 4
    tags += [(273, 4, 3, struct.pack(">I", table)), (279, 4, 3, struct.pack(">I", table + 12))]
    data = head + b"".join(strips) + struct.pack(">H", 8) + b"".join(struct.pack(">HHI", *t[:3]) + t[3] for t in tags) + struct.pack(">I", 0) + struct.pack(">III", *places) + struct.pack(">III", *map(len, strips))
    (tmp_path / "s.tif").write_bytes(data)
    t = tiff.Tiff(str(tmp_path / "s.tif"))
    assert (t.region(0, 0, 7, 10) == image).all() and (t.region(2, 3, 4, 6) == image[3:9, 2:6]).all()


@pytest.fixture
def folder(tmp_path):
    for i, (h, w) in enumerate([(100, 130), (64, 64), (20, 300)]):
        tiff.saved(tiff.encoded([drawn(h, w, 3, i)], 16), f"file://{tmp_path}", f"{i}.tiff")
    (tmp_path / "bad.svs").write_bytes(b"nothing")
    return f"file://{tmp_path}"


def test_metadata(spark, folder):
    rows = {r.path.rsplit("/", 1)[-1]: r for r in tiff.metadata(spark, folder).collect()}
    assert (rows["0.tiff"].width, rows["0.tiff"].height, rows["0.tiff"].error) == (130, 100, None) and rows["bad.svs"].width is None and "no TIFF" in rows["bad.svs"].error
    with pytest.raises(Exception, match="no TIFF"):
        tiff.metadata(spark, folder, permissive=False).collect()
    files = spark.createDataFrame([(0, f"{folder}/0.tiff")], "slide_id long, path string")
    assert slides.metadata(files, tiff.Tiff).first().level_downsamples == [1.0]


def good(folder):
    import os

    os.remove(folder.removeprefix("file://") + "/bad.svs")
    return folder


def test_tiles_and_pruning(spark, folder):
    good(folder)
    rows = tiff.tiles(spark, folder, 32, 0.5, band=48)
    got = {(r.path[-6], r.x, r.y): r for r in rows.collect()}
    want = [(str(i), x, y) for i, (h, w) in enumerate([(100, 130), (64, 64), (20, 300)]) for y in range(0, h - 31, 16) for x in range(0, w - 31, 16)]
    assert sorted(got) == sorted(want)
    for (i, x, y), r in got.items():
        image = drawn(*[(100, 130), (64, 64), (20, 300)][int(i)], 3, int(i))
        assert r.image == image[y : y + 32, x : x + 32].tobytes() and (r.height, r.width, r.channels, r.size) == (32, 32, 3, 32)
    part = tiff.tiles(spark, folder, 32, 0.5, band=48, x=(16, 17), y=(20, 50), paths=[f"{folder}/0.tiff", f"{folder}/9.tiff"])
    assert sorted((r.x, r.y) for r in part.collect()) == [(16, 32), (16, 48)] and part.rdd.getNumPartitions() == 1
    assert tiff.tiles(spark, folder, 32, paths=[f"{folder}/9.tiff"]).count() == 0
    assert rows.where("x > 40 and size = 33").count() == 0
    reader = tiff.TileReader({"path": folder, "tile": "32", "overlap": "0.5", "band": "48"})
    assert [b.ys for b in reader.partitions()] == [(0, 48, 16), (48, 80, 16), (0, 48, 16)]
    table = tiff.as_tiles(rows, 16)
    assert table.select("slide_id", "patch_id").distinct().count() == len(want)


def test_first_kept_reads_no_more_than_it_needs(spark, tmp_path):
    image = np.full((1024, 64, 3), 255, np.uint8)
    image[96:160] = drawn(64, 64)
    late = np.full((1024, 64, 3), 255, np.uint8)
    late[992:] = drawn(32, 64)
    for i, a in enumerate((image, late, np.full((64, 64, 3), 255, np.uint8))):
        tiff.saved(tiff.encoded([a], 32), str(tmp_path), f"{i}.tiff")
    read = spark.sparkContext.accumulator(0)
    tests = dict(tiling.TESTS)
    tiling.TESTS["counted"] = lambda x: (read.add(1), tests["spread"](x))[1]
    try:
        got = tiff.first_kept(spark, str(tmp_path), 3, "counted", tile=32).collect()
    finally:
        del tiling.TESTS["counted"]
    assert sorted((r.path[-6], r.patch_id, r.x, r.y) for r in got) == [("0", 0, 0, 96), ("0", 1, 32, 96), ("0", 2, 0, 128), ("1", 0, 0, 992), ("1", 1, 32, 992)]
    assert read.value == 2 * (7 + 32 + 2)  # of the first slide 1 + 2 + 4 rows of 32


def test_many_small_slides_share_tasks(spark, tmp_path, monkeypatch):
    image = {i: drawn(64, 64 if i % 3 else 20, 3, i) for i in range(400)}
    for i, a in image.items():
        (tmp_path / f"{i}.tiff").write_bytes(tiff.encoded([a], 16, deflate=i % 2 == 0))
    rows = tiff.tiles(spark, str(tmp_path), 32, 0.5, band=32)
    assert rows.rdd.getNumPartitions() <= 140  # a task for each of 532 bands before
    got = {(int(r.path.rsplit("/", 1)[1][:-5]), r.x, r.y): r.image for r in rows.collect()}
    assert got == {(i, x, y): a[y : y + 32, x : x + 32].tobytes() for i, a in image.items() if i % 3 for y in (0, 16, 32) for x in (0, 16, 32)}
    part = tiff.tiles(spark, str(tmp_path), 32, 0.5, band=32, x=(16, 17), y=(20, 50)).collect()
    assert len(part) == 266 and {(r.x, r.y) for r in part} == {(16, 32)}
    with monkeypatch.context() as m:  # bands known to planning go together as well, in their order
        m.setattr(tiff, "MANY", 1000)
        reader = tiff.TileReader({"path": str(tmp_path), "tile": "32", "overlap": "0.5", "band": "32"})
        parts = reader.partitions()
        bands = [b for p in parts for b in ([p] if isinstance(p, tiff.Band) else p.bands)]
        assert len(parts) <= 200 and len(bands) == 532 and [b.path for b in bands] == sorted(b.path for b in bands)
        assert sum(b.num_rows for p in parts for b in reader.read(p)) == len(got)
    wide = tiff.Band("a", 0, (0, 4096, 512), (0, 100_000, 512))
    assert tiff.packed([wide] * 3, 512) == [wide] * 3
