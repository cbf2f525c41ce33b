import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilelake.operators import regions as R, tiling
from tilelake.schemas import DETECTIONS, SLIDES
from tilelake.sources import documents, slides

DETS = [(0, 0, "lp", 1.0, 2.0, 31.0, 42.0, 0.75, [(1.0, 2.0), (31.0, 2.0), (31.0, 42.0)]), (1, 0, "mild", 5.0, 5.0, 9.0, 9.0, 0.25, None)]


class Drawn:
    """A slide drawn by rule instead of a file; a path with 'bad' can't be opened."""

    def __init__(self, path):
        if "bad" in path:
            raise OSError("no slide")
        self.width, self.height, self.levels, self.mpp = 100, 60, 2, None

    def read(self, x, y, size):
        return np.stack([np.full((size, size), v % 256, np.uint8) for v in (x, y, 7, 255)], axis=-1)

    def thumbnail(self, side):
        return np.full((side, side, 3), 9, np.uint8)


def test_slides_tiles_and_thumbnails(spark):
    files = spark.createDataFrame([(0, "/a.tiff"), (1, "/bad.tiff")], "slide_id long, path string")
    table = slides.metadata(files, Drawn)
    rows = {r.slide_id: r for r in table.collect()}
    assert (rows[0].width, rows[0].height, rows[0].mpp, rows[0].error) == (100, 60, None, None)
    assert rows[1].width is None and "no slide" in rows[1].error
    with pytest.raises(Exception, match="no slide"):
        slides.metadata(files, Drawn, permissive=False).collect()
    grid = tiling.numbered(tiling.grid(table, 20))
    tiles = slides.read_tiles(grid, table, Drawn, band=20).collect()
    assert len(tiles) == 15 and {(t.height, t.width, t.channels) for t in tiles} == {(20, 20, 3)}
    assert all(bytes(t.image)[:3] == bytes([t.x, t.y, 7]) for t in tiles)
    assert slides.thumbnails(table, Drawn, 8).collect()[0].height == 8
    assert slides.metadata(files.limit(0), Drawn).count() == 0


def test_png(spark):
    image = np.arange(12, dtype=np.uint8).reshape(2, 2, 3)
    df = spark.createDataFrame([(bytearray(image.tobytes()), 2, 2, 3), (None, 2, 2, 3)], "image binary, height int, width int, channels int")
    data, none = (r.p for r in df.select(slides.png().alias("p")).collect())
    assert none is None and bytes(data[:8]) == b"\x89PNG\r\n\x1a\n"
    at = bytes(data).index(b"IDAT")
    raw = zlib.decompress(bytes(data[at + 4 :]))
    assert raw == b"\0" + image[0].tobytes() + b"\0" + image[1].tobytes()


def test_listings(spark, tmp_path):
    for name in ("a.tiff", "b.SVS", "c.svs", "My_LP_1.pt", "mild.pt", "other.pt", "note.txt"):
        (tmp_path / name).write_bytes(b"x")
    assert sorted(r.path.rsplit("/", 1)[1] for r in documents.slide_files(spark, str(tmp_path)).collect()) == ["a.tiff", "c.svs"]
    assert {r.model_path.rsplit("/", 1)[1]: (r.window_size, r.min_conf) for r in documents.models(spark, str(tmp_path)).collect()} == {"My_LP_1.pt": (512, 0.5), "mild.pt": (512, 0.6), "other.pt": (512, 0.5)}
    with pytest.raises(Exception):
        documents.models(spark, str(tmp_path / "none")).collect()


def test_predictions_round_trip(spark, tmp_path):
    dets = spark.createDataFrame(DETS, DETECTIONS)
    table = spark.createDataFrame([(0, "/s.tiff", 10, 20, 1, [1.0], None, None), (1, "/t.tiff", 1, 2, 1, [1.0], 0.5, None)], SLIDES)
    docs = {r.slide_id: json.loads(r.json) for r in documents.documents(dets, table).collect()}
    assert docs[1]["predictions"] == [] and "polygon" not in docs[0]["predictions"][1]
    (tmp_path / "p.json").write_text(json.dumps(docs[0], indent=1))
    back = documents.predictions(spark, str(tmp_path / "p.json")).orderBy("det_ord").collect()
    assert [(r.class_name, r.x1, r.y2, r.conf) for r in back] == [("lp", 1.0, 42.0, 0.75), ("mild", 5.0, 9.0, 0.25)]
    sums = {r.slide: r for r in documents.summaries(dets, table).collect()}
    assert (sums["s"].predictions_count, sums["s"].label_statistics, sums["s"].avg_confidence) == (2, {"lp": 1, "mild": 1}, 0.5)
    assert (sums["t"].predictions_count, sums["t"].label_statistics, sums["t"].avg_confidence) == (0, {}, None)


def test_region_documents(spark, tmp_path):
    box = {"id": 1, "name": "r1", "x_min": 30, "y_min": 40, "x_max": 50, "y_max": 60, "width": 20, "height": 20}
    near = {**box, "id": 2, "name": "r2", "x_min": 0, "y_min": 0, "x_max": 4, "y_max": 4, "width": 4, "height": 4}
    kinds = {"a": {"biopsy_detection": {"biopsy_regions": [box, near]}}, "b": {"manual_analysis": {"biopsy_regions": [box, near], "recommended_grid": {"step_x": 7, "step_y": 9}}}, "c": {"simple_biopsy_analysis": {"biopsy_regions": [box, near], "grid_parameters": {"step_x": 7, "step_y": 9}}}}
    for k, v in kinds.items():
        (tmp_path / f"{k}.json").write_text(json.dumps(v))
        found = documents.regions(spark, str(tmp_path / f"{k}.json")).orderBy("region_ord").collect()
        assert [(r.id, r.x_max) for r in found] == [(1, 50), (2, 4)]
    assert {(r.step_x, r.step_y) for r in documents.grids(spark, str(tmp_path)).collect()} == {(7, 9)}
    numbered = R.renumbered(documents.regions(spark, str(tmp_path / "a.json")).withColumn("slide_id", F.lit(0).cast("long")))
    grid = json.loads(documents.region_documents(numbered).first().json)
    assert [n["original_id"] for n in grid["biopsy_grid"]["numbered_biopsies"]] == [2, 1]
    (tmp_path / "g.json").write_text(json.dumps(grid))
    assert [r.id for r in documents.regions(spark, str(tmp_path / "g.json")).orderBy("region_ord").collect()] == [2, 1]


def test_summary(spark, tmp_path):
    one = {"file": "a.json", "predictions_count": 3, "avg_confidence": 0.5, "label_statistics": {"lp": 3}}
    (tmp_path / "s.json").write_text(json.dumps({"a": one, "_summary": one}))
    assert [(r.slide, r.predictions_count, r.label_statistics) for r in documents.summary(spark, str(tmp_path / "s.json")).collect()] == [("a", 3, {"lp": 3})]
