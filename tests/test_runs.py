import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilelake.operators import inference, regions, report, tiling
from tilelake.plans import pipeline
from tilelake.schemas import DETECTIONS, MODELS, TILES
from tilelake.streaming import detections as streaming

ROOT = Path(__file__).resolve().parent.parent


def tile(k, x, y, spots, size=64):
    """Pink tissue with dark squares."""
    image = np.full((size, size, 3), (220, 120, 160), np.uint8)
    image[::2] -= 20
    for a, b, w in spots:
        image[b : b + w, a : a + w] = 10
    return (0, k, x, y, size, size, size, 3, bytearray(image.tobytes()))


@pytest.fixture(scope="module")
def tiles(spark):
    white = (0, 3, 64, 64, 64, 64, 64, 3, bytearray(b"\xff" * 64 * 64 * 3))
    return spark.createDataFrame([tile(0, 0, 0, [(5, 5, 30)]), tile(1, 64, 0, [(2, 2, 24), (35, 30, 8)]), tile(2, 0, 64, []), white], TILES)


@pytest.fixture(scope="module")
def models(spark):
    return spark.createDataFrame([("/m/lp.pt", 64, 0.5), ("/m/big.pt", 512, 0.5)], MODELS)


def test_standard_run(spark, tiles, models):
    out = pipeline.standard(tiles, models, inference.dark_spots).collect()
    boxes = sorted((round(r.x1), round(r.y1), round(r.x2), round(r.y2)) for r in out)
    assert len(boxes) == 2 and {r.class_name for r in out} == {"lp"} and {r.conf for r in out} == {0.8}  # the spot of 8 is too small
    assert all(abs(a - b) <= 1 for got, want in zip(boxes, [(5, 5, 35, 35), (66, 2, 90, 26)]) for a, b in zip(got, want))


def test_improved_run(spark, tiles, models):
    out = pipeline.improved(tiles, models, inference.dark_spots, classes=("none",)).collect()
    assert len(out) == 2 + 0 and all(r.simplification_metrics is None or r.simplification_metrics.area_preserved > 0.9 for r in out)


def test_measured_runs(spark, tiles, models):
    for run, test, stages in ((pipeline.standard, "spread", ["inference", "filter", "merge"]), (pipeline.improved, "saturation", ["inference", "filter", "merge", "simplify"])):
        measured = report.Measured()
        out = run(tiles, models, inference.dark_spots, measured=measured)
        rows = {r.stage: r for r in measured.table(spark).collect()}
        assert list(rows) == stages and rows[stages[-1]].rows == out.count() and abs(sum(r.percent for r in rows.values()) - 100) < 1e-6
        assert measured.tiles.get["n"] == tiling.with_tissue(tiles, test).count()


def test_batches_of_a_model_are_whole(spark, tiles, models):
    sizes = spark.sparkContext.accumulator(0)

    def load(path):
        def run(images):
            sizes.add(10 ** (3 * len(images)))
            return [[] for _ in images]

        return run

    many = tiles.select("slide_id", *[c for c in tiles.columns if c != "slide_id"]).crossJoin(spark.range(5).drop("id")).coalesce(1)
    two = models.where("window_size = 64").union(spark.createDataFrame([("/m/x.pt", 64, 0.5)], MODELS))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        inference.detected(many, two, load, batch=8, permissive=False).count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    n = many.count()
    assert sizes.value == 2 * ((n // 8) * 10**24 + (10 ** (3 * (n % 8)) if n % 8 else 0))


def test_failing_model(spark, tiles, models):
    def broken(path):
        raise OSError("no weights")

    rows = inference.detected(tiles, models, broken).collect()
    assert len(rows) == 4 and all("no weights" in r.error for r in rows)
    with pytest.raises(Exception, match="no weights"):
        inference.detected(tiles, models, broken, permissive=False).collect()


def test_region_run(spark):
    image = np.full((200, 200, 3), 255, np.uint8)
    for x in (10, 110):
        for y in (20, 120):
            image[y : y + 50, x : x + 50] = (200, 80, 120)
    thumbs = spark.createDataFrame([(0, 200, 200, 3, bytearray(image.tobytes()))], "slide_id long, height int, width int, channels int, image binary")
    slides = spark.createDataFrame([(0, 10240, 20480)], "slide_id long, width long, height long")
    out = pipeline.region_workflow(thumbs, slides, k=4).orderBy("grid_id").collect()
    assert [r.grid_id for r in out] == [1, 2, 3, 4] and out[0].x_min == 100 and out[0].y_min == 400
    assert regions.clustered(regions.tissue_components(thumbs), 9).count() == 0


def test_rewritten_and_annotations(spark):
    ring = [(0.0, 0.0), (30.0, 0.0), (30.0, 20.0), (0.0, 20.0)]
    bow = [(0.0, 0.0), (10.0, 10.0), (10.0, 0.0), (0.0, 10.0)]
    df = spark.createDataFrame([(0, 0, "lp", 9.0, 9.0, 9.0, 9.0, 0.5, ring), (1, 0, "lp", 0.0, 0.0, 9.0, 9.0, 0.5, bow), (2, 0, "excl", 600.0, 0.0, 610.0, 9.0, 0.5, None)], DETECTIONS)
    assert [(r.det_id, r.x1, r.y1, r.x2, r.y2) for r in pipeline.rewritten(df).collect()] == [(0, 0.0, 0.0, 30.0, 20.0)]
    assert sorted((r.det_id, r.n_in_cell) for r in pipeline.annotations(df).collect()) == [(0, 2), (1, 2)]


def test_stream_of_detections(spark, tmp_path):
    rows = [(f"2024-01-01 00:{m:02d}:00", c, 0.0, 0.0, w, w, v) for m, c, w, v in ((1, "lp", 30.0, 0.5), (2, "lp", 30.0, 0.7), (3, "lp", 5.0, 0.9), (59, "mild", 30.0, 0.1))]
    df = spark.createDataFrame(rows, "t string, class_name string, x1 double, y1 double, x2 double, y2 double, conf double").select(F.to_timestamp("t").alias("ts"), "*").drop("t")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = streaming.class_counts(stream).writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted((r.class_name, r.n, round(r.mean_conf, 6)) for r in spark.table("counts").collect()) == [("lp", 2, 0.6), ("mild", 1, 0.1)]


def test_entry_without_training_data_operators(tmp_path):
    for name in ("__spark_entry__.py", "tilelake"):
        (tmp_path / name).symlink_to(ROOT / name) if name.endswith(".py") else None
    package = tmp_path / "tilelake"
    package.mkdir()
    for p in (ROOT / "tilelake").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (package / p.name).symlink_to(p)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, timeout=60)


def test_clusters_by_slide(spark):
    spots = [(x * 300.0 + dx, y * 300.0 + dy) for x in range(3) for y in range(2) for dx, dy in ((0, 0), (9, 2), (3, 8))]
    rows = [(s, i, x + 50 * s, y) for s in (0, 1) for i, (x, y) in enumerate(spots)] + [(2, i, 1.0 * i, 0.0) for i in range(5)]
    df = spark.createDataFrame(rows, "slide_id long, component long, cx double, cy double")
    got = regions.clustered(df, 6).collect()
    assert len(got) == 36 and all(r.cluster == r.component // 3 for r in got)
    same = spark.createDataFrame([(0, i, 1.0, 1.0) for i in range(8)], "slide_id long, component long, cx double, cy double")
    assert regions.clustered(same, 6).count() == 8 and regions.clustered(df.limit(0), 6).count() == 0


def test_detectors_load_once_per_process(spark, tiles, models, tmp_path):
    folder = str(tmp_path)

    def load(path):
        import os
        import uuid

        open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return inference.dark_spots(path)

    assert inference.detected(tiles.repartition(8), models, load).count() > 0
    import os

    pids = [f.split("-")[0] for f in os.listdir(folder)]
    assert pids and len(pids) == len(set(pids))


def test_tile_without_image_raises(spark, tiles):
    broken = tiles.withColumn("image", F.when(F.col("patch_id") > 0, F.col("image")))
    with pytest.raises(Exception, match="without an image"):
        tiling.with_tissue(broken).collect()


def test_reports(spark):
    runs = spark.createDataFrame([("sequential", None, 100, 10, 50.0), ("batch_4", 4, 100, 10, 20.0), ("batch_8", 8, 100, 10, 10.0), ("threads", None, 100, 10, 5.0)], "method string, batch_size int, tiles long, predictions long, seconds double")
    got = {r.method: r for r in report.run_comparison(runs).collect()}
    assert [m for m, r in got.items() if r.best_batch] == ["batch_8"] and [m for m, r in got.items() if r.fastest] == ["threads"] and got["batch_4"].speed_up == 2.5
    stages = report.stage_times(spark.createDataFrame([("load", 1.0), ("merge", 3.0)], "stage string, seconds double"), 40).collect()
    assert {(r.stage, r.percent, r.tiles_per_s) for r in stages} == {("load", 25.0, 10.0), ("merge", 75.0, 10.0)}
    rows = spark.createDataFrame([(0, 3, "lp", 0.0, 0.0, 1.0, 1.0, 0.5, None), (1, 3, "mild", 0.0, 0.0, 1.0, 1.0, 0.7, None), (2, 4, "lp", 0.0, 0.0, 1.0, 1.0, 0.9, None)], DETECTIONS)
    lines = [r.line for r in report.summary_lines(rows).orderBy("part", "place").collect()]
    assert lines == ["slides: 2, predictions: 3", "  lp: 2 (66.7%)", "  mild: 1 (33.3%)", "slide 3: 2 predictions, mean confidence 0.600, lp=1, mild=1", "slide 4: 1 predictions, mean confidence 0.900, lp=1"]
    assert [r.line for r in report.summary_lines(rows.limit(0)).collect()] == ["slides: 0, predictions: 0"]


def test_both_adaptive_searches_take_the_rings_once(spark):
    from tilelake.plans import queries

    rows = queries.adaptive_simplify_kept(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 2000 and all(r.few and r.kept and r.valid for r in rows) and sum(r.legacy for r in rows) == 1000
    plan = queries.adaptive_simplify_kept(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ring(") == 1 and "Union" not in plan


def test_shared_areas_do_not_deal_out_pairs(spark):
    from tilelake.operators import merge
    from tilelake.plans import queries

    found = queries.shared_areas(spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("RepartitionByExpression")  # boxes are spread before the join
    assert found.where("share > 0 and share <= 1 and area > 0").count() == found.count() > 0
    ring = lambda *p: "array(" + ", ".join(f"named_struct('x', {x}F, 'y', {y}F)" for x, y in p) + ")"
    big, small = ring((0, 0), (4, 0), (4, 4), (0, 4)), ring((2, 2), (2, 5), (5, 5), (5, 2))
    got = spark.range(3).selectExpr("id", f"if(id = 1, null, {big}) as a", f"if(id = 2, slice({small}, 1, 0), {small}) as b").select("id", merge.shared("a", "b").alias("s")).orderBy("id").collect()
    assert [got[0].s.area, got[0].s.least, got[1].s, got[2].s.area] == [4.0, 9.0, None, 0.0]


def test_smart_simplification_is_computed_once(spark):
    from tilelake.plans import queries

    found = queries.smart_simplify_kept(spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ring(") == 1 and "zip_with" not in plan  # areas come from batches too
    assert found.where("few and like and valid").count() == found.count() == 1000
