"""Statistics, rankings and histograms over detections."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from ..functions.boxes import area, cell, shifted
from .filters import CELL, in_window, not_class
from .graph import stored

#: Colours of report classes.
COLOURS = {"Crypts": "#FF6B6B", "Muscularis mucosae": "#4ECDC4", "Surface epithelium": "#45B7D1", "moderate_segmentation": "#96CEB4", "Mild": "#FFEAA7", "excl": "#DDA0DD"}


def class_statistics(detections: DataFrame, keys: tuple[str, ...] = ("slide_id",)) -> DataFrame:
    """Rows and mean confidence by class of each slide."""
    return detections.groupBy(*keys, "class_name").agg(F.count("*").alias("n"), F.avg("conf").alias("mean_conf"))


def slide_statistics(detections: DataFrame, slides: DataFrame | None = None) -> DataFrame:
    """Total, mean confidence (null without rows) and counts by class as a map; with slides, empty ones too."""
    by = detections.groupBy("slide_id", "class_name").agg(F.count("*").alias("n"), F.sum("conf").alias("c"))
    by = by.groupBy("slide_id").agg(F.sum("n").alias("total"), (F.sum("c") / F.sum("n")).alias("average_confidence"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("class_name", "n")))).alias("by_class"))
    if slides is None:
        return by
    return slides.select("slide_id").join(by, "slide_id", "left").withColumn("total", F.coalesce("total", F.lit(0)))


def label_rollup(detections: DataFrame) -> DataFrame:
    """Counts by (slide, label), by slide and in all, with the number of slides; level 0, 1, 3 from finest."""
    rolled = detections.rollup("slide_id", "class_name").agg(F.count("*").alias("n"), F.avg("conf").alias("mean_conf"), F.grouping_id().alias("level"))
    return rolled


def label_totals(detections: DataFrame) -> DataFrame:
    """Over all slides: rows and slides of each label, by label."""
    by = detections.groupBy("slide_id", "class_name").agg(F.count("*").alias("n"))
    return by.groupBy("class_name").agg(F.sum("n").alias("n"), F.count("*").alias("n_slides")).orderBy("class_name")


def histogram(detections: DataFrame, value: Column, bins: int = 20, key: str = "class_name") -> DataFrame:
    """Equal-width bins from the least to the largest value of each class, the last one closed; one bin if they are equal."""
    rows = detections.select(key, value.cast("double").alias("_v"))
    ends = rows.groupBy(key).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    met = rows.join(ends, key)
    place = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((F.col("_v") - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))), F.lit(bins - 1))).otherwise(0)
    return met.groupBy(key, place.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def class_means(detections: DataFrame) -> DataFrame:
    return detections.groupBy("class_name").agg(F.count("*").alias("n"), F.avg("conf").alias("mean_conf"), F.avg(area()).alias("mean_area"))


def filter_statistics(before: DataFrame, after: DataFrame) -> DataFrame:
    """By class of the input: rows before and after, removed, and the share removed."""
    b, a = before.groupBy("class_name").agg(F.count("*").alias("original")), after.groupBy("class_name").agg(F.count("*").alias("filtered"))
    out = b.join(a, "class_name", "left").withColumn("filtered", F.coalesce("filtered", F.lit(0)))
    return out.withColumn("removed", F.col("original") - F.col("filtered")).withColumn("ratio", F.col("removed") / F.col("original"))


def cell_classes(detections: DataFrame, size: float = CELL) -> DataFrame:
    return detections.groupBy("slide_id", cell("x1", size).alias("i"), cell("y1", size).alias("j")).agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("class_name")), ",").alias("classes"))


def cells_ranked(detections: DataFrame, n: int | None = None, size: float = CELL, within: float | None = None, exclude: str = "excl") -> DataFrame:
    """Cells by falling number of detections without the excluded class; ties by first det_id; a top-n report if n is given."""
    rows = detections.where(not_class(exclude))
    rows = rows.where(in_window(within, size)) if within is not None else rows
    cells = rows.groupBy("slide_id", cell("x1", size).alias("i"), cell("y1", size).alias("j")).agg(F.count("*").alias("n"), F.min("det_id").alias("first_det_id"))
    ranked = cells.orderBy(F.desc("n"), "first_det_id")
    return ranked.limit(n) if n is not None else ranked


def first_cells(detections: DataFrame, n: int, size: float = CELL) -> DataFrame:
    """The n cells seen first, a report in the order of det_id."""
    cells = detections.groupBy("slide_id", cell("x1", size).alias("i"), cell("y1", size).alias("j")).agg(F.count("*").alias("n"), F.min("det_id").alias("first_det_id"))
    return cells.orderBy("first_det_id").limit(n)


def tile_relative(detections: DataFrame, size: float = CELL) -> DataFrame:
    """Boxes relative to the cell that holds their start, with its indices."""
    i, j = cell("x1", size), cell("y1", size)
    return detections.withColumns({"i": i, "j": j}).withColumns({k: v for k, v in shifted(F.col("i") * size, F.col("j") * size, -1).items()})


def coloured(detections: DataFrame, colours: dict[str, str] | None = None, default: str = "#000000") -> DataFrame:
    literal = F.create_map(*[F.lit(x) for kv in (colours or COLOURS).items() for x in kv])
    return detections.withColumn("colour", F.coalesce(F.element_at(literal, F.col("class_name")), F.lit(default)))


def class_named(detections: DataFrame, classes: DataFrame) -> DataFrame:
    """class_id -> class_name of the model; an unknown id is class_{id}. classes is a small dimension."""
    named = detections.join(classes.select("model_path", "class_id", F.col("class_name").alias("_name")), ["model_path", "class_id"], "left")
    return named.withColumn("class_name", F.coalesce("_name", F.concat(F.lit("class_"), F.col("class_id").cast("string")))).drop("_name")


def tile_name(path: str = "path", i: str = "i", j: str = "j") -> Column:
    """{stem}_{i}_{j}.png of a file path."""
    return F.concat(stem(path), F.lit("_"), F.col(i).cast("string"), F.lit("_"), F.col(j).cast("string"), F.lit(".png"))


def stem(path: str = "path") -> Column:
    name = F.regexp_extract(path, "([^/]*)$", 1)
    return F.regexp_replace(name, "(?<=.)\\.[^.]*$", "")


def run_comparison(runs: DataFrame, base: str = "sequential") -> DataFrame:
    """Throughput of runs (method, batch_size, tiles, predictions, seconds) and speed-up over the base method; flags the
    fastest, and of the runs in batches (batch_size not null), if the column is there, the one with the largest speed-up."""
    per = runs.select("*", (F.col("tiles") / F.col("seconds")).alias("tiles_per_s"), (F.col("predictions") / F.col("seconds")).alias("predictions_per_s"))
    every = Window.partitionBy(F.lit(1))
    slow = F.max(F.when(F.col("method") == base, F.col("seconds"))).over(every)
    out = per.withColumn("speed_up", slow / F.col("seconds")).withColumn("fastest", F.col("seconds") == F.min("seconds").over(every))
    if "batch_size" not in runs.columns:
        return out
    best = F.max(F.when(F.col("batch_size").isNotNull() & (F.col("method") != base), F.struct("speed_up", -F.col("batch_size")))).over(every)
    return out.withColumn("_b", best).withColumn("best_batch", F.coalesce(F.struct("speed_up", -F.col("batch_size")) == F.col("_b"), F.lit(False))).drop("_b")


def model_info(models: DataFrame, classes: DataFrame) -> DataFrame:
    """What is known of each model: (model_path, window_size, min_conf, class_names by id, num_classes)."""
    names = classes.groupBy("model_path").agg(F.transform(F.sort_array(F.collect_list(F.struct("class_id", "class_name"))), lambda c: c["class_name"]).alias("class_names"))
    out = models.select("model_path", "window_size", "min_conf").join(names, "model_path", "left")
    return out.withColumn("class_names", F.coalesce("class_names", F.array().cast("array<string>"))).withColumn("num_classes", F.size("class_names"))


def summary_lines(detections: DataFrame, n: int = 10) -> DataFrame:
    """The text report of all slides as (ord, line): totals, the n most frequent labels with their share, and each slide."""
    by = detections.groupBy("slide_id", "class_name").agg(F.count("*").alias("n"), F.sum("conf").alias("c"))
    every = by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_distinct("slide_id").alias("s"))
    head = every.select(F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("place"), F.concat(F.lit("slides: "), "s", F.lit(", predictions: "), "n").alias("line"))
    label = by.groupBy("class_name").agg(F.sum("n").alias("k")).crossJoin(F.broadcast(every.select(F.col("n").alias("all"))))  # one row
    label = label.orderBy(F.desc("k"), "class_name").limit(n).select(F.lit(1).alias("part"), (-F.col("k")).alias("place"), F.format_string("  %s: %d (%.1f%%)", "class_name", "k", 100.0 * F.col("k") / F.col("all")).alias("line"))
    slide = by.groupBy("slide_id").agg(F.sum("n").alias("k"), (F.sum("c") / F.sum("n")).alias("m"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("class_name", "n"))), lambda x: F.concat(x["class_name"], F.lit("="), x["n"].cast("string"))), ", ").alias("of"))
    slide = slide.select(F.lit(2).alias("part"), F.col("slide_id").cast("bigint").alias("place"), F.format_string("slide %s: %d predictions, mean confidence %.3f, %s", F.col("slide_id").cast("string"), "k", "m", "of").alias("line"))
    return head.union(label).union(slide)


def stage_times(stages: DataFrame, tiles: int) -> DataFrame:
    """Seconds and percent of each stage (stage, seconds) and tiles a second of the whole run."""
    total = F.sum("seconds").over(Window.partitionBy(F.lit(1)))
    return stages.withColumn("percent", 100 * F.col("seconds") / total).withColumn("tiles_per_s", F.lit(tiles) / total)


class Measured:
    """Stages of a run as they are computed: seconds and rows of each, and the tiles that came to the detectors.

    A stage ends where its rows are stored; what Spark computes in one go is one stage.
    """

    def __init__(self):
        self.stages: list[tuple[str, float, int]] = []
        self.tiles = Observation("tiles")

    def seen(self, tiles: DataFrame) -> DataFrame:
        """The tiles, counted as they pass."""
        return tiles.observe(self.tiles, F.count(F.lit(1)).alias("n"))

    def stored(self, rows: DataFrame, stage: str) -> DataFrame:
        counted, began = Observation(stage), time.monotonic()
        out = stored(rows.observe(counted, F.count(F.lit(1)).alias("n")), stage)
        self.stages.append((stage, time.monotonic() - began, counted.get["n"]))
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        """(stage, seconds, rows, percent, tiles_per_s)."""
        return stage_times(spark.createDataFrame(self.stages, "stage string, seconds double, rows bigint"), self.tiles.get["n"])


def slide_details(detections: DataFrame, slides: DataFrame) -> DataFrame:
    """The report of each slide as (slide_id, part, place, line): its file and size, totals, labels in their order, and every
    detection in the order of det_id with its box and the points of its polygon."""
    own = slides.select("slide_id", F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("place"), F.format_string("file: %s, %s x %s", F.coalesce("path", F.lit("-")), F.col("width").cast("string"), F.col("height").cast("string")).alias("line"))
    by = detections.groupBy("slide_id", "class_name").agg(F.count("*").alias("n"), F.sum("conf").alias("c"))
    total = by.groupBy("slide_id").agg(F.sum("n").alias("n"), (F.sum("c") / F.sum("n")).alias("m"))
    total = slides.select("slide_id").join(total, "slide_id", "left").select("slide_id", F.lit(1).alias("part"), F.lit(0).cast("bigint").alias("place"), F.when(F.col("n").isNull(), F.lit("predictions: 0")).otherwise(F.format_string("predictions: %d, mean confidence %.3f", "n", "m")).alias("line"))
    place = F.row_number().over(Window.partitionBy("slide_id").orderBy("class_name")).cast("bigint")
    label = by.select("slide_id", F.lit(2).alias("part"), place.alias("place"), F.format_string("  %s: %d", "class_name", "n").alias("line"))
    points = F.coalesce(F.size("polygon"), F.lit(0)) if "polygon" in detections.columns else F.lit(0)
    one = F.format_string("%s (%.3f): (%.1f, %.1f) - (%.1f, %.1f)", "class_name", "conf", "x1", "y1", "x2", "y2")
    each = detections.select("slide_id", F.lit(3).alias("part"), F.col("det_id").cast("bigint").alias("place"), F.when(points > 0, F.concat(one, F.lit(", "), points.cast("string"), F.lit(" points"))).otherwise(one).alias("line"))
    return own.union(total).union(label).union(each)


def vertex_step_counts(detections: DataFrame, n: int = 5) -> DataFrame:
    """The n most frequent differences between neighbouring vertices, with a flag for unit steps; a top-n report."""
    from ..functions.rings import vertex_steps

    steps = detections.select(F.explode(vertex_steps(F.col("polygon"))).alias("s")).select("s.dx", "s.dy")
    counts = steps.groupBy("dx", "dy").agg(F.count("*").alias("n"))
    return counts.withColumn("unit", F.col("dx").isin(-1.0, 0.0, 1.0) & F.col("dy").isin(-1.0, 0.0, 1.0)).orderBy(F.desc("n"), "dx", "dy").limit(n)
