"""The JSON documents and file listings around slides, as tables. Parquet is the table of record; JSON is for exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

POINT = "struct<x:double,y:double>"
PREDICTION = f"struct<class_name:string,confidence:double,box:struct<start:{POINT},`end`:{POINT}>,polygon:array<{POINT}>,simplification_metrics:struct<original_points:int,simplified_points:int,area_preserved:double,method:string>>"
PREDICTIONS = f"wsi_info struct<path:string,width:bigint,height:bigint,levels:int,mpp:double>, predictions array<{PREDICTION}>"
REGION = "struct<id:int,name:string,x_min:bigint,y_min:bigint,x_max:bigint,y_max:bigint,width:bigint,height:bigint>"
NUMBERED = f"struct<grid_id:int,original_id:int,name:string,center:array<double>,distance:double,region:{REGION},grid_position:string>"
ENVELOPES = f"biopsy_detection struct<biopsy_regions:array<{REGION}>>, manual_analysis struct<biopsy_regions:array<{REGION}>,recommended_grid:struct<step_x:int,step_y:int,cell_width:int,cell_height:int>>, simple_biopsy_analysis struct<biopsy_regions:array<{REGION}>,grid_parameters:struct<step_x:int,step_y:int>>, biopsy_grid struct<numbered_biopsies:array<{NUMBERED}>>"
EXTENSIONS = ("tiff", "tif", "svs", "ndpi")
#: Least confidence by a part of the model's name, the first that fits.
CONFIDENCES = (("lp", 0.5), ("mild", 0.6), ("moderate", 0.7))


def slide_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the slide files in a folder; contents are never read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{" + ",".join(EXTENSIONS) + "}").load(folder)
    return files.select("path", "length")


def least_confidence(stem: Column) -> Column:
    rule = F.lit(0.5)
    for part, conf in reversed(CONFIDENCES):
        rule = F.when(F.lower(stem).contains(part), conf).otherwise(rule)
    return rule


def models(spark: SparkSession, folder: str, window: int = 512) -> DataFrame:
    """(model_path, window_size, min_conf) of the model files in a folder; a missing folder raises."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pt").load(folder)
    return files.select(F.col("path").alias("model_path"), F.lit(window).alias("window_size"), least_confidence(F.regexp_extract("path", "([^/]*)\\.pt$", 1)).alias("min_conf"))


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """Detections of prediction documents, numbered by their place, with the document they are from."""
    docs = spark.read.schema(PREDICTIONS).json(path, multiLine=True).withColumn("source", F.col("_metadata.file_path"))
    rows = docs.select("source", "wsi_info", F.posexplode("predictions").alias("ord", "p"))
    return rows.select(
        "source", F.col("wsi_info.path").alias("path"), F.col("ord").cast("bigint").alias("det_ord"), F.col("p.class_name"), F.col("p.box.start.x").alias("x1"), F.col("p.box.start.y").alias("y1"), F.col("p.box.end.x").alias("x2"), F.col("p.box.end.y").alias("y2"), F.col("p.confidence").alias("conf"), F.col("p.polygon").alias("polygon")
    )


def regions(spark: SparkSession, path: str) -> DataFrame:
    """Regions of any of the four kinds of region documents, in their order, one table."""
    docs = spark.read.schema(ENVELOPES).json(path, multiLine=True).withColumn("source", F.col("_metadata.file_path"))
    numbered = F.transform("biopsy_grid.numbered_biopsies", lambda n: n["region"])
    every = F.coalesce("biopsy_detection.biopsy_regions", "manual_analysis.biopsy_regions", "simple_biopsy_analysis.biopsy_regions", numbered)
    return docs.select("source", F.posexplode(every).alias("region_ord", "r")).select("source", "region_ord", "r.*")


def grids(spark: SparkSession, path: str) -> DataFrame:
    """Grid steps of region documents that have them."""
    docs = spark.read.schema(ENVELOPES).json(path, multiLine=True)
    step = lambda c: F.coalesce(f"manual_analysis.recommended_grid.{c}", f"simple_biopsy_analysis.grid_parameters.{c}")
    return docs.select(step("step_x").alias("step_x"), step("step_y").alias("step_y")).where("step_x is not null")


def summary(spark: SparkSession, path: str) -> DataFrame:
    """(slide, file, predictions_count, avg_confidence, label_statistics) of a summary document; keys from _ on are not slides."""
    value = "struct<file:string,predictions_count:bigint,label_statistics:map<string,bigint>,avg_confidence:double>"
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("slide", "v"))
    return rows.where(~F.col("slide").startswith("_")).select("slide", "v.*")


def nested(detections: DataFrame, metrics: bool = False) -> DataFrame:
    """Detections in the nested shape of the documents; an empty polygon is left out."""
    p = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    polygon = F.when(F.coalesce(F.size("polygon"), F.lit(0)) > 0, F.col("polygon")) if "polygon" in detections.columns else F.lit(None).cast(f"array<{POINT}>")
    cols = [F.col("class_name"), F.col("conf").alias("confidence"), F.struct(p("x1", "y1").alias("start"), p("x2", "y2").alias("end")).alias("box"), polygon.alias("polygon")]
    if metrics:
        cols.append(F.col("simplification_metrics"))
    return detections.select("slide_id", "det_id", F.struct(*cols).alias("prediction"))


def write_predictions(detections: DataFrame, folder: str, metrics: bool = False) -> None:
    """One JSON line per detection, in folders by slide: a slide of any number of detections is no one document in memory."""
    nested(detections, metrics).select("slide_id", "det_id", "prediction.*").write.partitionBy("slide_id").json(folder)


def documents(detections: DataFrame, slides: DataFrame) -> DataFrame:
    """(slide_id, json): the prediction document of each slide, for slides whose detections fit one document."""
    rows = nested(detections).groupBy("slide_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("det_id", "prediction"))), lambda r: r["prediction"]).alias("predictions"))
    info = F.struct(*[c for c in ("path", "width", "height", "levels", "mpp") if c in slides.columns]).alias("wsi_info")
    met = slides.select("slide_id", info).join(rows, "slide_id", "left")
    return met.select("slide_id", F.to_json(F.struct("wsi_info", F.coalesce("predictions", F.array()).alias("predictions"))).alias("json"))


def summaries(detections: DataFrame, slides: DataFrame) -> DataFrame:
    """(slide, file, predictions_count, label_statistics, avg_confidence) of every slide, those without detections too."""
    from ..operators.report import slide_statistics

    by = slide_statistics(detections, slides)
    name = F.regexp_extract("path", "([^/]*)$", 1)
    met = slides.select("slide_id", name.alias("file")).join(by, "slide_id")
    return met.select(F.regexp_replace("file", "(?<=.)\\.[^.]*$", "").alias("slide"), "file", F.col("total").alias("predictions_count"), F.coalesce("by_class", F.create_map().cast("map<string,bigint>")).alias("label_statistics"), F.col("average_confidence").alias("avg_confidence"))


def region_documents(numbered: DataFrame) -> DataFrame:
    """(slide_id, json): the grid document of each slide, from regions numbered by their distance from the origin."""
    region = F.struct("id", "name", "x_min", "y_min", "x_max", "y_max", "width", "height").alias("region")
    one = F.struct("grid_id", F.col("id").alias("original_id"), "name", F.array("center_x", "center_y").alias("center"), "distance", region, "grid_position")
    rows = numbered.groupBy("slide_id").agg(F.sort_array(F.collect_list(one)).alias("numbered_biopsies"), F.count("*").alias("total_biopsies"))
    return rows.select("slide_id", F.to_json(F.struct(F.struct("total_biopsies", "numbered_biopsies").alias("biopsy_grid"))).alias("json"))
