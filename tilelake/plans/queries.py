"""Queries over the driver's tables, one per operator, with the same in DuckDB's SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import boxes, rings
from ..operators import drawing, filters, merge, pixels as px, regions, report, spatial, suppress, tiling
from ..operators.graph import shared_dir
from ..schemas import rectangle
from ..sources import documents, files, tiff
from ..sources.views import detections, table
from . import pipeline

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

BASE = "b as (select event_id, event_type, value, cast(floor(event_id/8.0) as bigint) g from events)"
NAME = "case event_type when 'error' then 'excl' when 'signup' then 'lp' when 'purchase' then 'mild' when 'click' then 'moderate' else 'background' end as class_name"
DET = f"""{BASE}, det as (select event_id as det_id, g%20 as slide_id, {NAME},
 cast((g*7919)%15872 + (event_id%8)*9 as double) as x1, cast((g*10007)%15872 + (event_id%8)*5 as double) as y1,
 cast((g*7919)%15872 + (event_id%8)*9 + 8+(event_id*31)%180 as double) as x2, cast((g*10007)%15872 + (event_id%8)*5 + 8+(event_id*17)%180 as double) as y2,
 0.3+value/1000 as conf from b)"""
TIGHT = f"""{BASE}, det as (select event_id as det_id, g%20 as slide_id, {NAME},
 cast((g*7919)%15872 + (event_id%8)*2 as double) as x1, cast((g*10007)%15872 + (event_id%8) as double) as y1,
 cast((g*7919)%15872 + (event_id%8)*2 + 60+(event_id*31)%20 as double) as x2, cast((g*10007)%15872 + (event_id%8) + 60+(event_id*17)%20 as double) as y2,
 0.3+value/1000 as conf from b)"""
SLIDES = "slides as (select s_suppkey as slide_id, 1000 + (s_suppkey*7919)%9000 as width, 400 + (s_suppkey*10007)%6000 as height from supplier)"
REGIONS = """regions as (select c_custkey%20 as slide_id, cast(c_custkey as int) as region_ord, cast(c_custkey as int) as id, c_name as name, (c_custkey*7919)%14000 as x_min, (c_custkey*10007)%14000 as y_min,
 (c_custkey*7919)%14000 + 500 + c_custkey%700 as x_max, (c_custkey*10007)%14000 + 500 + c_custkey%900 as y_max, 500 + c_custkey%700 as width, 500 + c_custkey%900 as height from customer)"""
INTER = "greatest(0, least(a.x2,b.x2)-greatest(a.x1,b.x1))*greatest(0, least(a.y2,b.y2)-greatest(a.y1,b.y1))"
IOU = f"({INTER})/((a.x2-a.x1)*(a.y2-a.y1)+(b.x2-b.x1)*(b.y2-b.y1)-({INTER}))"


def det(spark: SparkSession, sf_dir: str, tight: bool = False) -> DataFrame:
    return detections(table(spark, sf_dir, "events"), tight)


def slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(k.alias("slide_id"), (1000 + k * 7919 % 9000).alias("width"), (400 + k * 10007 % 6000).alias("height"))


def region_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    x, y, w, h = k * 7919 % 14000, k * 10007 % 14000, 500 + k % 700, 500 + k % 900
    return table(spark, sf_dir, "customer").select((k % 20).alias("slide_id"), k.cast("int").alias("region_ord"), k.cast("int").alias("id"), F.col("c_name").alias("name"), x.alias("x_min"), y.alias("y_min"), (x + w).alias("x_max"), (y + h).alias("y_max"), w.alias("width"), h.alias("height"))


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


BOXES = "det_id, slide_id, class_name, x1, y1, x2, y2"


@query(f"with {DET} select {BOXES}, round(conf,6) as conf from det")
def detections_view(s, d):
    return det(s, d).select(*BOXES.split(", "), F.round("conf", 6).alias("conf"))


@query(f"with {DET} select {BOXES} from det where x2-x1 >= 20 and y2-y1 >= 20")
def size_filter(s, d):
    return det(s, d).where(filters.large_enough()).select(*BOXES.split(", "))


@query(f"with {DET} select {BOXES} from det where (x2-x1)*(y2-y1) between 100 and 50000")
def area_band(s, d):
    return det(s, d).where(filters.area_band()).select(*BOXES.split(", "))


@query(f"with {TIGHT}, k as (select *, max(case when class_name <> 'excl' then 1 else 0 end) over (partition by slide_id, floor(x1/512), floor(y1/512)) o from det) select {BOXES} from k where o = 1")
def cell_filter(s, d):
    return filters.cells_beyond(det(s, d, True)).select(*BOXES.split(", "))


@query(f"with {DET} select {BOXES} from det where class_name <> 'excl'")
def drop_excl(s, d):
    return det(s, d).where(filters.not_class()).select(*BOXES.split(", "))


@query(f"with {DET} select {BOXES} from det where lower(class_name) <> 'background'")
def drop_background(s, d):
    return det(s, d).where(filters.not_background()).select(*BOXES.split(", "))


@query(f"with {DET} select {BOXES} from det where not (class_name = 'lp' and case when det_id%3 = 0 then 0 else cast(3+det_id%9 as int) end between 1 and 7)")
def drop_short(s, d):
    ring = F.when(F.col("det_id") % 3 > 0, F.array_repeat(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), (3 + F.col("det_id") % 9).cast("int")))
    return det(s, d).withColumn("polygon", ring).where(filters.not_short()).select(*BOXES.split(", "))


@query(f"with {DET} select {BOXES} from det where floor(x1/512)*512 < 8000 and floor(y1/512)*512 < 8000")
def extraction_window(s, d):
    return det(s, d).where(filters.in_window(8000)).select(*BOXES.split(", "))


@query(f"with {DET}, m as (select * from (values ('lp', 0.5), ('mild', 0.6), ('moderate', 0.7), ('excl', 0.5), ('background', 0.5)) t(class_name, min_conf)) select {BOXES} from det join m using (class_name) where conf >= min_conf")
def model_confidence(s, d):
    names = s.range(1).select(F.explode(F.array(*map(F.lit, ("lp", "mild", "moderate", "excl", "background")))).alias("class_name"))
    models = names.select("class_name", documents.least_confidence(F.col("class_name")).alias("min_conf"))
    return filters.confident(det(s, d), models, "class_name").select(*BOXES.split(", "))


@query(f"with {SLIDES} select slide_id, cast(x as bigint) as x, cast(y as bigint) as y, 512 as size from slides, lateral (select unnest(range(0, height-511, 256)) as y), lateral (select unnest(range(0, width-511, 256)) as x) where width >= 512 and height >= 512")
def tile_grid(s, d):
    return tiling.grid(slides(s, d), 512, 0.5)


@query(f"with {SLIDES} select slide_id, cast(case when width >= 512 and height >= 512 then (floor((width-512)/256)+1)*(floor((height-512)/256)+1) else 0 end as bigint) as n_tiles from slides")
def tile_count(s, d):
    return slides(s, d).select("slide_id", tiling.tile_count(512, 0.5).alias("n_tiles"))


@query(f"with {SLIDES}, t as (select slide_id, cast(x as bigint) as x, cast(y as bigint) as y from slides, lateral (select unnest(range(0, height-511, 512)) as y), lateral (select unnest(range(0, width-511, 512)) as x) where width >= 512 and height >= 512) select slide_id, x, y, row_number() over (partition by slide_id order by y, x)-1 as patch_id from t")
def tile_number(s, d):
    return tiling.numbered(tiling.grid(slides(s, d), 512)).select("slide_id", "x", "y", "patch_id")


@query(f"with {SLIDES}, {REGIONS}, t as (select slide_id, cast(x as bigint) as x, cast(y as bigint) as y from slides, lateral (select unnest(range(0, height-255, 128)) as y), lateral (select unnest(range(0, width-255, 128)) as x) where width >= 256 and height >= 256) select distinct t.slide_id, x, y, 256 as size from t join regions r on t.slide_id = r.slide_id and x >= x_min and y >= y_min and x <= x_max-256 and y <= y_max-256")
def tile_region(s, d):
    return tiling.grid(slides(s, d), 256, 0.5, regions=region_table(s, d))


@query(f"with {DET} select a.slide_id, a.class_name, a.det_id as a, b.det_id as b, round({IOU}, 9) as iou from det a join det b on a.slide_id = b.slide_id and a.class_name = b.class_name and a.det_id < b.det_id where {IOU} > 0.5")
def iou_pairs(s, d):
    return spatial.iou_pairs(det(s, d)).withColumn("iou", F.round("iou", 9))


@query(f"with {DET} select det_id, (x2-x1)*(y2-y1) as area, (x1+x2)/2 as cx, (y1+y2)/2 as cy, cast(floor(x1/512) as bigint) as i, cast(floor(y1/512) as bigint) as j from det")
def box_measures(s, d):
    cx, cy = boxes.center()
    return det(s, d).select("det_id", boxes.area().alias("area"), cx.alias("cx"), cy.alias("cy"), boxes.cell("x1", 512).alias("i"), boxes.cell("y1", 512).alias("j"))


@query(f"with {DET} select a.det_id, least(a.x1,b.x1) as x1, least(a.y1,b.y1) as y1, greatest(a.x2,b.x2) as x2, greatest(a.y2,b.y2) as y2 from det a join det b on b.det_id = a.det_id+1 and a.slide_id = b.slide_id where {INTER} > 0")
def box_union(s, d):
    a, b = spatial.prefixed(det(s, d), "a_"), spatial.prefixed(det(s, d), "b_")
    met = a.join(b, (F.col("b_det_id") == F.col("a_det_id") + 1) & (F.col("a_slide_id") == F.col("b_slide_id"))).where(boxes.intersects("a_", "b_"))
    return met.select(F.col("a_det_id").alias("det_id"), *boxes.union("a_", "b_"))


def nms_sql(view: str, threshold: float) -> str:
    inter = "greatest(0, least(k.x2,b.x2)-greatest(k.x1,b.x1))*greatest(0, least(k.y2,b.y2)-greatest(k.y1,b.y1))"
    over = f"({inter}) > {threshold}*((k.x2-k.x1)*(k.y2-k.y1)+(b.x2-b.x1)*(b.y2-b.y1)-({inter}))".replace("b.", "x[1].")
    return f"""with {view}, g as (select list([struct_pack(det_id := det_id, x1 := x1, y1 := y1, x2 := x2, y2 := y2)] order by conf desc, det_id) as l from det group by slide_id, class_name),
 r as (select list_reduce(l, lambda acc, x: case when len(list_filter(acc, lambda k: {over})) > 0 then acc else list_concat(acc, x) end) as kept from g) select unnest(kept).det_id as det_id from r"""


@query(nms_sql(DET, 0.5))
def nms_050(s, d):
    return suppress.suppressed(det(s, d), 0.5).select("det_id")


@query(nms_sql(TIGHT, 0.7))
def nms_070(s, d):
    return suppress.suppressed(det(s, d, True), 0.7).select("det_id")


HIT = "greatest(0, least(k.x2,x[1].x2)-greatest(k.x1,x[1].x1))*greatest(0, least(k.y2,x[1].y2)-greatest(k.y1,x[1].y1))"
FIRST = f"list_position(list_transform(acc, lambda k: ({HIT}) > 0.5*((k.x2-k.x1)*(k.y2-k.y1)+(x[1].x2-x[1].x1)*(x[1].y2-x[1].y1)-({HIT}))), true)"
GROWN = "struct_pack(det_id := k.det_id, x1 := least(k.x1,x[1].x1), y1 := least(k.y1,x[1].y1), x2 := greatest(k.x2,x[1].x2), y2 := greatest(k.y2,x[1].y2), conf := greatest(k.conf,x[1].conf), n := k.n+1)"


@query(f"""with {TIGHT}, g as (select slide_id, class_name, list([struct_pack(det_id := det_id, x1 := x1, y1 := y1, x2 := x2, y2 := y2, conf := conf, n := cast(1 as bigint))] order by conf desc, det_id) as l from det group by 1, 2),
 r as (select slide_id, class_name, unnest(list_reduce(l, lambda acc, x: case when coalesce({FIRST}, 0) = 0 then list_concat(acc, x) else list_transform(acc, lambda k, i: case when i = {FIRST.replace('lambda k:', 'lambda m:').replace('k.', 'm.')} then {GROWN} else k end) end)) as m from g)
 select slide_id, class_name, m.det_id as det_id, m.x1 as x1, m.y1 as y1, m.x2 as x2, m.y2 as y2, m.conf as conf, m.n as n_merged from r""")
def box_merge(s, d):
    return suppress.merged_boxes(det(s, d, True), 0.5)


@query(f"with {DET}, r as (select *, row_number() over (partition by slide_id, class_name order by conf desc, det_id) rn from det) select {BOXES} from r where rn <= 10")
def detector_topk(s, d):
    return filters.top_by_confidence(det(s, d), ["slide_id", "class_name"], 10).select(*BOXES.split(", "))


@query(f"""with recursive {DET}, e as (select a.det_id as u, b.det_id as v from det a join det b on a.slide_id = b.slide_id and a.class_name = b.class_name and a.det_id <> b.det_id where {INTER} > 0),
 c(det_id, root) as (select det_id, det_id from det union select e.v, c.root from c join e on e.u = c.det_id where c.root < e.v) select det_id, min(root) as component from c group by det_id""")
def box_components(s, d):
    return merge.box_components(det(s, d))


@query(f"with {DET}, k as (select *, max(case when class_name <> 'excl' then 1 else 0 end) over (partition by slide_id, floor(x1/512), floor(y1/512)) o from det where x2-x1 >= 20 and y2-y1 >= 20) select slide_id, class_name, count(*) as n, round(avg(conf),9) as mean_conf from k where o = 1 group by all")
def class_stats(s, d):
    return pipeline.minimum(det(s, d)).withColumn("mean_conf", F.round("mean_conf", 9))


@query(f"with {DET} select slide_id, count(*) as total, round(avg(conf),9) as average_confidence, count(*) filter (where class_name='lp') as lp, count(*) filter (where class_name='excl') as excl from det group by slide_id")
def slide_stats(s, d):
    out = report.slide_statistics(det(s, d))
    of = lambda c: F.coalesce(F.element_at("by_class", F.lit(c)), F.lit(0)).alias(c)
    return out.select("slide_id", "total", F.round("average_confidence", 9).alias("average_confidence"), of("lp"), of("excl"))


@query(f"with {DET} select slide_id, class_name, count(*) as n, round(avg(conf),9) as mean_conf, grouping(slide_id)*2+grouping(class_name) as level from det group by rollup(slide_id, class_name)")
def slide_label_rollup(s, d):
    return report.label_rollup(det(s, d)).withColumn("mean_conf", F.round("mean_conf", 9))


@query(f"with {DET} select class_name, count(*) as n, count(distinct slide_id) as n_slides from det group by class_name")
def label_totals(s, d):
    return report.label_totals(det(s, d))


@query(f"with {DET}, v as (select class_name, (x2-x1)*(y2-y1) as v from det), m as (select class_name, min(v) lo, max(v) hi from v group by 1) select class_name, cast(case when hi > lo then least(floor((v-lo)*20/(hi-lo)), 19) else 0 end as int) as bin, count(*) as n from v join m using (class_name) group by 1, 2")
def class_histogram(s, d):
    return report.histogram(det(s, d), boxes.area())


@query(f"with {DET} select class_name, count(*) as n, round(avg(conf),9) as mean_conf, round(avg((x2-x1)*(y2-y1)),6) as mean_area from det group by 1")
def class_means(s, d):
    return report.class_means(det(s, d)).withColumns({"mean_conf": F.round("mean_conf", 9), "mean_area": F.round("mean_area", 6)})


@query(f"with {DET}, a as (select class_name, count(*) f from det where x2-x1 >= 20 and y2-y1 >= 20 and lower(class_name) <> 'background' group by 1) select class_name, count(*) as original, coalesce(max(f),0) as filtered, count(*)-coalesce(max(f),0) as removed, round((count(*)-coalesce(max(f),0))/count(*),9) as ratio from det left join a using (class_name) group by 1")
def filter_stats(s, d):
    rows = det(s, d)
    return report.filter_statistics(rows, rows.where(filters.large_enough() & filters.not_background())).withColumn("ratio", F.round("ratio", 9))


@query(f"with {DET} select slide_id, cast(floor(x1/512) as bigint) as i, cast(floor(y1/512) as bigint) as j, count(*) as n, min(det_id) as first_det_id from det where class_name <> 'excl' group by 1,2,3 order by n desc, first_det_id limit 50")
def cell_topk(s, d):
    return report.cells_ranked(det(s, d), 50)


@query(f"with {DET} select slide_id, cast(floor(x1/512) as bigint) as i, cast(floor(y1/512) as bigint) as j, count(*) as n, min(det_id) as first_det_id from det group by 1,2,3 order by first_det_id limit 50")
def first_cells(s, d):
    return report.first_cells(det(s, d), 50)


@query(f"with {DET} select slide_id, cast(floor(x1/512) as bigint) as i, cast(floor(y1/512) as bigint) as j, count(*) as n, string_agg(distinct class_name, ',' order by class_name) as classes from det group by 1,2,3")
def cell_class_set(s, d):
    return report.cell_classes(det(s, d))


@query(f"with {DET} select det_id, cast(floor(x1/512) as bigint) as i, cast(floor(y1/512) as bigint) as j, x1-floor(x1/512)*512 as x1, y1-floor(y1/512)*512 as y1, x2-floor(x1/512)*512 as x2, y2-floor(y1/512)*512 as y2 from det")
def tile_relative(s, d):
    return report.tile_relative(det(s, d)).select("det_id", "i", "j", "x1", "y1", "x2", "y2")


REPORT = "list_value('Crypts','Muscularis mucosae','Surface epithelium','moderate_segmentation','Mild','excl','other')[cast(det_id%7 as int)+1]"
COLOUR = "case class_name when 'Crypts' then '#FF6B6B' when 'Muscularis mucosae' then '#4ECDC4' when 'Surface epithelium' then '#45B7D1' when 'moderate_segmentation' then '#96CEB4' when 'Mild' then '#FFEAA7' when 'excl' then '#DDA0DD' else '#000000' end"


def report_classes(rows: DataFrame) -> DataFrame:
    """Detections under the names of the report's classes, and one that it does not know."""
    names = F.array(*map(F.lit, (*report.COLOURS, "other")))
    return rows.withColumn("class_name", F.get(names, (F.col("det_id") % 7).cast("int")))


@query(f"with {DET}, c as (select * replace ({REPORT} as class_name) from det) select det_id, {COLOUR} as colour, 'slide' || slide_id || '_' || cast(floor(x1/512) as bigint) || '_' || cast(floor(y1/512) as bigint) || '.png' as tile from c")
def class_colour(s, d):
    rows = report.coloured(report_classes(det(s, d))).withColumns({"path": F.concat(F.lit("/data/slide"), F.col("slide_id").cast("string"), F.lit(".tiff")), "i": boxes.cell("x1", 512), "j": boxes.cell("y1", 512)})
    return rows.select("det_id", "colour", report.tile_name().alias("tile"))


@query(f"with {DET} select det_id, case when det_id%6 < 5 then ['a','b','c','d','e'][cast(det_id%6 as int)+1] else 'class_5' end as class_name from det")
def class_naming(s, d):
    classes = s.range(1).select(F.inline(F.array(*[F.struct(F.lit("m").alias("model_path"), F.lit(i).cast("bigint").alias("class_id"), F.lit(n).alias("class_name")) for i, n in enumerate("abcde")])))
    rows = det(s, d).select("det_id", F.lit("m").alias("model_path"), (F.col("det_id") % 6).alias("class_id"))
    return report.class_named(rows, classes).select("det_id", "class_name")


@query(f"with {DET}, {REGIONS}, m as (select det_id, id, row_number() over (partition by det_id order by region_ord nulls last) rn from det left join regions r on det.slide_id = r.slide_id and x1 between x_min and x_max and y1 between y_min and y_max) select det_id, id as region from m where rn = 1")
def point_in_region(s, d):
    return spatial.in_regions(det(s, d), region_table(s, d), "det_id", "x1", "y1", 2048).select("det_id", F.col("r_id").alias("region"))


@query(f"with {REGIONS}, n as (select *, row_number() over (partition by slide_id order by sqrt(((x_min+x_max)/2.0)*((x_min+x_max)/2.0)+((y_min+y_max)/2.0)*((y_min+y_max)/2.0)), region_ord) as grid_id, count(*) over (partition by slide_id) c from regions) select slide_id, id, grid_id, '(' || cast(floor((grid_id-1)/case when c <= 6 then 3 else 2 end)+1 as bigint) || ', ' || ((grid_id-1)%(case when c <= 6 then 3 else 2 end)+1) || ')' as grid_position from n")
def region_renumber(s, d):
    return regions.renumbered(region_table(s, d)).select("slide_id", "id", F.col("grid_id").cast("bigint").alias("grid_id"), "grid_position")


@query(f"with {REGIONS}, n as (select *, row_number() over (partition by slide_id order by sqrt(((x_min+x_max)/2.0)*((x_min+x_max)/2.0)+((y_min+y_max)/2.0)*((y_min+y_max)/2.0)), region_ord) as grid_id from regions) select slide_id, id, name from n where grid_id = 2")
def region_select(s, d):
    return regions.by_id(regions.renumbered(region_table(s, d), grid=False), 2, "grid_id").select("slide_id", "id", "name")


@query(f"with {REGIONS} select slide_id, count(*) as n_regions, cast(sum(width*height) as bigint) as total_area, round(avg(width),6) as mean_width, round(avg(height),6) as mean_height, count(*) as speed_up, '512x512' as grid from regions group by 1")
def region_stats(s, d):
    return regions.statistics(region_table(s, d), 512, 512).withColumns({"mean_width": F.round("mean_width", 6), "mean_height": F.round("mean_height", 6)})


@query(f"with {REGIONS} select slide_id, count(*) as n_regions, count(*) as speed_up, round(100-100.0/count(*),1) as time_reduction, 1 as recommended_id, coalesce(max(name) filter (where id = 1), 'N/A') as recommended_name, '700' as grid_step, '700x900' as cell_size from regions group by 1")
def region_recommendations(s, d):
    return regions.recommendations(region_table(s, d), 700, (700, 900))


@query(f"with {DET} select slide_id, cast(det_id%5 as bigint) as cluster, cast(det_id%5+1 as int) as id, 'Биоптат ' || (det_id%5+1) as name, min(x1) as x_min, min(y1) as y_min, max(x2) as x_max, max(y2) as y_max, (max(x2)-min(x1))*(max(y2)-min(y1)) as area, count(*) as component_count, max(x2)-min(x1) as width, max(y2)-min(y1) as height from det group by 1, 2, 3, 4")
def region_bounds(s, d):
    rows = det(s, d).select("slide_id", (F.col("det_id") % 5).alias("cluster"), F.col("x1").alias("x_min"), F.col("y1").alias("y_min"), F.col("x2").alias("x_max"), F.col("y2").alias("y_max"))
    return regions.bounds(rows)


@query(f"with {REGIONS}, {SLIDES}, m as (select r.slide_id, id, x_min%1024 as x, y_min%1024 as y, r.width as w, r.height as h, s.width/1024.0 as sx, s.height/1024.0 as sy from regions r join slides s on r.slide_id = s.slide_id) select slide_id, id, cast(trunc(x*sx) as bigint) as x_min, cast(trunc(y*sy) as bigint) as y_min, cast(trunc((x+w)*sx) as bigint) as x_max, cast(trunc((y+h)*sy) as bigint) as y_max, cast(trunc(w*sx) as bigint) as width, cast(trunc(h*sy) as bigint) as height, cast(trunc(cast(w*h as double)*sx*sy) as bigint) as area from m")
def region_scaled(s, d):
    x, y = F.col("x_min") % 1024, F.col("y_min") % 1024
    rows = region_table(s, d).withColumns({"x_min": x, "y_min": y, "x_max": x + F.col("width"), "y_max": y + F.col("height")})
    return regions.scaled(rows, slides(s, d)).select("slide_id", "id", "x_min", "y_min", "x_max", "y_max", "width", "height", "area")


@query(f"with {REGIONS} select slide_id, id, cast(i as bigint) as i, cast(j as bigint) as j from regions, lateral (select unnest(range(cast(floor(x_min/512) as bigint), cast(floor((x_max-1)/512) as bigint)+1)) as i), lateral (select unnest(range(cast(floor(y_min/512) as bigint), cast(floor((y_max-1)/512) as bigint)+1)) as j)")
def region_mask_cells(s, d):
    return regions.mask_cells(region_table(s, d))


@query(f"with {DET} select det_id, cast(floor(x1/700) as bigint) as i, cast(floor(y1/900) as bigint) as j from det")
def region_grid_cell(s, d):
    return det(s, d).select("det_id", *regions.grid_cell("x1", "y1", 700, 900))


@query(f"with {DET} select det_id, round((x2-x1)*(y2-y1),6) as area, round(2*((x2-x1)+(y2-y1)),6) as perimeter, x1, y1, x2, y2 from det")
def polygon_area_perimeter(s, d):
    ring = F.col("polygon")
    rows = det(s, d).withColumn("polygon", rectangle())
    return rows.select("det_id", F.round(rings.area(ring), 6).alias("area"), F.round(rings.perimeter(ring), 6).alias("perimeter"), *rings.bounds(ring))


HEXAGON = f"""{DET}, p as (select det_id, i, x, y from det, lateral (values (0, x1, y1), (2, (x1+x2)/2, y1-det_id%5), (4, x2, y1), (6, x2+det_id%7, (y1+y2)/2), (8, x2, y2), (10, x1, y2), (12, x1, y1)) t(i, x, y)),
 m as (select det_id, i+1 as i, (x+lead(x) over w)/2 as x, (y+lead(y) over w)/2 as y from p window w as (partition by det_id order by i)),
 h as (select * from p union all select * from m where i < 12 and det_id%3 = 2),
 e as (select *, lag(x) over w as px, lag(y) over w as py, lead(x) over w as nx, lead(y) over w as ny from h window w as (partition by det_id order by i))"""


@query(f"""with {HEXAGON}, f as (select d.det_id, count(*) as n_points, abs(sum((px-d.x1)*(y-d.y1)-(x-d.x1)*(py-d.y1)))/2 as a, sum(sqrt((x-px)*(x-px)+(y-py)*(y-py))) as p,
 avg(case when px is not null and nx is not null and sqrt((nx-px)*(nx-px)+(ny-py)*(ny-py)) > 0 then abs((nx-px)*(py-y)-(px-x)*(ny-py))/sqrt((nx-px)*(nx-px)+(ny-py)*(ny-py)) end) as far from e join det d on d.det_id = e.det_id group by 1)
 select det_id, n_points, round(4*pi()*a/(p*p),7) as compactness, round(p/sqrt(a),7) as complexity, round(far/sqrt(a),7) as roughness, n_points < 10 as is_simple, n_points > 100 as is_complex from f""")
def polygon_shape_metrics(s, d):
    rows = det(s, d).withColumn("polygon", _hexagon()).select("det_id", rings.metrics(F.col("polygon")).alias("m"))
    return rows.select("det_id", F.col("m.n_points").cast("long").alias("n_points"), *[F.round(f"m.{c}", 7).alias(c) for c in ("compactness", "complexity", "roughness")], "m.is_simple", "m.is_complex")


@query(f"with {HEXAGON} select det_id, count(*) as n_key, round(sum(x),6) as x, round(sum(y),6) as y from e where px is null or nx is null or degrees(acos(greatest(-1, least(1, ((px-x)*(nx-x)+(py-y)*(ny-y))/(sqrt((px-x)*(px-x)+(py-y)*(py-y))*sqrt((nx-x)*(nx-x)+(ny-y)*(ny-y))))))) < 165 group by 1")
def polygon_key_points(s, d):
    key = F.col("key")
    total = lambda c: F.round(F.aggregate(key, F.lit(0.0), lambda a, v: a + v[c]) + key[0][c], 6).alias(c)
    # the closed ring ends with its first vertex again
    return det(s, d).withColumn("polygon", _hexagon()).select("det_id", rings.key_points(F.col("polygon")).alias("key")).select("det_id", (F.size(key) + 1).cast("long").alias("n_key"), total("x"), total("y"))


@query(f"with {DET}, v as (select unnest([struct_pack(dx := x2-x1, dy := 0.0), struct_pack(dx := 0.0, dy := y2-y1), struct_pack(dx := x1-x2, dy := 0.0)]) as s from det), c as (select s.dx as dx, s.dy as dy, count(*) as n from v group by 1,2) select dx, dy, n, dx in (-1,0,1) and dy in (-1,0,1) as unit from c order by n desc, dx, dy limit 5")
def vertex_steps(s, d):
    return report.vertex_step_counts(det(s, d).withColumn("polygon", rectangle()))


@query(f"with {DET}, v as (select det_id, slide_id, x1+slide_id as x1, y1+2 as y1 from det) select det_id, x1, y1 from v")
def tile_translate(s, d):
    return det(s, d).withColumns(boxes.shifted(F.col("slide_id"), F.lit(2))).select("det_id", "x1", "y1")


@query("with r as (select p_brand as method, cast(count(*) as bigint) as tiles, cast(sum(p_size) as bigint) as predictions, cast(sum(p_retailprice) as double) as seconds from part group by 1) select method, round(tiles/seconds,9) as tiles_per_s, round(predictions/seconds,9) as predictions_per_s, round((select seconds from r where method = (select min(method) from r))/seconds,9) as speed_up, seconds = (select min(seconds) from r) as fastest from r")
def run_comparison(s, d):
    runs = table(s, d, "part").groupBy(F.col("p_brand").alias("method")).agg(F.count("*").alias("tiles"), F.sum("p_size").alias("predictions"), F.sum("p_retailprice").alias("seconds"))
    base = runs.agg(F.min("method")).first()[0]
    return report.run_comparison(runs, base).select("method", *[F.round(c, 9).alias(c) for c in ("tiles_per_s", "predictions_per_s", "speed_up")], "fastest")


@query(f"with {SLIDES}, {TIGHT}, m as (select * from (values ('lp', 512), ('mild', 512), ('big', 1024)) t(model_path, window_size)), t as (select slide_id, case when slide_id%2 = 0 then 512 else 1024 end as size from slides) select slide_id, size, model_path from t join m on size = window_size")
def tiles_models(s, d):
    models = s.range(1).select(F.inline(F.array(*[F.struct(F.lit(n).alias("model_path"), F.lit(w).alias("window_size")) for n, w in (("lp", 512), ("mild", 512), ("big", 1024))])))
    tiles = slides(s, d).select("slide_id", F.when(F.col("slide_id") % 2 == 0, 512).otherwise(1024).alias("size"))
    return filters.of_models(tiles, models).select("slide_id", "size", "model_path")


TOUCH = "least(a.x2,b.x2) >= greatest(a.x1,b.x1) and least(a.y2,b.y2) >= greatest(a.y1,b.y1) and (least(a.x2,b.x2) > greatest(a.x1,b.x1) or least(a.y2,b.y2) > greatest(a.y1,b.y1))"


@query(f"""with recursive {DET}, e as (select a.det_id as u, b.det_id as v from det a join det b on a.slide_id = b.slide_id and a.class_name = b.class_name and a.det_id <> b.det_id where {TOUCH}),
 c(det_id, root) as (select det_id, det_id from det union select e.v, c.root from c join e on e.u = c.det_id where c.root < e.v),
 m as (select det.*, root from det join (select det_id, min(root) as root from c group by 1) using (det_id)), n as (select slide_id, class_name, count(*) as n from det group by all),
 xs as (select root, x, lead(x) over (partition by root order by x) as nx from (select root, x1 as x from m union select root, x2 from m)), ys as (select root, y, lead(y) over (partition by root order by y) as ny from (select root, y1 as y from m union select root, y2 from m)),
 f as (select distinct xs.root, x, nx, y, ny from xs join ys on xs.root = ys.root join m on m.root = xs.root and x1 <= x and nx <= x2 and y1 <= y and ny <= y2), s as (select root, sum((nx-x)*(ny-y)) as area from f group by 1)
 select root as det_id, slide_id, class_name, min(x1) as x1, min(y1) as y1, max(x2) as x2, max(y2) as y2, case when any_value(n) = 1 then round(max(conf),6) else 0.8 end as conf, round(any_value(area),6) as area from m join s using (root) join n using (slide_id, class_name) group by 1, 2, 3""")
def polygon_union(s, d):
    found = merge.united(det(s, d).withColumn("polygon", rectangle()))
    return found.select(*BOXES.split(", "), F.round("conf", 6).alias("conf"), F.round("area", 6).alias("area"))


#: Least area of a piece in ``large_unions``.
LEAST_PIECE = 8000


@query(f"""with t as ({ORACLE_SQL["polygon_union"]}), {DET}, n as (select slide_id, class_name, count(*) as n from det group by all), g as (select slide_id, class_name, max(area) as most from t group by all)
 select t.* from t join n using (slide_id, class_name) where n = 1 or area >= {LEAST_PIECE}
 union all select {BOXES}, round(conf,6), round((x2-x1)*(y2-y1),6) from det join n using (slide_id, class_name) join g using (slide_id, class_name) where n > 1 and most < {LEAST_PIECE}""")
def large_unions(s, d):
    found = merge.united(det(s, d).withColumn("polygon", rectangle()), LEAST_PIECE)
    return found.select(*BOXES.split(", "), F.round("conf", 6).alias("conf"), F.round("area", 6).alias("area"))


HELD = "(greatest(0, least(k.x2,x[1].x2)-greatest(k.x1,x[1].x1))*greatest(0, least(k.y2,x[1].y2)-greatest(k.y1,x[1].y1)))/((x[1].x2-x[1].x1)*(x[1].y2-x[1].y1))"


@query(f"""with {TIGHT}, g as (select list([struct_pack(det_id := det_id, x1 := x1, y1 := y1, x2 := x2, y2 := y2)] order by (x2-x1)*(y2-y1) desc, det_id) as l from det where class_name = 'lp' group by slide_id),
 r as (select unnest(list_reduce(l, lambda acc, x: case when len(list_filter(acc, lambda k: {HELD} > 0.8)) > 0 then acc else list_concat(acc, x) end)).det_id as det_id from g)
 select {BOXES}, conf from det where class_name <> 'lp' or det_id in (select det_id from r)""")
def nested_filter(s, d):
    return merge.without_nested(det(s, d, True).withColumn("polygon", rectangle())).drop("polygon")


def _arms(p: str) -> list[tuple[str, str, str, str]]:
    """The two rectangles of the ring that ``_angle`` lays into a box."""
    mx, my = f"({p}x1+{p}x2)/2", f"({p}y1+{p}y2)/2"
    return [(f"{p}x1", f"{p}y1", f"{p}x2", my), (f"{p}x1", my, mx, f"{p}y2")]


ANGLES = "+".join(f"greatest(0, least({a[2]},{b[2]})-greatest({a[0]},{b[0]}))*greatest(0, least({a[3]},{b[3]})-greatest({a[1]},{b[1]}))" for a in _arms("k.") for b in _arms("x[1]."))


@query(f"""with {TIGHT}, g as (select list([struct_pack(det_id := det_id, x1 := x1, y1 := y1, x2 := x2, y2 := y2)] order by (x2-x1)*(y2-y1) desc, det_id) as l from det where class_name in ('lp', 'mild') group by slide_id, class_name),
 r as (select unnest(list_reduce(l, lambda acc, x: case when len(list_filter(acc, lambda k: ({ANGLES})/(0.75*(x[1].x2-x[1].x1)*(x[1].y2-x[1].y1)) > 0.73)) > 0 then acc else list_concat(acc, x) end)).det_id as det_id from g)
 select {BOXES} from det where class_name not in ('lp', 'mild') or det_id in (select det_id from r)""")
def nested_rings(s, d):
    return merge.without_nested(det(s, d, True).withColumn("polygon", _angle()), ("lp", "mild"), 0.73).select(*BOXES.split(", "))


def _spread(rows: DataFrame, *by: str) -> DataFrame:
    """Rows of few bytes and much work over all partitions, which adaptive execution would else draw together."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


SHARED = "+".join(f"greatest(0, least({a[2]},{b[2]})-greatest({a[0]},{b[0]}))*greatest(0, least({a[3]},{b[3]})-greatest({a[1]},{b[1]}))" for a in _arms("a.") for b in _arms("b."))


@query(f"""with {TIGHT}, p as (select a.slide_id, a.class_name, a.det_id as a, b.det_id as b, {SHARED} as area, 0.75*least((a.x2-a.x1)*(a.y2-a.y1), (b.x2-b.x1)*(b.y2-b.y1)) as own from det a join det b on a.slide_id = b.slide_id and a.class_name = b.class_name and a.det_id < b.det_id)
 select slide_id, class_name, a, b, round(area,6) as area, round(area/own,6) as share from p where area > 0""")
def shared_areas(s, d):
    # rings are laid into the boxes after the join; the boxes are spread, not their many pairs
    near = spatial.pairs(_spread(det(s, d, True), "det_id"), ["slide_id", "class_name"])
    near = near.withColumn("s", merge.shared(_angle("a_"), _angle("b_"))).where("s.area > 0")
    return near.select(F.col("a_slide_id").alias("slide_id"), F.col("a_class_name").alias("class_name"), F.col("a_det_id").alias("a"), F.col("b_det_id").alias("b"), F.round("s.area", 6).alias("area"), F.round(F.col("s.area") / F.col("s.least"), 6).alias("share"))


@query(f"""with {DET}, r as (select det_id, x1%512 as u1, y1%512 as v1, x1%512+x2-x1 as u2, y1%512+y2-y1 as v2, x1-x1%512 as dx, y1-y1%512 as dy from det),
 p as (select det_id, unnest([[0,u1,v1],[1,u2,v1],[2,u2,(v1+v2)/2],[3,(u1+u2)/2,(v1+v2)/2],[4,(u1+u2)/2,v2],[5,u1,v2]]) as q, dx, dy from r)
 select det_id, cast(q[1] as int) as place, q[2]+dx as x, q[3]+dy as y from p""")
def rings_to_slide(s, d):
    dx, dy = F.col("x1") - F.col("x1") % 512, F.col("y1") - F.col("y1") % 512
    tiles = det(s, d).withColumns({"dx": dx, "dy": dy})
    local = tiles.withColumns({"x1": F.col("x1") - dx, "x2": F.col("x2") - dx, "y1": F.col("y1") - dy, "y2": F.col("y2") - dy})
    moved = local.select("det_id", F.posexplode(rings.translated(_angle(), F.col("dx"), F.col("dy"))).alias("place", "p"))
    return moved.select("det_id", "place", "p.x", "p.y")


@query()
def smart_simplify(s, d):
    return _waves(det(s, d)).select("det_id", merge.smart_simplified("polygon", 40).alias("polygon"))


@query()
def adaptive_simplify(s, d):
    return _waves(det(s, d)).select("det_id", merge.adaptively_simplified("polygon").alias("s")).select("det_id", "s.*")


@query(f"with {DET} select det_id, det_id%4 > 1 as valid from det")
def polygon_valid(s, d):
    k = F.col("det_id") % 4
    ring = F.when(k == 0, _bow()).when(k == 1, F.slice(_bow(), 1, 2)).when(k == 2, _hexagon()).otherwise(rectangle())
    return det(s, d).select("det_id", merge.is_valid(ring).alias("valid"))


@query(f"with {DET} select det_id, class_name, x1, y1, x2, y2 from det")
def json_roundtrip(s, d):
    folder = f"{shared_dir(s)}/json-{uuid.uuid4().hex}"
    documents.write_predictions(det(s, d), folder)
    back = s.read.schema(f"det_id bigint, class_name string, confidence double, box struct<start:{documents.POINT},`end`:{documents.POINT}>").json(folder)
    return back.select("det_id", "class_name", F.col("box.start.x").alias("x1"), F.col("box.start.y").alias("y1"), F.col("box.end.x").alias("x2"), F.col("box.end.y").alias("y2"))


PIXELS = "t as (select p_partkey as patch_id, (p_partkey*7919)%256 as a, (p_partkey*10007)%256 as b from part)"


def pixels(s: SparkSession, d: str) -> DataFrame:
    """A tile of 8 x 8 pixels of two levels for each part: (a, b, a) and (b, a, b) in turn."""
    k = F.col("p_partkey")
    level = lambda v: F.lpad(F.hex(v), 2, "0")
    image = F.unhex(F.repeat(F.concat(level(k * 7919 % 256), level(k * 10007 % 256)), F.lit(96)))
    return table(s, d, "part").select(k.alias("patch_id"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(3).alias("channels"), image.alias("image"))


@query(f"with {PIXELS} select patch_id from t where not (a > 240 and b > 240) and (a+b)/2.0 < 240 and abs(a-b)/2.0 > 10")
def tissue_filter(s, d):
    return tiling.with_tissue(pixels(s, d), "spread").select("patch_id")


@query(f"with {PIXELS} select patch_id from t where (a+b)/2.0 < 240")
def tissue_mean(s, d):
    return tiling.with_tissue(pixels(s, d), "mean").select("patch_id")


@query(f"with {PIXELS} select patch_id from t where (a+b)/2.0 < 0.999*255")
def tissue_sum(s, d):
    return tiling.with_tissue(pixels(s, d), "sum").select("patch_id")


@query(f"with {PIXELS} select patch_id from t where greatest(a,b) > 0 and 255*abs(a-b)/greatest(a,b) > 30.5")
def tissue_saturation(s, d):
    return tiling.with_tissue(pixels(s, d), "saturation").select("patch_id")


@query(f"with {PIXELS} select patch_id from t where not (0.413*a+0.587*b > 200 and 0.587*a+0.413*b > 200)")
def tissue_gray(s, d):
    return tiling.with_tissue(pixels(s, d), "gray").select("patch_id")


SLIDE_PIXELS = """s as (select distinct p_partkey//16 as slide from part), px as (select slide, x, y, slide*16 + y//16*4 + x//16 as k, x%16 as u, y%16 as v from s, lateral (select unnest(range(64)) as x), lateral (select unnest(range(64)) as y)),
 v as (select slide, x, y, case when p_partkey is null then '000000' else printf('%02X%02X%02X', (k*7919+u)%256, (k*10007+v)%256, (u*v+k)%256) end as h from px left join part on p_partkey = k)"""


def _drawn(s: SparkSession, d: str) -> str:
    """A folder of slides of 64 x 64 pixels, each of sixteen parts that give a stored tile of 16 x 16."""
    folder = f"{shared_dir(s)}/slides-{uuid.uuid4().hex}"

    def run(t: pd.DataFrame) -> pd.DataFrame:
        done = []
        for slide, rows in t.groupby("slide"):
            image = np.zeros((64, 64, 3), np.uint8)
            v, u = np.mgrid[:16, :16]
            for k in rows.k.tolist():
                i, j = k % 4, k % 16 // 4
                image[16 * j : 16 * j + 16, 16 * i : 16 * i + 16] = np.stack([k * 7919 + u, k * 10007 + v, u * v + k], axis=-1) % 256
            done.append(tiff.saved(tiff.encoded([image, image[::2, ::2]], 16, deflate=slide % 2 == 0, difference=slide % 3 == 0, big=slide % 5 == 0, mpp=0.25), folder, f"{slide}.tiff"))
        return pd.DataFrame({"path": done})

    k = F.col("p_partkey")
    parts = table(s, d, "part").select(k.alias("k"), F.floor(k / 16).alias("slide"))
    groups = parts.withColumn("g", F.pmod(F.xxhash64("slide"), F.lit(64)))
    groups.repartition(64, "g").groupBy("g").applyInPandas(run, "path string").write.format("noop").mode("overwrite").save()
    return folder


@query(f"with {SLIDE_PIXELS}, t as (select unnest([0, 16, 32]) as x), o as (select a.x as x, b.x as y from t a, t b) select v.slide as slide, cast(o.x as bigint) as x, cast(o.y as bigint) as y, sha256(unhex(string_agg(h, '' order by v.y, v.x))) as pixels from v join o on v.x >= o.x and v.x < o.x+32 and v.y >= o.y and v.y < o.y+32 group by 1, 2, 3")
def slide_read(s, d):
    rows = tiff.tiles(s, _drawn(s, d), 32, 0.5, band=32)
    return rows.select(F.regexp_extract("path", "([0-9]+)[.]tiff$", 1).cast("bigint").alias("slide"), "x", "y", F.sha2("image", 256).alias("pixels"))


@query("select distinct p_partkey//16 as slide, 64 as width, 64 as height, 2 as levels, 2.0 as downsample, 0.25 as mpp from part")
def slide_metadata(s, d):
    rows = tiff.metadata(s, _drawn(s, d), permissive=False)
    return rows.select(F.regexp_extract("path", "([0-9]+)[.]tiff$", 1).cast("bigint").alias("slide"), "width", "height", "levels", F.element_at("level_downsamples", -1).alias("downsample"), F.round("mpp", 6).alias("mpp"))


DRAWN = """s as (select distinct p_partkey//16 as slide from part), px as (select slide, x, y, slide*16 + y//16*4 + x//16 as k, x%16 as u, y%16 as v from s, lateral (select unnest(range(64)) as x), lateral (select unnest(range(64)) as y)),
 l0 as (select slide, x, y, (k*7919+u)%256 as r, (k*10007+v)%256 as g, (u*v+k)%256 as b from px)"""


def _drawn_tiles(s: SparkSession, d: str, side: int = 4) -> DataFrame:
    """Slides of side x side tiles of 16 x 16 pixels, one for every sixteen parts."""
    slides = table(s, d, "part").select(F.floor(F.col("p_partkey") / 16).alias("slide_id")).distinct()
    n = F.explode(F.sequence(F.lit(0), F.lit(side * side - 1)))
    tiles = slides.withColumn("n", n).select("slide_id", (F.col("slide_id") * 16 + F.col("n")).alias("k"), (F.col("n") % side * 16).cast("bigint").alias("x"), (F.floor(F.col("n") / side) * 16).alias("y"))

    @F.pandas_udf("binary")
    def image(k: pd.Series) -> pd.Series:
        v, u = np.mgrid[:16, :16]
        return pd.Series([(np.stack([i * 7919 + u, i * 10007 + v, u * v + i], axis=-1) % 256).astype(np.uint8).tobytes() for i in k.tolist()])

    return tiles.select("slide_id", "x", "y", F.lit(16).alias("height"), F.lit(16).alias("width"), F.lit(3).alias("channels"), image("k").alias("image"))


LEVEL = "select slide, x//2 as x, y//2 as y, (sum(r)+2)//4 as r, (sum(g)+2)//4 as g, (sum(b)+2)//4 as b from {0} group by 1, 2, 3"


@query(f"with {DRAWN}, l1 as ({LEVEL.format('l0')}), l2 as ({LEVEL.format('l1')}), a as (select 0 as level, * from l0 union all select 1, * from l1 union all select 2, * from l2) select slide as slide_id, level, cast(x//16*16 as bigint) as x, cast(y//16*16 as bigint) as y, sha256(unhex(string_agg(printf('%02X%02X%02X', cast(r as bigint), cast(g as bigint), cast(b as bigint)), '' order by a.y, a.x))) as pixels from a group by slide, level, x//16*16, y//16*16")
def slide_levels(s, d):
    return px.pyramid(_drawn_tiles(s, d), 16, 3).select("slide_id", "level", "x", "y", F.sha2("image", 256).alias("pixels"))


@query(f"with {DRAWN}, t as (select slide, x*48//64 as x, y*48//64 as y, count(*) as n, sum(r) as r, sum(g) as g, sum(b) as b from l0 group by 1, 2, 3) select slide as slide_id, sha256(unhex(string_agg(printf('%02X%02X%02X', cast((2*r+n)//(2*n) as bigint), cast((2*g+n)//(2*n) as bigint), cast((2*b+n)//(2*n) as bigint)), '' order by y, x))) as pixels from t group by 1")
def slide_thumbnail(s, d):
    tiles = _drawn_tiles(s, d)
    slides = tiles.select("slide_id").distinct().select("slide_id", F.lit(64).alias("width"), F.lit(64).alias("height"))
    return px.thumbnails(tiles, slides, 48).select("slide_id", F.sha2("image", 256).alias("pixels"))


@query(f"""with {PIXELS}, v as (select patch_id % 20 as slide_id, case when greatest(a,b) > 0 then cast(round_even(255.0*abs(a-b)/greatest(a,b), 0) as int) else 0 end as value, 64 as n from t), h as (select slide_id, value, cast(sum(n) as bigint) as n from v group by 1, 2),
 w as (select slide_id, value, sum(n) over u as below, sum(n*value) over u as under, sum(n) over (partition by slide_id) as total, sum(n*value) over (partition by slide_id) as mass from h window u as (partition by slide_id order by value)),
 b as (select *, case when total > below then cast(under*total-mass*below as double)/cast(below as double)*cast(under*total-mass*below as double)/cast(total-below as double) else -1 end as between_ from w),
 o as (select *, row_number() over (partition by slide_id order by between_ desc, value) as rn, count(*) over (partition by slide_id) as k from b) select slide_id, case when k > 1 then value else 0 end as level from o where rn = 1""")
def otsu_by_slide(s, d):
    tiles = pixels(s, d).withColumn("slide_id", F.col("patch_id") % 20)
    return px.otsu_levels(px.histograms(tiles))


MASK = "(x*x*31 + y*y*17 + x*y*13 + slide*101) % 97 < 30"


@query(f"""with recursive s as (select distinct p_partkey//16 as slide from part), m as (select slide, x, y, y*4294967296+x as i from s, lateral (select unnest(range(32)) as x), lateral (select unnest(range(32)) as y) where {MASK}),
 e as (select a.slide, a.i as u, b.i as v from m a join m b on a.slide = b.slide and abs(a.x-b.x) <= 1 and abs(a.y-b.y) <= 1 and a.i <> b.i),
 c(slide, i, root) as (select slide, i, i from m union select e.slide, e.v, c.root from c join e on e.slide = c.slide and e.u = c.i where c.root < e.v), r as (select slide, i, min(root) as root from c group by 1, 2)
 select slide as slide_id, root as component, count(*) as area, round(avg(x),9) as cx, round(avg(y),9) as cy, min(x) as x_min, min(y) as y_min, max(x)+1 as x_max, max(y)+1 as y_max from r join m using (slide, i) group by 1, 2""")
def mask_components(s, d):
    return px.mask_components(_masks(s, d)).withColumns({"cx": F.round("cx", 9), "cy": F.round("cy", 9)})


def _masks(s: SparkSession, d: str) -> DataFrame:
    """Masks by rule on four tiles of each slide."""

    @F.pandas_udf("binary")
    def mask(slide: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        v, u = np.mgrid[:16, :16]
        on = [((a + u) ** 2 * 31 + (b + v) ** 2 * 17 + (a + u) * (b + v) * 13 + i * 101) % 97 < 30 for i, a, b in zip(slide.tolist(), x.tolist(), y.tolist())]
        return pd.Series([o.astype(np.uint8).tobytes() for o in on])

    return _drawn_tiles(s, d, 2).withColumns({"image": mask("slide_id", "x", "y"), "channels": F.lit(1)})


CODES = "case a+2*b+4*c+8*d when 0 then 0 when 15 then 8 when 3 then 4 when 6 then 4 when 12 then 4 when 9 then 4 when 5 then 2 when 10 then 2 when 1 then 1 when 2 then 1 when 4 then 1 when 8 then 1 else 7 end"


@query(f"""with s as (select distinct p_partkey//16 as slide from part), g as (select slide, x, y, case when x between 0 and 31 and y between 0 and 31 and {MASK} then 1 else 0 end as v from s, lateral (select unnest(range(-1, 33)) as x), lateral (select unnest(range(-1, 33)) as y)),
 q as (select a.slide, a.v as a, b.v as b, c.v as c, d.v as d from g a join g b on a.slide = b.slide and b.x = a.x+1 and b.y = a.y join g c on a.slide = c.slide and c.x = a.x+1 and c.y = a.y+1 join g d on a.slide = d.slide and d.x = a.x and d.y = a.y+1)
 select slide as slide_id, round(sum({CODES})/8.0, 6) as area from q group by 1 having sum({CODES}) > 0""")
def mask_contours(s, d):
    found = px.contour_rings(_masks(s, d), 16)
    return found.groupBy("slide_id").agg(F.round(F.sum("area"), 6).alias("area"))


@query(f"with {DET}, l as (select class_name, count(*) as k from det group by 1), a as (select count(*) as n, count(distinct slide_id) as s from det) select 0 as part, cast(0 as bigint) as place, 'slides: ' || s || ', predictions: ' || n as line from a union all select 1, -k, printf('  %s: %d (%.1f%%)', class_name, k, 100.0*k/n) from l, a union all select 2, slide_id, printf('slide %d: %d predictions, mean confidence %.3f, %s', slide_id, cast(sum(k) as bigint), sum(c)/sum(k), string_agg(class_name || '=' || k, ', ' order by class_name)) from (select slide_id, class_name, count(*) as k, sum(conf) as c from det group by all) group by slide_id")
def text_report(s, d):
    return report.summary_lines(det(s, d))


@query("with c as (select p_brand, p_size, min(p_type) as name from part group by 1, 2) select p_brand as model_path, 512 as window_size, 0.5 as min_conf, string_agg(name, ',' order by p_size) as class_names, count(*) as num_classes from c group by 1")
def model_info(s, d):
    parts = table(s, d, "part")
    models = parts.select(F.col("p_brand").alias("model_path"), F.lit(512).alias("window_size"), documents.least_confidence(F.col("p_brand")).alias("min_conf")).distinct()
    classes = parts.groupBy(F.col("p_brand").alias("model_path"), F.col("p_size").alias("class_id")).agg(F.min("p_type").alias("class_name"))
    return report.model_info(models, classes).withColumn("class_names", F.array_join("class_names", ","))


@query(f"with {DET}, r as (select * replace ({REPORT} as class_name) from det), c as (select slide_id, floor(x1/512) as i, floor(y1/512) as j, count(*) as n from r where class_name <> 'excl' group by all order by n desc, min(det_id) limit 20) select det_id, r.x1-c.i*512 as x1, r.y1-c.j*512 as y1, {COLOUR} as colour, c.n as n_in_cell from r join c on r.slide_id = c.slide_id and floor(x1/512) = c.i and floor(y1/512) = c.j where class_name <> 'excl'")
def tile_annotations(s, d):
    return pipeline.annotations(report_classes(det(s, d)), 20).select("det_id", "x1", "y1", "colour", "n_in_cell")


@query(f"with {DET} select det_id, x1, y1-det_id%5 as y1, x2+det_id%7 as x2, y2 from det where det_id%4 > 0")
def rewritten_boxes(s, d):
    rows = det(s, d).withColumn("polygon", F.when(F.col("det_id") % 4 == 0, _bow()).otherwise(_hexagon()))
    return pipeline.rewritten(rows.withColumns({"x1": F.lit(0.0), "y2": F.lit(0.0)})).select("det_id", "x1", "y1", "x2", "y2")


@query("with c as (select event_id as component, event_id//64 as slide_id, event_id%6 as k, count(*) over (partition by event_id//64) as n from events) select slide_id, min(component) as first, count(*) as n, max(component) as last from c where n >= 6 group by slide_id, k")
def kmeans_regions(s, d):
    k = F.col("event_id")
    rows = table(s, d, "events").select(F.floor(k / 64).alias("slide_id"), k.alias("component"), (k % 6 * 100 + k * 7 % 13).cast("double").alias("cx"), (k % 6 % 4 * 150 + k * 5 % 11).cast("double").alias("cy"))
    return regions.clustered(rows, 6).groupBy("slide_id", "cluster").agg(F.min("component").alias("first"), F.count("*").alias("n"), F.max("component").alias("last")).drop("cluster")


def _point(x, y):
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _bow():
    """A ring that crosses itself."""
    x1, y1, x2, y2 = boxes.corners()
    return F.array(_point(x1, y1), _point(x2, y2), _point(x2, y1), _point(x1, y2))


def _angle(prefix: str = ""):
    """A box without the quarter of its lower right."""
    x1, y1, x2, y2 = boxes.corners(prefix)
    mx, my = (x1 + x2) / 2, (y1 + y2) / 2
    return F.array(_point(x1, y1), _point(x2, y1), _point(x2, my), _point(mx, my), _point(mx, y2), _point(x1, y2))


def _hexagon():
    """An irregular ring around a box; every third has the middles of its edges too."""
    x1, y1, x2, y2 = boxes.corners()
    k = F.col("det_id")
    p = [((x1), y1), ((x1 + x2) / 2, y1 - k % 5), (x2, y1), (x2 + k % 7, (y1 + y2) / 2), (x2, y2), (x1, y2)]
    every = [_point(*v) for (ax, ay), (bx, by) in zip(p, p[1:] + p[:1]) for v in ((ax, ay), ((ax + bx) / 2, (ay + by) / 2))]
    return F.filter(F.array(*every), lambda v, i: (i % 2 == 0) | (k % 3 == 2))


#: Points of the ring that each detection gets for the simplifiers: from 5 to 400.
POINTS = "5 + (det_id*37)%396"


def _waves(rows: DataFrame, once: bool = False) -> DataFrame:
    """A ring of 5 to 400 points around each box for the simplifiers: smooth, wavy, or with a short tooth at every second point;
    once: not made again by each function that takes it."""

    @F.arrow_udf("array<struct<x:double,y:double>>")
    def ring(k: pa.Array, n: pa.Array, cx: pa.Array, cy: pa.Array) -> pa.Array:
        k, n, cx, cy = (v.to_numpy() for v in (k, n, cx, cy))
        done = []
        for at in range(0, len(n), 256):
            m = n[at : at + 256]
            of = np.repeat(np.arange(len(m)), m)
            i = np.arange(len(of)) - np.repeat(np.cumsum(m) - m, m)
            turn, kind, far = i * (6.283185307179586 / m)[of], k[at : at + 256][of], np.full(len(of), 20.0)
            far[kind == 1] += np.sin(turn[kind == 1] * 12) * 0.4
            far[kind == 2] += i[kind == 2] % 2 * 0.3
            done.append(np.stack([cx[at : at + 256][of] + far * np.cos(turn), cy[at : at + 256][of] + far * np.sin(turn)], axis=1))
        return merge.rings_array(np.concatenate(done) if done else np.zeros((0, 2)), n, np.zeros(len(n), bool))

    ring = ring.asNondeterministic() if once else ring
    return _spread(rows, "det_id").withColumn("polygon", ring(F.col("det_id") % 3, F.expr(POINTS), *boxes.center()))


@query(f"with {DET} select det_id, {POINTS} as points, {POINTS} + 1 <= 40 as as_it_was, true as few, true as like, true as valid from det")
def smart_simplify_kept(s, d):
    rows = _waves(det(s, d), once=True).withColumn("s", merge.smart_simplified("polygon", 40))
    n, m = F.size("polygon"), F.size("s")
    share = merge.area("s") / merge.area("polygon")
    return rows.select("det_id", n.cast("bigint").alias("points"), (F.col("s") == F.col("polygon")).alias("as_it_was"), (m + 1 <= 40).alias("few"), share.between(0.9, 1.1).alias("like"), merge.is_valid("s").alias("valid"))


@query(f"""with {DET}, k as (select det_id, {POINTS} + 1 as n from det), t as (select *, case when n < 20 then 'simple' when n > 200 then 'complex' else 'medium' end as complexity, case when n < 20 then 15 when n > 200 then 80 else 60 end as target from k), l as (select unnest([false, true]) as legacy)
 select det_id, legacy, n as original_points, complexity, n <= target as untouched, true as few, true as kept, true as valid from t, l""")
def adaptive_simplify_kept(s, d):
    rows = _waves(det(s, d))
    both = [F.struct(F.lit(legacy).alias("legacy"), merge.adaptively_simplified("polygon", legacy=legacy).alias("s")) for legacy in (False, True)]
    found = rows.select("det_id", F.inline(F.array(*both)))
    kind, n = F.col("s.complexity"), F.col("s.simplified_points")
    target = F.when(kind == "simple", 15).when(kind == "complex", 80).otherwise(60)
    least = F.when(kind == "simple", 0.95).when(kind == "complex", 0.98).otherwise(0.97)
    kept = (F.col("s.method") != "douglas_peucker") | (F.col("s.area_preserved") >= least)
    return found.select("det_id", "legacy", F.col("s.original_points").cast("bigint").alias("original_points"), kind.alias("complexity"), (F.col("s.method") == "no_simplification_needed").alias("untouched"), (n <= 1.5 * target).alias("few"), kept.alias("kept"), merge.is_valid("s.polygon").alias("valid"))


NEXT = "+".join(f"greatest(0, least({a[2]},{b[2]})-greatest({a[0]},{b[0]}))*greatest(0, least({a[3]},{b[3]})-greatest({a[1]},{b[1]}))" for a in _arms("a.") for b in _arms("b."))


@query(f"with {TIGHT} select a.det_id, round({NEXT}, 6) as shared from det a join det b on b.det_id = a.det_id+1 and a.slide_id = b.slide_id")
def ring_shared_area(s, d):
    # rings are laid into the boxes after the join
    rows = det(s, d, True).select("det_id", "slide_id", "x1", "y1", "x2", "y2")
    a, b = spatial.prefixed(rows, "a_"), spatial.prefixed(rows, "b_").withColumn("a_det_id", F.col("b_det_id") - 1)
    near = a.join(b, (a.a_det_id == b.a_det_id) & (F.col("a_slide_id") == F.col("b_slide_id"))).select(a.a_det_id.alias("det_id"), _angle("a_").alias("p"), _angle("b_").alias("q"))
    return near.select("det_id", F.round(merge.shared_area("p", "q"), 6).alias("shared"))


@query(f"with {DET} select det_id, x1+slide_id as x1, y1+2-det_id%5 as y1, x2+slide_id+det_id%7 as x2, y2+2 as y2 from det")
def ring_translate(s, d):
    moved = rings.translated(F.col("polygon"), F.col("slide_id"), F.lit(2))
    rows = det(s, d).withColumn("polygon", _hexagon()).withColumn("polygon", moved)
    return rows.select("det_id", *rings.bounds(F.col("polygon")))


@query(f"""with {DET}, {SLIDES}, k as (select slide_id, class_name, count(*) as n, sum(conf) as c from det group by all), t as (select slide_id, sum(n) as n, sum(c)/sum(n) as m from k group by 1)
 select slide_id, 0 as part, cast(0 as bigint) as place, 'file: /s/' || slide_id || '.tiff, ' || width || ' x ' || height as line from slides union all select slide_id, 1, 0, case when n is null then 'predictions: 0' else printf('predictions: %d, mean confidence %.3f', cast(n as bigint), m) end from slides left join t using (slide_id)
 union all select slide_id, 2, row_number() over (partition by slide_id order by class_name), printf('  %s: %d', class_name, n) from k union all select slide_id, 3, det_id, printf('%s (%.3f): (%.1f, %.1f) - (%.1f, %.1f), 4 points', class_name, cast(round(cast(cast(conf as varchar) as decimal(38,18)), 3) as double), x1, y1, x2, y2) from det""")
def slide_details(s, d):
    files = slides(s, d).withColumn("path", F.concat(F.lit("/s/"), F.col("slide_id").cast("string"), F.lit(".tiff")))
    return report.slide_details(det(s, d).withColumn("polygon", rectangle()), files)


@query(f"with {DRAWN} select slide || '_' || (x//16) || '_' || (y//16) || '.png' as name, sha256(unhex(string_agg(printf('%02X%02X%02X', r, g, b), '' order by l0.y, l0.x))) as pixels from l0 group by slide, x//16, y//16")
def tile_files(s, d):
    folder = f"{shared_dir(s)}/tiles-{uuid.uuid4().hex}"
    files.write(_drawn_tiles(s, d).withColumn("name", files.tile_file("slide_id", F.floor(F.col("x") / 16), F.floor(F.col("y") / 16))), folder)
    return files.read(s, folder).select("name", F.sha2("image", 256).alias("pixels"))


@query(f"""with {DET}, w as (select det_id, slide_id, {REPORT} as class_name, cast(x1 % 480 as bigint) as x1, cast(y1 % 480 as bigint) as y1, cast(floor((x2-x1)/6) as bigint) as wide, cast(floor((y2-y1)/6) as bigint) as high from det),
 px as (select slide_id, det_id, class_name, x, y from w, lateral (select unnest(range(x1, x1+wide)) as x), lateral (select unnest(range(y1, y1+high)) as y)),
 t as (select slide_id, x, y, arg_max(class_name, det_id) as class_name from px group by 1, 2, 3) select slide_id, {COLOUR} as colour, count(*) as n from t group by 1, 2""")
def drawn_pixels(s, d):
    x, y = F.col("x1") % 480, F.col("y1") % 480
    rows = report_classes(det(s, d)).withColumns({"x1": x, "y1": y, "x2": x + F.floor((F.col("x2") - F.col("x1")) / 6), "y2": y + F.floor((F.col("y2") - F.col("y1")) / 6)})
    return drawing.pixel_counts(drawing.layers(report.coloured(rows).withColumn("polygon", rectangle()), 128, fill=True), 128)
