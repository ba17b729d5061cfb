"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.fixtures import fixture, oracle
from rasterweave.model import classes
from rasterweave.operators import filters, pairing, spatial
from rasterweave.queries.projections import _BLOCKS, _FEATURES, _PARSED, _blocks
from rasterweave.registry import query

HEIGHT, WIDTH = 104, 80
_LAYER = "select class_id layer, min(least(x0, x1)) minx, min(least(y0, y1)) miny, max(greatest(x0, x1)) maxx, max(greatest(y0, y1)) maxy from fx_edges group by 1"
_OVER = "r.minx < l.maxx and r.maxx > l.minx and r.miny < l.maxy and r.maxy > l.miny"


@query(oracle(f"select raster_id, coalesce(string_agg(cast(layer as varchar), ',' order by cast(layer as varchar)), 'none') layers from fx_rasters r left join ({_LAYER}) l on {_OVER} group by 1", "fx_rasters", "fx_edges"))
def bbox_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = spatial.edge_boxes(fixture(spark, sf_dir, "fx_edges"), "class_id").withColumn("layer", F.col("class_id").cast("string"))
    return spatial.bbox_overlap_join(fixture(spark, sf_dir, "fx_rasters"), layers)


@query(oracle(f"select b.tile_id, f.fid from ({_BLOCKS.replace('b.tile_id', '*')}) b join ({_FEATURES}) f on b.minx < f.maxx and b.maxx > f.minx and b.miny < f.maxy and b.maxy > f.miny", "fx_px", "fx_edges"))
def grid_bbox_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.grid_bbox_join(_blocks(spark, sf_dir), spatial.edge_boxes(fixture(spark, sf_dir, "fx_edges"), "fid"), "tile_id", "fid", 32.0)


_GRID = f"select r.range as row, c.range as col from range({HEIGHT}) r, range({WIDTH}) c"
_INSIDE = """select fid, class_id, row, col from (select *, x0 + (row + 0.5e0 - y0) * (x1 - x0) / cast(y1 - y0 as double) x from (select *, unnest(range(cast(ceil(least(y0, y1) - 0.5e0) as bigint), cast(ceil(greatest(y0, y1) - 0.5e0) as bigint))) as row
 from fx_edges where y0 <> y1)) join (select distinct col from grid) on x > col + 0.5e0 where row in (select row from grid) group by 1, 2, 3, 4 having count(*) % 2 = 1"""
_TOUCH = """select distinct fid, class_id, row, col from (select fid, class_id, row, lo, greatest(lo, hi) hi from (select fid, class_id, row, cast(floor(least(xa, xb)) as bigint) lo, cast(ceil(greatest(xa, xb)) as bigint) - 1 hi from (
 select fid, class_id, row, case when y0 = y1 then cast(x0 as double) else x0 + (greatest(row, least(y0, y1)) - y0) * (x1 - x0) / cast(y1 - y0 as double) end xa,
 case when y0 = y1 then cast(x1 as double) else x0 + (least(row + 1, greatest(y0, y1)) - y0) * (x1 - x0) / cast(y1 - y0 as double) end xb
 from fx_edges join (select distinct row from grid) on row between least(y0, y1) and greatest(least(y0, y1), greatest(y0, y1) - 1)))) join (select distinct col from grid) on col between lo and hi"""


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_edges")


def burned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.rasterize_polygons(_edges(spark, sf_dir), "fid", "class_id", height=HEIGHT, width=WIDTH)


@query(oracle(_INSIDE, "fx_edges", grid=_GRID))
def rasterize_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return burned(spark, sf_dir)


@query(oracle("select * from inside union select * from touch", "fx_edges", grid=_GRID, inside=_INSIDE, touch=_TOUCH))
def rasterize_all_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.rasterize_all_touched(_edges(spark, sf_dir), "fid", "class_id", height=HEIGHT, width=WIDTH)


_MASK = "select row, col, arg_max(i.class_id, priority) class_id from inside i join fx_classes c on i.class_id = c.class_id group by 1, 2"


def grid(spark: SparkSession) -> DataFrame:
    return spark.range(HEIGHT).select(F.col("id").alias("row"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(WIDTH - 1).cast("bigint"))).alias("col"))


def mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.overlay_by_priority(burned(spark, sf_dir), classes(spark))


@query(oracle("select row, col, coalesce(class_id, 0) class_id from grid left join mask using (row, col)", "fx_edges", "fx_classes", grid=_GRID, inside=_INSIDE, mask=_MASK))
def overlay_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.onto_grid(grid(spark), mask(spark, sf_dir))


@query(oracle("select distinct row, col from inside", "fx_edges", grid=_GRID, inside=_INSIDE))
def coverage_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.coverage_union(burned(spark, sf_dir))


@query(oracle("select i.tile_id, n_values, n_classes from (select tile_id, cast(count(*) as bigint) n_values from fx_px where tile_id % 6 <> 0 group by 1) i join (select tile_id, cast(count(distinct target) as bigint) n_classes from fx_scores where tile_id % 5 <> 0 group by 1) m using (tile_id)", "fx_px", "fx_scores"))
def join_image_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = fixture(spark, sf_dir, "fx_px").where("tile_id % 6 <> 0").groupBy("tile_id").agg(F.count("*").alias("n_values"))
    masks = fixture(spark, sf_dir, "fx_scores").where("tile_id % 5 <> 0").groupBy("tile_id").agg(F.count_distinct("target").alias("n_classes"))
    return pairing.join_image_mask(images, masks, "tile_id")


@query(oracle("select id, trow % 3 <> 0 and tcol % 5 <> 0 complete from fx_tile_meta", "fx_tile_meta"))
def complete_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = fixture(spark, sf_dir, "fx_tile_meta")
    have, lack = pairing.complete_pairs(meta.select("id"), meta.where("trow % 3 <> 0"), meta.where("tcol % 5 <> 0"))
    return have.withColumn("complete", F.lit(True)).union(lack.withColumn("complete", F.lit(False)))


@query(oracle("select id, case when coverage_ratio = 1 and trow % 2 = 0 then concat('replay/', id) else concat(shard, '/', id) end path from fx_tile_meta", "fx_tile_meta"))
def locate_tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = fixture(spark, sf_dir, "fx_tile_meta")
    replay = meta.where("coverage_ratio = 1 and trow % 2 = 0").select("id", F.concat(F.lit("replay/"), "id").alias("path"))
    return pairing.locate_tile(meta.select("id", F.concat_ws("/", "shard", "id").alias("path")), replay)


@query(oracle("select id, source from fx_tile_meta where source in (select raster_id from fx_rasters where nodata is null)", "fx_tile_meta", "fx_rasters"))
def semi_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = fixture(spark, sf_dir, "fx_rasters").where("nodata is null").select(F.col("raster_id").alias("source"))
    return pairing.semi_by_source(fixture(spark, sf_dir, "fx_tile_meta"), sources).select("id", "source")


_POINTS = f"select seq, x, y, c.class_id from ({_PARSED}) p join fx_classes c using (class_name) where n = 3 and x is not null and y is not null"


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = filters.parse_prompts(fixture(spark, sf_dir, "fx_prompts"))
    return good.join(F.broadcast(classes(spark).select("class_name", "class_id")), "class_name")


@query(oracle("""select row, col, coalesce(arg_max(p.class_id, seq), any_value(m.class_id)) class_id from (select row, col, coalesce(class_id, 0) class_id from grid left join mask using (row, col)) m
 left join points p on row >= floor(y) - 5 and row < floor(y) + 5 and col >= floor(x) - 5 and col < floor(x) + 5 group by 1, 2""", "fx_edges", "fx_classes", "fx_prompts", grid=_GRID, inside=_INSIDE, mask=_MASK, points=_POINTS))  # fmt: skip
def point_prompt_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.point_prompt_override(spatial.onto_grid(grid(spark), mask(spark, sf_dir)), prompts(spark, sf_dir))


@query(oracle("select s.target, coalesce(label, concat('cls', cast(s.target as varchar))) label, cast(count(*) as bigint) n from fx_scores s left join fx_classes c on c.class_id = s.target group by 1, 2", "fx_scores", "fx_classes"))
def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = fixture(spark, sf_dir, "fx_scores").groupBy("target").agg(F.count("*").alias("n"))
    return pairing.label_lookup(counted, classes(spark), "target")


_WINDOWS = "select distinct least(win_row, (select max(gr) from fx_px) - 15) win_row, least(win_col, (select max(gc) from fx_px) - 15) win_col from (select distinct gr win_row, gc win_col from fx_px where gr % 6 = 0 and gc % 6 = 0)"


@query(oracle("select row, col, win_row, win_col from (select distinct gr as row, gc as col from fx_px) join windows on row between win_row and win_row + 15 and col between win_col and win_col + 15", "fx_px", windows=_WINDOWS))
def window_cover_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 16 every 6 pixels, the last ones clamped, over the mosaic's pixels."""
    px = fixture(spark, sf_dir, "fx_px")
    pixels = px.select(F.col("gr").alias("row"), F.col("gc").alias("col")).distinct()
    last = pixels.agg(F.max("row").alias("h"), F.max("col").alias("w"))
    windows = pixels.where("row % 6 = 0 and col % 6 = 0").crossJoin(F.broadcast(last)).select(F.least("row", F.col("h") - 15).alias("win_row"), F.least("col", F.col("w") - 15).alias("win_col")).distinct()
    return spatial.window_cover_join(pixels, windows, 16)
