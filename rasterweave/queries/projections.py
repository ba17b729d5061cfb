"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.fixtures import fixture, oracle
from rasterweave.functions import scalars
from rasterweave.model import classes
from rasterweave.operators import filters, spatial
from rasterweave.registry import query


@query(oracle("select tile_id, r, c, round(max(v) filter (where band = 1), 6) b1, round(max(v) filter (where band = 3), 6) b3 from fx_px group by 1, 2, 3", "fx_px"))
def select_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = lambda band: F.max(F.when(F.col("band") == band, F.col("v")))
    px = fixture(spark, sf_dir, "fx_px").groupBy("tile_id", "r", "c").agg(F.array(*map(value, range(1, 5))).alias("bands"))  # null where a tile lacks a band
    chosen = px.select("tile_id", "r", "c", filters.select_bands(F.col("bands"), [1, 3, 2, 4], 2).alias("b"))
    return chosen.select("tile_id", "r", "c", F.round(F.col("b")[0], 6).alias("b1"), F.round(F.col("b")[1], 6).alias("b3"))


@query(oracle("select tile_id, band, cast(count(*) as bigint) n from fx_px where case when tile_id % 5 = 0 then cast(null as double) else 0e0 end is null or v <> 0 group by 1, 2", "fx_px"))
def drop_nodata(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = fixture(spark, sf_dir, "fx_px").withColumn("nodata", F.when(F.col("tile_id") % 5 != 0, 0.0))
    return filters.drop_nodata(px).groupBy("tile_id", "band").agg(F.count("*").alias("n"))


@query(oracle("select tile_id, r, c, bool_or(v <> 0) as valid from fx_px group by 1, 2, 3", "fx_px"))
def valid_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.valid_mask(fixture(spark, sf_dir, "fx_px"), ["tile_id", "r", "c"])


_RATIOS = "select tile_id, avg(cast(cast(ok as int) as double)) valid_ratio, avg(case when (tile_id + r) % 4 = 0 and c < 4 then 1e0 else 0e0 end) coverage_ratio from (select tile_id, r, c, bool_or(v <> 0) ok from fx_px group by 1, 2, 3) group by 1"


@query(oracle(f"select * from ({_RATIOS}) where valid_ratio >= 0.1e0 and coverage_ratio >= 0.05e0", "fx_px"))
def filter_tiles_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = filters.valid_mask(fixture(spark, sf_dir, "fx_px"), ["tile_id", "r", "c"])
    covered = ((F.col("tile_id") + F.col("r")) % 4 == 0) & (F.col("c") < 4)
    ratios = px.groupBy("tile_id").agg(F.avg(F.col("valid").cast("double")).alias("valid_ratio"), F.avg(covered.cast("double")).alias("coverage_ratio"))
    return filters.filter_tiles_quality(ratios)


_BLOCKS = "select b.tile_id from (select tile_id, min(gc) minx, min(gr) miny, max(gc) + 1 maxx, max(gr) + 1 maxy from fx_px group by 1) b"
_FEATURES = "select fid, min(least(x0, x1)) minx, min(least(y0, y1)) miny, max(greatest(x0, x1)) maxx, max(greatest(y0, y1)) maxy from fx_edges group by 1"


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_px").groupBy("tile_id").agg(F.min("gc").alias("minx"), F.min("gr").alias("miny"), (F.max("gc") + 1).alias("maxx"), (F.max("gr") + 1).alias("maxy"))


@query(oracle(f"{_BLOCKS} where exists (select 1 from ({_FEATURES}) f where b.minx < f.maxx and b.maxx > f.minx and b.miny < f.maxy and b.maxy > f.miny)", "fx_px", "fx_edges"))
def skip_uncovered_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks, features = _blocks(spark, sf_dir), spatial.edge_boxes(fixture(spark, sf_dir, "fx_edges"), "fid")
    covered = spatial.grid_bbox_join(blocks, features, "tile_id", "fid", 32.0).select("tile_id").distinct()
    return blocks.select("tile_id").join(covered, "tile_id", "left_semi")


_ORDER = "cast(concat('0x', substr(md5(concat('42:', id)), 1, 8)) as bigint)"


@query(oracle("select id, source from s where list_contains(class_ids, 2) union all select id, source from fx_tile_meta where not exists (select 1 from s where list_contains(class_ids, 2))", "fx_tile_meta", s=f"select * from fx_tile_meta order by {_ORDER}, id limit 200"))
def filter_tiles_with_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_tiles_with_class(fixture(spark, sf_dir, "fx_tile_meta").select("id", "source", "class_ids"), 2).select("id", "source")


@query("select o_orderkey, printf('scene_%d_r%06d_c%06d', o_custkey % 20, o_orderkey // 100 * 448, o_orderkey % 100 * 448) id from orders")
def tile_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fixture(spark, sf_dir, "orders")
    stem = F.concat(F.lit("scene_"), F.col("o_custkey") % 20)
    return orders.select("o_orderkey", scalars.tile_id(stem, F.floor(F.col("o_orderkey") / 100) * 448, F.col("o_orderkey") % 100 * 448).alias("id"))


@query(oracle("select id, left(string_split(id, '_r')[1], 20) stem from fx_tile_meta", "fx_tile_meta"))
def tile_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_tile_meta").select("id", scalars.tile_stem(F.col("id")).alias("stem"))


@query(oracle("select path, regexp_extract(path, '[^/]*$') name, regexp_replace(regexp_extract(path, '[^/]*$'), '\\.[^.]*$', '') stem, string_split(path, '/')[-2] folder from fx_files", "fx_files"))
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_files").select("path", scalars.file_name("path").alias("name"), scalars.file_stem("path").alias("stem"), scalars.parent_folder("path").alias("folder"))


@query(oracle("select id, coalesce(class_ids, [0]) class_ids, coalesce(coverage_ratio, 0e0) coverage_ratio from fx_tile_meta", "fx_tile_meta"))
def default_class_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.default_class_ids(fixture(spark, sf_dir, "fx_tile_meta")).select("id", "class_ids", "coverage_ratio")


def _tenths(unit: str, name: str) -> str:
    return f"concat(cast(floor(length * 10 / {unit})::bigint // 10 as varchar), '.', cast(floor(length * 10 / {unit})::bigint % 10 as varchar), '{name}')"


@query(oracle(f"select path, case when length < 1024 then concat(cast(length as varchar), ' B') when length < 1048576 then {_tenths('1024', ' KB')} when length < 1073741824 then {_tenths('1048576', ' MB')} else {_tenths('1073741824', ' GB')} end size from fx_files", "fx_files"))
def size_str(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_files").select("path", scalars.size_text(F.col("length")).alias("size"))


@query(oracle("select fid, class_id, cast(count(*) as int) n_points from fx_edges where fid % 5 <> 0 and fid % 7 <> 0 group by 1, 2", "fx_edges"))
def drop_null_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth feature has a null geometry here, every seventh an empty one."""
    rings = fixture(spark, sf_dir, "fx_edges").groupBy("fid", "class_id").agg(F.collect_list(F.struct("x0", "y0")).alias("ring"))
    none = F.array().cast("array<struct<x0:bigint,y0:bigint>>")
    features = rings.withColumn("rings", F.when(F.col("fid") % 5 == 0, None).when(F.col("fid") % 7 == 0, none).otherwise(F.col("ring")))
    return filters.drop_null_geometry(features).select("fid", "class_id", F.size("rings").alias("n_points"))


_PARSED = "select seq, try_cast(trim(string_split(txt, ',')[1]) as double) x, try_cast(trim(string_split(txt, ',')[2]) as double) y, trim(string_split(txt, ',')[3]) class_name, len(string_split(txt, ',')) n, txt from fx_prompts"


@query(oracle(f"select seq, x, y, class_name, cast(null as varchar) rejected from ({_PARSED}) where n = 3 and x is not null and y is not null union all select seq, null, null, null, txt from ({_PARSED}) where not (n = 3 and x is not null and y is not null)", "fx_prompts"))
def parse_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = filters.parse_prompts(fixture(spark, sf_dir, "fx_prompts"))
    return good.withColumn("rejected", F.lit(None).cast("string")).unionByName(bad.withColumnRenamed("txt", "rejected"), allowMissingColumns=True)


@query(oracle(f"select seq, class_name, class_name in (select class_name from fx_classes) known from ({_PARSED}) where n = 3 and x is not null and y is not null", "fx_prompts", "fx_classes"))
def validate_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = filters.parse_prompts(fixture(spark, sf_dir, "fx_prompts"))
    dim = classes(spark)
    return filters.validate_class(good, dim).select("seq", "class_name", F.lit(True).alias("known")).union(filters.validate_class(good, dim, False).select("seq", "class_name", F.lit(False)))


@query(oracle("select shard, cast(right(shard, 1) as int) step, cast(count(*) as bigint) tiles from fx_tile_meta where cast(right(shard, 1) as int) >= 3 group by 1, 2", "fx_tile_meta"))
def resume_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = fixture(spark, sf_dir, "fx_tile_meta").groupBy("shard").agg(F.count("*").alias("tiles")).withColumn("step", F.right("shard", F.lit(1)).cast("int"))
    return filters.resume_from(shards, 3, 4)
