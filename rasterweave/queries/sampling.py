"""Sorts, limits, samples, splits and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.fixtures import fixture, oracle
from rasterweave.model import class_map, classes
from rasterweave.operators import selection, stats
from rasterweave.queries.aggregations import _RAREST, _RASTERS, _WIN, SAMPLER, _windows, rounded
from rasterweave.registry import query

_H = "cast(concat('0x', substr(md5(concat('42:', {})), 1, 8)) as bigint)"
_HID = _H.format("id")


def _meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_tile_meta")


@query(oracle(f"select id, {_HID} h, cast(row_number() over (order by {_HID}, id) as int) place from fx_tile_meta", "fx_tile_meta"))
def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rasterweave.functions.scalars import hash_number

    ranked = selection.prefix_sums(_meta(spark, sf_dir).select("id", hash_number(42, "id").alias("h")).withColumn("k", F.concat(F.lpad(F.col("h").cast("string"), 10, "0"), "id")).withColumn("one", F.lit(1).cast("bigint")), "k", "one")
    return ranked.select("id", "h", (F.col("before") + 1).cast("int").alias("place"))


@query(oracle(f"select id, source from fx_tile_meta order by {_HID}, id limit 500", "fx_tile_meta"))
def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.sample_n(_meta(spark, sf_dir), "id", 500).select("id", "source")


_SPLIT = f"select id, row_number() over (order by lpad(cast({_HID} as varchar), 10, '0') || ':' || id) <= ceil(count(*) over () * 0.2e0) is_val from fx_tile_meta"


@query(oracle(_SPLIT, "fx_tile_meta"))
def train_val_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.train_val_split(_meta(spark, sf_dir).select("id"), "id")


@query(oracle(f"select id, source from fx_tile_meta where source in (select source from (select source, row_number() over (order by lpad(cast({_H.format('source')} as varchar), 10, '0') || ':' || source) rn, count(*) over () n from (select distinct source from fx_tile_meta)) where rn <= ceil(n * 0.2e0))", "fx_tile_meta"))
def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.group_split(_meta(spark, sf_dir)).select("id", "source")


@query(oracle("select id, (select max(sampler_w) from (select unnest(coalesce(class_ids, [0])) c) u join fx_classes k on k.class_id = u.c) w from fx_tile_meta", "fx_tile_meta", "fx_classes"))
def sample_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _meta(spark, sf_dir).select("id", stats.sample_weight(F.coalesce("class_ids", F.array(F.lit(0))), SAMPLER).alias("w"))


_ORIGIN = f"select id, shard, case when shard = 'shard_1' then 'current' else 'replay' end origin, (select sampler_w from fx_classes where class_id = {_RAREST}) own from fx_tile_meta where shard in ('shard_1', 'shard_2')"


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = _meta(spark, sf_dir).where("shard in ('shard_1', 'shard_2')").withColumn("origin", F.when(F.col("shard") == "shard_1", "current").otherwise("replay"))
    return selection.replay_weights(tiles, class_map(4))


@query(oracle("select id, origin, round(case when origin = 'replay' then least(nc * 0.3e0 / greatest(nr * 0.7e0, 1), 5) * own else own end, 9) w from o, (select count_if(origin = 'current') nc, count_if(origin = 'replay') nr from o)", "fx_tile_meta", "fx_classes", o=_ORIGIN))
def replay_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_mixed(spark, sf_dir).select("id", "origin", "w"), "w", digits=9)


_WEIGHTED = f"select id, cast(10 * (select max(sampler_w) from (select unnest(coalesce(class_ids, [0])) c) u join fx_classes k on k.class_id = u.c) as bigint) w from fx_tile_meta"
_AT = "cast(floor(cast(concat('0x', substr(md5(concat('42:', cast(o_orderkey as varchar))), 1, 8)) as bigint) / 4294967296e0 * (select sum(w) from items)) as bigint)"


@query(oracle(f"select k, id from (select o_orderkey k, {_AT} p from orders) d asof join (select id, coalesce(sum(w) over (order by id rows between unbounded preceding and 1 preceding), 0)::bigint b from items) i on d.p >= i.b", "fx_tile_meta", "fx_classes", items=_WEIGHTED))
def weighted_sample_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    weight = (stats.sample_weight(F.coalesce("class_ids", F.array(F.lit(0))), SAMPLER) * 10).cast("bigint")
    items = _meta(spark, sf_dir).select("id", weight.alias("w"))
    return selection.weighted_sample_replace(items, fixture(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")))


@query(oracle("select raster_id, cast(k as int) k, win_row, win_col from win", "fx_big_px", rasters=_RASTERS, win=_WIN))
def random_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir).select("raster_id", "k", "win_row", "win_col")


@query(oracle(f"select id from fx_tile_meta where coverage_ratio > 0.5e0 order by {_HID}, id limit 200", "fx_tile_meta"))
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.sample_n(_meta(spark, sf_dir).where("coverage_ratio > 0.5"), "id", 200).select("id")


@query(oracle("select class_id, priority, cast(row_number() over (order by priority) as int) place, (select min(shard) from fx_tile_meta) first_shard from fx_classes", "fx_classes", "fx_tile_meta"))
def order_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = classes(spark).orderBy("priority").agg(F.sort_array(F.collect_list(F.struct("priority", "class_id"))).alias("p"))
    shard = _meta(spark, sf_dir).select("shard").distinct().orderBy("shard").limit(1).withColumnRenamed("shard", "first_shard")
    return ordered.select(F.posexplode("p").alias("i", "s")).select("s.class_id", "s.priority", (F.col("i") + 1).alias("place")).crossJoin(F.broadcast(shard))


@query(oracle("select id, origin, shard from (select id, 'current' origin, shard from fx_tile_meta where shard = 'shard_1' union all select id, 'replay', shard from fx_tile_meta where coverage_ratio = 1 and shard in ('shard_1', 'shard_2'))", "fx_tile_meta"))
def union_current_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = _meta(spark, sf_dir)
    both = selection.union_current_replay(meta.where("shard = 'shard_1'"), meta.where("coverage_ratio = 1 and shard in ('shard_1', 'shard_2')"))
    return both.select("id", "origin", "shard")


@query(oracle("select path, length from fx_files where path like '%.tif' union all select path, length from fx_files where path like '%.tiff' union all select path, length from fx_files where path like '/raw/shard_1/%'", "fx_files"))
def union_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = fixture(spark, sf_dir, "fx_files")
    return files.where("path like '%.tif'").union(files.where("path like '%.tiff'")).union(files.where("path like '/raw/shard_1/%'"))


@query(oracle(f"select id from fx_tile_meta except all select id from ({_SPLIT}) where is_val", "fx_tile_meta"))
def split_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _meta(spark, sf_dir).select("id")
    return ids.exceptAll(selection.train_val_split(ids, "id").where("is_val").select("id"))


@query(oracle("select distinct regexp_replace(path, '_[0-9]*[.]', '.') path from fx_files", "fx_files"))
def dedupe_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_files").select(F.regexp_replace("path", "_[0-9]*[.]", ".").alias("path")).dropDuplicates(["path"])
