"""Scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.fixtures import fixture, oracle
from rasterweave.model import classes
from rasterweave.registry import query
from rasterweave.session import scratch
from rasterweave.sources import catalog, sinks


def _part(name: str):
    return F.regexp_extract("path", f"/{name}=([^/]*)/", 1)


@query(oracle("select shard, source, cast(sum(strlen(id) + 1) as bigint) bytes from fx_tile_meta group by 1, 2", "fx_tile_meta"))
def scan_raster_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes per folder of files that hold the tiles' ids, a line each; other kinds of files there are left out."""
    path, meta = scratch(spark, "rasters"), fixture(spark, sf_dir, "fx_tile_meta")
    meta.select("id", "shard", "source").write.partitionBy("shard", "source").text(path)
    meta.select("id", "shard", "source").write.mode("append").partitionBy("shard", "source").json(path)
    files = catalog.list_files(spark, [path], ("txt", "tif"))
    return files.groupBy(_part("shard").alias("shard"), _part("source").alias("source")).agg(F.sum("length").alias("bytes"))


@query(oracle("select class_id, cast(sum(strlen(concat_ws(',', fid, x0, y0, x1, y1)) + 1) as bigint) bytes from fx_edges group by 1", "fx_edges"))
def scan_vector_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes per layer of files of edges; a root that is named twice counts once."""
    path = scratch(spark, "vectors")
    fixture(spark, sf_dir, "fx_edges").select("class_id", "fid", "x0", "y0", "x1", "y1").write.partitionBy("class_id").csv(path)
    files = catalog.list_files(spark, [path, path], ("shp", "csv"))
    return files.groupBy(_part("class_id").cast("int").alias("class_id")).agg(F.sum("length").alias("bytes"))


_LAYERS = "case class_id when 0 then 'src1_1.tif' when 1 then 'src2_2.shp' when 2 then 'src5_5.shp' else 'src4_4.shp' end"


@query(oracle(f"""select c.class_id, c.class_name, f.path, case when f.path is null then 'missing' else 'found' end status
from (select *, {_LAYERS} layer_file from fx_classes) c left join
(select regexp_extract(path, '[^/]*$') layer_file, min(path) path from fx_files group by 1) f using (layer_file)""", "fx_classes", "fx_files"))  # fmt: skip
def resolve_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = classes(spark).withColumn("layer_file", F.expr(_LAYERS))
    return catalog.resolve_layers(wanted, fixture(spark, sf_dir, "fx_files")).select("class_id", "class_name", "path", "status")


@query(oracle("select *, cast(width as bigint) * height pixel_count, cast(width as bigint) * height * n_bands * itemsize / 1048576 raw_mb, cast(width as bigint) * height * n_bands * itemsize / 1048576 > 4096 large from fx_rasters", "fx_rasters"))
def raster_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.raster_catalog(fixture(spark, sf_dir, "fx_rasters"))


@query(oracle("select band, gr, gc, v from fx_px where band in (1, 3) and gr between 4 and 20 and gc between 10 and 50", "fx_px"))
def read_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "blocks")
    catalog.to_blocks(fixture(spark, sf_dir, "fx_px"), 8, 8).sortWithinPartitions("block_row", "block_col", "band").write.parquet(path)
    return catalog.read_window(spark.read.parquet(path), [1, 3], col=10, row=4, width=41, height=17, block_height=8, block_width=8)


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = fixture(spark, sf_dir, "fx_px")
    image = F.transform(F.sort_array(F.collect_list(F.struct("band", "r", "c", "v"))), lambda s: s.v.cast("float"))
    return px.groupBy(F.col("tile_id").alias("id")).agg(image.alias("image")).withColumn("shard", (F.col("id") % 4 + 1).cast("int"))


@query(oracle("select tile_id id, cast(tile_id % 4 + 1 as int) shard, cast(count(*) as int) n_values, round(sum(cast(v as float)::double), 4) total from fx_px group by 1, 2", "fx_px"))
def write_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tiles")
    sinks.write_tiles(_tiles(spark, sf_dir), path)
    total = F.round(F.aggregate("image", F.lit(0.0), lambda a, x: a + x), 4)
    return spark.read.parquet(path).select("id", "shard", F.size("image").alias("n_values"), total.alias("total"))


@query(oracle("select tile_id id, cast(tile_id % 4 + 1 as int) shard, any_value(gr // 8 * 448) trow, any_value(gc // 8 * 448) tcol, round(sum(cast(v as float)::double), 4) total from fx_px where gr // 8 between 1 and 3 and gc // 8 between 2 and 6 group by 1, 2", "fx_px"))
def read_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tiles of a window of the mosaic, from the files whose bounds meet it."""
    path = scratch(spark, "placed")
    places = fixture(spark, sf_dir, "fx_px").select(F.col("tile_id").alias("id"), (F.floor(F.col("gr") / 8) * 448).alias("trow"), (F.floor(F.col("gc") / 8) * 448).alias("tcol")).distinct()
    placed = _tiles(spark, sf_dir).join(places, "id")
    sinks.write_tiles(placed, path, "trow", "tcol", per_file=16)
    found = sinks.read_tiles(spark, path, placed.schema, "trow", "tcol", (448, 3 * 448), (2 * 448, 6 * 448))
    return found.select("id", "shard", "trow", "tcol", F.round(F.aggregate("image", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


_META_ROWS = oracle("select id, source, shard, trow, tcol, coverage_ratio, class_ids from fx_tile_meta", "fx_tile_meta")


@query(oracle("select m.*, total_tiles, shards, (select cast(count(*) as bigint) from fx_tile_meta where list_contains(class_ids, 2)) with_roads from fx_meta m, (select cast(count(*) as bigint) total_tiles, cast(count(distinct shard) as bigint) shards from fx_tile_meta)", "fx_tile_meta", fx_meta="select id, source, shard, trow, tcol, coverage_ratio, class_ids from fx_tile_meta"))
def write_tile_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was written, with parts of the summary document."""
    path = scratch(spark, "meta")
    sinks.write_tile_meta(fixture(spark, sf_dir, "fx_tile_meta"), path)
    roads = F.filter("classes", lambda c: c["class_id"] == 2)
    summary = sinks.read_summary(spark, path).select("total_tiles", "shards", F.coalesce(F.get(roads, F.lit(0))["tiles"], F.lit(0)).cast("bigint").alias("with_roads"))
    return sinks.read_tile_meta(spark, path).crossJoin(F.broadcast(summary))


@query(oracle("select cast(count(*) as bigint) total_tiles, cast(count(distinct source) as bigint) sources, cast(count(class_ids) as bigint) with_classes from fx_tile_meta", "fx_tile_meta"))
def read_tile_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "meta")
    sinks.write_tile_meta(fixture(spark, sf_dir, "fx_tile_meta"), path)
    return sinks.read_tile_meta(spark, path).agg(F.count("*").alias("total_tiles"), F.count_distinct("source").alias("sources"), F.count("class_ids").alias("with_classes"))


@query(oracle("select shard, cast(count(*) as bigint) tiles, min(id) first_id from fx_tile_meta where shard = 'shard_2' and coverage_ratio = 1 or shard <> 'shard_2' and coverage_ratio >= 0.5e0 group by 1", "fx_tile_meta"))
def write_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All shards' slices, then a new one for shard_2, twice."""
    path, meta = scratch(spark, "replay"), fixture(spark, sf_dir, "fx_tile_meta")
    sinks.write_replay(meta.where("coverage_ratio >= 0.5"), path)
    for _ in range(2):
        sinks.write_replay(meta.where("coverage_ratio = 1 and shard = 'shard_2'"), path)
    return spark.read.parquet(path).groupBy("shard").agg(F.count("*").alias("tiles"), F.min("id").alias("first_id"))


@query(oracle("select id, source, shard, trow, tcol, coverage_ratio, class_ids from fx_tile_meta where coverage_ratio >= 0.5e0", "fx_tile_meta"))
def read_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "replay")
    sinks.write_replay(fixture(spark, sf_dir, "fx_tile_meta").where("coverage_ratio >= 0.5"), path)
    return sinks.read_replay(spark, path).union(sinks.read_replay(spark, path + "-absent"))


@query(oracle("select tile_id, r, c, cast(target as smallint) class_id from fx_scores", "fx_scores"))
def write_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "mask")
    mask = fixture(spark, sf_dir, "fx_scores").select("tile_id", "r", "c", F.when(F.col("target") != 255, F.col("target")).alias("class_id"))
    sinks.write_mask(mask, path)
    return spark.read.parquet(path)


_HISTORY = oracle("select run_id, cast(epoch as int) epoch, val_miou, val_loss from fx_epochs", "fx_epochs")


@query(_HISTORY)
def write_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "history")
    sinks.write_history(fixture(spark, sf_dir, "fx_epochs"), path)
    rows = spark.read.schema("run_id string, epoch array<int>, val_miou array<double>, val_loss array<double>").json(path)
    return sinks.read_history(rows)


@query(_HISTORY)
def read_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    epochs = fixture(spark, sf_dir, "fx_epochs")
    arrays = epochs.groupBy("run_id").agg(F.sort_array(F.collect_list(F.struct("epoch", "val_miou", "val_loss"))).alias("h")).select("run_id", "h.epoch", "h.val_miou", "h.val_loss")
    return sinks.read_history(arrays)


@query(oracle("select run_id, cast(line_no as bigint) line_no, line from fx_log", "fx_log"))
def read_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "log")
    fixture(spark, sf_dir, "fx_log").select("run_id", F.concat_ws("\t", "line_no", "line").alias("value")).write.partitionBy("run_id").text(path)
    return catalog.read_run_log(spark, path)


_LIST = "case when c_custkey % 5 = 4 then null when c_custkey % 5 = 3 then ' : ' else concat(' CG_', cast(c_custkey as varchar(9)), ' :: CG_', cast(c_nationkey as varchar(9)), ': ') end"


@query(f"""with t as (select c_custkey, {_LIST} txt from customer), l as (select c_custkey, list_filter(list_transform(string_split(txt, ':'), lambda x: trim(x)), lambda x: x <> '') names from t),
d as (select c_custkey, case when coalesce(len(names), 0) > 0 then names else ['CG_1', 'CG_2', 'CG_3', 'CG_4'] end names from l)
select c_custkey, cast(generate_subscripts(names, 1) as int) step, unnest(names) as name from d""")  # fmt: skip
def parse_shard_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "customer").select("c_custkey", F.expr(_LIST).alias("txt"))
    names = catalog.parse_shard_list(F.col("txt"), ["CG_1", "CG_2", "CG_3", "CG_4"])
    return rows.select("c_custkey", F.posexplode(names).alias("step", "name")).withColumn("step", F.col("step") + 1)


@query(oracle("select id, source, shard, trow, tcol, coverage_ratio, class_ids from fx_tile_meta where shard <> 'shard_3'", "fx_tile_meta"))
def clear_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "cleared")
    sinks.write_replay(fixture(spark, sf_dir, "fx_tile_meta"), path)
    sinks.clear_shard(spark, path, "shard_3")
    return sinks.read_replay(spark, path)
