"""Aggregations. The pixel sum queries read the large pixel table too, which grows with lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.fixtures import fixture, oracle
from rasterweave.model import class_map, classes
from rasterweave.operators import metrics, spatial, stats
from rasterweave.registry import query
from rasterweave.session import scratch

SAMPLER, LOSS = class_map(4), class_map(5)
_LONG = "select scene, prow, pcol, unnest([1, 2, 3, 4]) band, unnest([cast(b1 as double), cast(b2 as double), cast(b3 as double), cast(b4 as double)]) v from fx_big_px"


def long_px(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = fixture(spark, sf_dir, "fx_big_px")
    values = F.array(*[F.col(f"b{i}").cast("double") for i in range(1, 5)])
    return wide.select("scene", "prow", "pcol", F.posexplode(values).alias("b", "v")).select("scene", "prow", "pcol", (F.col("b") + 1).alias("band"), "v")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(oracle("select scene, band, min(v) lo, max(v) hi, round(avg(v), 6) mean, round(stddev_pop(v), 6) std from long group by 1, 2", "fx_big_px", long=_LONG))
def band_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.band_stats(long_px(spark, sf_dir), "scene"), "mean", "std")


_RASTERS = "select cast(scene as varchar) raster_id, max(pcol) + 1 width, max(prow) + 1 height from fx_big_px group by 1"


def _hash(*parts: str) -> str:
    return f"cast(concat('0x', substr(md5(concat_ws(':', {', '.join(parts)})), 1, 8)) as bigint)"


_WIN = f"select raster_id, k, {_hash(chr(39) + '42r' + chr(39), 'raster_id', 'cast(k as varchar)')} % greatest(height - 32, 1) win_row, {_hash(chr(39) + '42c' + chr(39), 'raster_id', 'cast(k as varchar)')} % greatest(width - 32, 1) win_col from (select *, unnest(generate_series(0, 19)) k from rasters)"


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = fixture(spark, sf_dir, "fx_big_px")
    rasters = px.groupBy(F.col("scene").cast("string").alias("raster_id")).agg((F.max("pcol") + 1).alias("width"), (F.max("prow") + 1).alias("height"))
    return stats.random_windows(rasters, 20, 32)


@query(oracle("select scene, band, min(v) lo, max(v) hi, round(avg(v), 6) mean, round(stddev_pop(v), 6) std from long join win on raster_id = cast(scene as varchar) and prow between win_row and win_row + 31 and pcol between win_col and win_col + 31 group by 1, 2", "fx_big_px", long=_LONG, rasters=_RASTERS, win=_WIN))
def band_stats_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = _windows(spark, sf_dir).select(F.col("raster_id").cast("int").alias("win_scene"), "win_row", "win_col")
    px = long_px(spark, sf_dir).withColumnsRenamed({"prow": "row", "pcol": "col"})
    covered = spatial.window_cover_join(px, windows, 32).where("scene = win_scene")
    return rounded(stats.band_stats(covered, "scene"), "mean", "std")


@query(oracle("select scene, band, round(quantile_cont(v, 0.02e0), 6) p_lo, round(quantile_cont(v, 0.98e0), 6) p_hi from long group by 1, 2", "fx_big_px", long=_LONG))
def band_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.band_percentiles(long_px(spark, sf_dir), "scene", spread=True), "p_lo", "p_hi")


@query(oracle("select scene, band, min(v) lo, max(v) hi from long group by 1, 2", "fx_big_px", long=_LONG))
def band_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.band_minmax(long_px(spark, sf_dir), "scene")


@query(oracle("select tile_id, avg(cast(cast(ok as int) as double)) valid_ratio, avg(cast(cast(cov as int) as double)) coverage_ratio from (select tile_id, r, c, bool_or(v <> 0) ok, (tile_id + r) % 3 = 0 cov from fx_px group by 1, 2, 3) group by 1", "fx_px"))
def tile_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = fixture(spark, sf_dir, "fx_px").groupBy("tile_id", "r", "c").agg(F.bool_or(F.col("v") != 0).alias("valid")).withColumn("covered", (F.col("tile_id") + F.col("r")) % 3 == 0)
    return stats.tile_ratios(px, "tile_id")


@query(oracle("select tile_id, list_sort(list_distinct(list(target))) class_ids from fx_scores group by 1", "fx_scores"))
def tile_class_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.tile_class_set(fixture(spark, sf_dir, "fx_scores").withColumnRenamed("target", "class_id"), "tile_id")


_COUNTS = """select class_id, label, cast(coalesce(n, 0) as bigint) n_tiles, coalesce(n, 0) * 100e0 / (select count(*) from fx_tile_meta) percent
 from fx_classes left join (select class_id, count(*) n from (select unnest(class_ids) class_id from fx_tile_meta) group by 1) using (class_id)"""


@query(oracle(_COUNTS, "fx_tile_meta", "fx_classes"))
def class_tile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.class_tile_counts(fixture(spark, sf_dir, "fx_tile_meta"), classes(spark))


@query(oracle("""select k.scene, k.tile, class_id, cast(count(*) as bigint) n, round(count(*) / cast(sum(count(*)) over (partition by k.scene, k.tile) as double), 9) share
 from (select scene, tile, class_id from px union all select scene, null, class_id from px union all select null, null, class_id from px) k group by 1, 2, 3""", "fx_big_px", px="select scene, cast(prow // 32 * 8 + pcol // 32 as int) tile, cast((prow + pcol * 3) % 4 as int) class_id from fx_big_px"))  # fmt: skip
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    tile = F.floor(F.col("prow") / 32) * 8 + F.floor(F.col("pcol") / 32)
    mask = fixture(spark, sf_dir, "fx_big_px").select("scene", tile.cast("int").alias("tile"), ((F.col("prow") + F.col("pcol") * 3) % 4).cast("int").alias("class_id"))
    return rounded(stats.class_distribution(mask, "scene", "tile"), "share", digits=9)


_RAREST = "(select arg_max(u.c, w * 100 - u.c) from (select unnest(coalesce(class_ids, [0])) c) u join (select class_id, sampler_w w from fx_classes) k on k.class_id = u.c)"


@query(oracle(f"select id, {_RAREST} rarest from fx_tile_meta", "fx_tile_meta", "fx_classes"))
def rarest_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = fixture(spark, sf_dir, "fx_tile_meta")
    return meta.select("id", stats.rarest_class(F.coalesce("class_ids", F.array(F.lit(0))), SAMPLER).alias("rarest"))


@query(oracle("""select layer, cast(count(*) as bigint) features, list_sort(list_distinct(list(geom_type))) geom_types, min(minx) minx, min(miny) miny, max(maxx) maxx, max(maxy) maxy,
 list_sort(list_distinct(flatten(list(cols)))) as columns from (select concat('layer_', cast(class_id as varchar)) layer, fid, case when fid % 2 = 0 then 'Triangle' else 'Rectangle' end geom_type, case when fid % 2 = 0 then ['id', 'kind'] else ['id', 'name'] end cols,
 min(least(x0, x1)) minx, min(least(y0, y1)) miny, max(greatest(x0, x1)) maxx, max(greatest(y0, y1)) maxy from fx_edges group by class_id, fid) group by 1""", "fx_edges"))  # fmt: skip
def layer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = spatial.edge_boxes(fixture(spark, sf_dir, "fx_edges"), "class_id", "fid")
    even = F.col("fid") % 2 == 0
    text = F.col("fid").cast("string")
    attrs = F.when(even, F.create_map(F.lit("id"), text, F.lit("kind"), F.lit("t"))).otherwise(F.create_map(F.lit("id"), text, F.lit("name"), F.lit("r")))
    features = boxes.withColumns({"layer": F.concat(F.lit("layer_"), "class_id"), "geom_type": F.when(even, "Triangle").otherwise("Rectangle"), "attrs": attrs})
    return stats.layer_summary(features)


@query(oracle("select folder, cast(coalesce(sum(length), 0) as bigint) bytes from (select concat('/raw/shard_', cast(n_nationkey as varchar)) folder from nation) f left join fx_files on regexp_replace(path, '/[^/]*$', '') = folder group by 1", "fx_files"))
def dir_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = fixture(spark, sf_dir, "nation").select(F.concat(F.lit("/raw/shard_"), "n_nationkey").alias("folder"))
    return stats.dir_bytes(fixture(spark, sf_dir, "fx_files"), folders)


_PAIRS = "select tile_id, cast(list_position(logits, list_max(logits)) - 1 as int) pred, target from fx_scores"


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_scores").select("tile_id", metrics.argmax_class(F.col("logits")).alias("pred"), "target")


@query(oracle("select pred, target, cast(count(*) as bigint) n from pairs where target <> 255 group by 1, 2", "fx_scores", pairs=_PAIRS))
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(pairs(spark, sf_dir))


IOU_SQL = """select k.class_id, inter, u as union_, round(case when u > 0 then inter / cast(u as double) end, 9) iou, round(coalesce(avg(case when u > 0 then inter / cast(u as double) end) over (), 0), 9) miou from (
 select class_id, cast(count_if(pred = class_id and target = class_id) as bigint) inter, cast(count_if(pred = class_id or target = class_id) as bigint) u from fx_classes, pairs where target <> 255 group by 1) k"""


@query(oracle(IOU_SQL, "fx_scores", "fx_classes", pairs=_PAIRS))
def iou_miou(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.iou(metrics.confusion_matrix(pairs(spark, sf_dir))).withColumn("class_id", F.col("class_id").cast("int")), "iou", "miou", digits=9)


_P = "select tile_id, r, c, target, exp(logits[1]) / z p0, exp(logits[2]) / z p1, exp(logits[3]) / z p2, exp(logits[4]) / z p3 from (select *, exp(logits[1]) + exp(logits[2]) + exp(logits[3]) + exp(logits[4]) z from fx_scores)"
_FOCAL = "select avg(case when target = 255 then 0 else pow(1 - exp(-ce), 2) * ce end) focal from (select target, -(case target when 0 then 0.4e0 when 1 then 1.2e0 when 2 then 4.0e0 else 2.0e0 end) * ln(case target when 0 then p0 when 1 then p1 when 2 then p2 else p3 end) ce from p)"
_DICE = "select avg((d1 + d2 + d3) / 3) dice from (select tile_id, " + ", ".join(f"1 - (2 * sum(p{i} * h{i}) + 1e-6) / (sum(p{i}) + sum(h{i}) + 1e-6) d{i}" for i in (1, 2, 3)) + " from (select *, case when target = 1 then 1e0 else 0e0 end h1, case when target = 2 then 1e0 else 0e0 end h2, case when target >= 3 then 1e0 else 0e0 end h3 from p) group by 1)"


@query(oracle("select round(focal, 6) focal from f", "fx_scores", p=_P, f=_FOCAL))
def focal_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.focal_loss(fixture(spark, sf_dir, "fx_scores"), LOSS), "focal")


@query(oracle("select round(dice, 6) dice from d", "fx_scores", p=_P, d=_DICE))
def dice_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.dice_loss(fixture(spark, sf_dir, "fx_scores")), "dice")


@query(oracle("select round(focal, 6) focal, round(dice, 6) dice, round(0.5e0 * focal + 0.5e0 * dice, 6) loss from f, d", "fx_scores", p=_P, f=_FOCAL, d=_DICE))
def combined_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.combined_loss(fixture(spark, sf_dir, "fx_scores"), LOSS), "focal", "dice", "loss")


@query("select event_type run_id, case when user_id % 5 = 0 then 'val' else 'train' end phase, cast(extract(day from ts) as int) epoch, round(avg(value), 6) loss from events group by 1, 2, 3")
def epoch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = fixture(spark, sf_dir, "events").select(F.col("event_type").alias("run_id"), F.when(F.col("user_id") % 5 == 0, "val").otherwise("train").alias("phase"), F.dayofmonth("ts").alias("epoch"), F.col("value").alias("loss"))
    return rounded(metrics.epoch_metrics(batches), "loss")


@query(oracle("select run_id, arg_max(epoch, row(val_miou, -epoch)) best_epoch, max(val_miou) best, cast(count(*) as bigint) epochs from fx_epochs group by 1", "fx_epochs"))
def best_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.best_epoch(fixture(spark, sf_dir, "fx_epochs"))


@query(oracle(f"select string_agg(concat(label, '=', cast(n_tiles as varchar)), ', ' order by class_id) coverage from ({_COUNTS})", "fx_tile_meta", "fx_classes"))
def class_coverage_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.class_coverage_string(stats.class_tile_counts(fixture(spark, sf_dir, "fx_tile_meta"), classes(spark)))


@query(oracle("select cast(count(distinct source) as bigint) sources from fx_tile_meta", "fx_tile_meta"))
def distinct_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_tile_meta").agg(F.count_distinct("source").alias("sources"))


@query(oracle("select cast(count(distinct source) as bigint) sources, cast(count(distinct id) as bigint) ids, true near from fx_tile_meta", "fx_tile_meta"))
def distinct_sources_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From sketches that are stored per shard: sources, which are few, come out exact; ids are counted as well, and near tells whether their sketch is within 3 %."""
    meta, path = fixture(spark, sf_dir, "fx_tile_meta"), scratch(spark, "sketches")
    stats.source_sketches(meta, "source", "id").write.partitionBy("shard").parquet(path)
    about = stats.distinct_from_sketches(spark.read.parquet(path), "source", "id")
    exact = meta.agg(F.count_distinct("id").alias("ids"))
    return about.crossJoin(exact).select(F.col("source").alias("sources"), "ids", (F.abs(F.col("id") - F.col("ids")) <= 0.03 * F.col("ids")).alias("near"))


@query(oracle(f"select cast(m.n as bigint) total_tiles, 50e0 budget_gb, round(m.n * 4456448 / 1073741824e0, 6) used_gb, cast(class_id as int) class_id, n_tiles from (select count(*) n from fx_tile_meta) m, ({_COUNTS}) c", "fx_tile_meta", "fx_classes"))
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = fixture(spark, sf_dir, "fx_tile_meta")
    summary = stats.run_summary(meta, stats.class_tile_counts(meta, classes(spark)), 50.0, 4_456_448)
    return rounded(summary.select("total_tiles", "budget_gb", "used_gb", F.explode("class_tile_counts").alias("class_id", "n_tiles")), "used_gb")


