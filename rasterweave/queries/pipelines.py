"""Whole jobs over the fixtures."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.fixtures import fixture, oracle
from rasterweave.model import class_map, classes
from rasterweave.plans import jobs
from rasterweave.queries.aggregations import _RAREST, long_px, rounded
from rasterweave.queries.functions import _BANDS, _GOES, _MIX, _RGB, _RGB8, VARIANTS, bands_of
from rasterweave.queries.joins import _GRID, _INSIDE, _MASK, _OVER, _POINTS, _WINDOWS, prompts
from rasterweave.queries.sampling import _HID, _H
from rasterweave.queries.streams import SHARDS
from rasterweave.queries.windows import _share
from rasterweave.registry import query
from rasterweave.session import scratch
from rasterweave.streaming.shards import land

_LAYERS = "select class_id layer, min(least(x0, x1)) minx, min(least(y0, y1)) miny, max(greatest(x0, x1)) maxx, max(greatest(y0, y1)) maxy, count(distinct fid) features from fx_edges group by 1"


@query(oracle(f"""select raster_id, any_value(cast(width as bigint) * height) pixel_count, any_value(cast(width as bigint) * height * n_bands * itemsize / 1048576) raw_mb, any_value(cast(width as bigint) * height * n_bands * itemsize / 1048576 > 4096) large,
 coalesce(string_agg(cast(layer as varchar), ',' order by cast(layer as varchar)), 'none') layers, cast(coalesce(sum(features), 0) as bigint) features, any_value(m) band_means from fx_rasters r left join ({_LAYERS}) l on {_OVER}
 left join (select concat('scene_', cast(scene as varchar)) id, [round(avg(cast(b1 as double)), 6), round(avg(cast(b2 as double)), 6), round(avg(cast(b3 as double)), 6), round(avg(cast(b4 as double)), 6)] m from fx_big_px group by 1) s on s.id = raster_id group by 1""", "fx_rasters", "fx_edges", "fx_big_px"))  # fmt: skip
def inspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = long_px(spark, sf_dir).select(F.concat(F.lit("scene_"), "scene").alias("raster_id"), "band", F.col("v").cast("double").alias("v"))
    return jobs.inspect(fixture(spark, sf_dir, "fx_rasters"), fixture(spark, sf_dir, "fx_edges"), pixels)


_SHADED = """select gr, gc, bool_or(v <> 0) ok, avg(least(greatest((v - lo) / (hi - lo + 1e-6), 0), 1)) shade from fx_px join (select band, quantile_cont(v, 0.02e0) lo, quantile_cont(v, 0.98e0) hi from fx_px group by 1) using (band) group by 1, 2"""
_TILED = """select tr * 12 tile_row, tc * 12 tile_col, avg(case when ok then 1e0 else 0e0 end) valid_ratio, avg(case when class_id > 0 then 1e0 else 0e0 end) coverage_ratio, list_sort(list_distinct(list(class_id))) class_ids, avg(shade) shade
 from (select gr, gc, ok, shade, coalesce(class_id, 0) class_id from shaded left join mask on mask.row = gr and mask.col = gc) p, (select range tr from range(50)), (select range tc from range(50))
 where gr between tr * 12 and tr * 12 + 15 and gc between tc * 12 and tc * 12 + 15 and tr * 12 + 16 <= (select max(gr) + 1 from fx_px) and tc * 12 + 16 <= (select max(gc) + 1 from fx_px) group by 1, 2"""
_KEPT = f"select *, printf('scene_r%06d_c%06d', tile_row, tile_col) id, {_RAREST} rarest from tiled where valid_ratio >= 0.1e0 and coverage_ratio >= 0.05e0"
_TOKENS40 = f"select class_id, cast(case when class_id = 0 then t + 40 - sum(t) over () else t end as bigint) tokens from (select class_id, {_share(40)} t from fx_classes)"
#: Bytes of a tile of 16 pixels with four bands; the budget is met within the 13th.
_ONE, _BUDGET = 16 * 16 * 17, 12 * 16 * 16 * 17 + 1
_CHOSEN = f"select * from (select *, coalesce(sum({_ONE}) over (order by lpad(cast({_HID} as varchar), 10, '0') || ':' || id rows between unbounded preceding and 1 preceding), 0) before from (select *, row_number() over (partition by rarest order by id) rn from kept) join tokens on class_id = rarest where rn <= tokens) where before < {_BUDGET}"


@query(oracle(f"select id, tile_row, tile_col, round(valid_ratio, 9) valid_ratio, round(coverage_ratio, 9) coverage_ratio, class_ids, rarest, round(shade, 6) shade, cast(count(*) over () as bigint) total_tiles, round(count(*) over () * {_ONE} / 1073741824e0, 9) used_gb from chosen", "fx_px", "fx_edges", "fx_classes", grid=_GRID, inside=_INSIDE, mask=_MASK, shaded=_SHADED, tiled=_TILED, kept=_KEPT, tokens=_TOKENS40, chosen=_CHOSEN))
def preprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jobs.preprocess(fixture(spark, sf_dir, "fx_px"), fixture(spark, sf_dir, "fx_edges"), classes(spark), class_map(4), "scene", 16, 12, 40, _BUDGET)
    return rounded(rounded(out, "valid_ratio", "coverage_ratio", "used_gb", digits=9), "shade")


_CURRENT = "select id, class_ids, row_number() over (order by lpad(cast(" + _HID + " as varchar), 10, '0') || ':' || id) > ceil(count(*) over () * 0.2e0) train from fx_tile_meta where shard = 'shard_1'"
_BOTH = "select id, class_ids, 'current' origin from current where train union all select id, class_ids, 'replay' from fx_tile_meta where shard = 'shard_2' and coverage_ratio = 1"
_WEIGHED = f"select id, origin, case when origin = 'replay' then least(nc * 0.3e0 / greatest(nr * 0.7e0, 1), 5) * own else own end w from (select id, origin, (select sampler_w from fx_classes where class_id = {_RAREST}) own from mixed), (select count_if(origin = 'current') nc, count_if(origin = 'replay') nr from mixed)"
_DRAWS = "select k, cast(floor(cast(concat('0x', substr(md5(concat('42:', cast(k as varchar))), 1, 8)) as bigint) / 4294967296e0 * (select sum(iw) from items)) as bigint) p from (select range k from range((select count(*) // 2 * 2 from weighed)))"


@query(oracle("select k, id, origin, round(w, 9) w, k // 2 batch from draws asof join (select *, coalesce(sum(iw) over (order by id rows between unbounded preceding and 1 preceding), 0)::bigint b from items) i on p >= b", "fx_tile_meta", "fx_classes", current=_CURRENT, mixed=_BOTH, weighed=_WEIGHED, items="select *, cast(floor(w * 1000000 + 0.5e0) as bigint) iw from weighed", draws=_DRAWS))
def build_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = fixture(spark, sf_dir, "fx_tile_meta")
    out = jobs.build_training_set(meta.where("shard = 'shard_1'"), meta.where("shard = 'shard_2' and coverage_ratio = 1"), class_map(4))
    return rounded(out.select("k", "id", "origin", "w", "batch"), "w", digits=9)


def _scorer(bands: Column, r: Column, c: Column) -> Column:
    """Logits that lean on the place in the window; null for a band that is not there."""
    return F.array(*[4 * F.get(bands, F.lit(i)) * (1 + r / 16) + (0.1 * i) * c / 16 for i in range(4)])


_SCALED = "select gr as row, gc as col, list((v - lo) / (hi - lo) order by band) b from fx_px join (select band, min(v) lo, max(v) hi from fx_px group by 1) using (band) group by 1, 2"
_PLACES = "select row, col, win_row, win_col, b, row - win_row r, col - win_col c from scaled join windows on row between win_row and win_row + 15 and col between win_col and win_col + 15"
_W = "exp(-((r - 8) * (r - 8) + (c - 8) * (c - 8)) / 32e0)"
_EXP = " union all ".join("select row, col, " + _W + " w, " + ", ".join("exp(4 * b[{}] * (1 + ({}) / 16e0) + (0.1e0 * {}) * ({}) / 16e0) e{}".format(i + 1, *(x.replace("7 -", "15 -") for x in _GOES[name].split(", ")[:1]), i, *(x.replace("7 -", "15 -") for x in _GOES[name].split(", ")[1:]), i) for i in range(4)) + " from places" for name in VARIANTS)
_BEST = "select row, col, cast(list_position(p, list_max(p)) - 1 as int) class_id from (select row, col, [" + ", ".join(f"sum(e{i} / (e0 + e1 + e2 + e3) * w) / greatest(sum(w), 1e-6)" for i in range(4)) + "] p from scored group by 1, 2)"
_PREDICTED = "select row, col, coalesce(arg_max(p.class_id, seq), any_value(m.class_id)) class_id from best m left join points p on row >= floor(y) - 5 and row < floor(y) + 5 and col >= floor(x) - 5 and col < floor(x) + 5 group by 1, 2"


_PREDICT = oracle("select class_id, cast(count(*) as bigint) n, round(count(*) / cast(sum(count(*)) over () as double), 6) share from predicted group by 1", "fx_px", "fx_prompts", "fx_classes", windows=_WINDOWS, scaled=_SCALED, places=_PLACES, scored=_EXP, best=_BEST, points=_POINTS, predicted=_PREDICTED)


@query(_PREDICT)
def predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class distribution of the predicted mask."""
    from rasterweave.operators.stats import class_distribution

    px = fixture(spark, sf_dir, "fx_px")
    places = px.select(F.col("gr").alias("row"), F.col("gc").alias("col")).distinct()
    last = places.agg(F.max("row").alias("h"), F.max("col").alias("w"))
    windows = places.where("row % 6 = 0 and col % 6 = 0").crossJoin(F.broadcast(last)).select(F.least("row", F.col("h") - 15).alias("win_row"), F.least("col", F.col("w") - 15).alias("win_col")).distinct()
    mask = jobs.predict(px.select("band", "gr", "gc", "v"), windows, 16, prompts(spark, sf_dir), _scorer)
    return rounded(class_distribution(mask), "share")


def _array_scorer(windows: np.ndarray) -> np.ndarray:
    """The same logits over whole windows."""
    r, c = np.mgrid[0 : windows.shape[2], 0 : windows.shape[3]]
    return np.stack([4 * windows[:, i] * (1 + r / 16) + 0.1 * i * c / 16 for i in range(4)], axis=1)


@query(_PREDICT)
def predict_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As predict, from packed windows in blocks of 32 pixels."""
    from rasterweave.operators.stats import class_distribution

    mask = jobs.predict_blocks(fixture(spark, sf_dir, "fx_px").select("band", "gr", "gc", "v"), 16, 6, prompts(spark, sf_dir), _array_scorer, block=32)
    return rounded(class_distribution(mask), "share")


_TILES = "select tile_id id, concat('scene_', cast(tile_id % 20 as varchar)) source, list_sort(list_distinct(list(target))) class_ids from fx_scores group by 1"
_VAL = f"select * from tiles where source in (select source from (select source, row_number() over (order by lpad(cast({_H.format('source')} as varchar), 10, '0') || ':' || source) rn, count(*) over () n from (select distinct source from tiles)) where rn <= ceil(n * 0.2e0))"
_SAMPLED = f"select id, source, (select string_agg(coalesce(label, concat('cls', c)), '|' order by c) from (select unnest(class_ids) c) u left join fx_classes on class_id = c) labels from (select * from (select * from val order by {_HID}, id limit 200) where list_contains(class_ids, 2)) order by {_HID}, id limit 50"
_SHARES = "select tile_id id, string_agg(concat(cast(target as varchar), ':', cast(round(n * 1000 / t) as int)), ',' order by target) shares from (select tile_id, target, count(*) n, sum(count(*)) over (partition by tile_id) t from fx_scores group by 1, 2) group by 1"


@query(oracle(f"""select id, source, labels, shares, r, c, rgb, k colour, case when target = 0 then rgb else {_MIX} end overlay from (select id, source, labels, shares, f.r, f.c, target, {_RGB8} rgb, {_RGB.format('target')} k
 from sampled join shares using (id) join fx_scores f on f.tile_id = id join bb on bb.tile_id = f.tile_id and bb.r = f.r and bb.c = f.c)""", "fx_px", "fx_scores", "fx_classes", bb=_BANDS, tiles=_TILES, val=_VAL, sampled=_SAMPLED, shares=_SHARES))  # fmt: skip
def sample_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = fixture(spark, sf_dir, "fx_scores").select(F.col("tile_id").alias("id"), "r", "c", F.col("target").alias("class_id"))
    tiles = scores.groupBy("id").agg(F.sort_array(F.collect_set("class_id")).alias("class_ids")).withColumn("source", F.concat(F.lit("scene_"), F.col("id") % 20))
    out = jobs.sample_report(tiles, bands_of(fixture(spark, sf_dir, "fx_px")).withColumnRenamed("tile_id", "id"), scores, 2, 50)
    shares = F.array_join(F.transform(F.map_entries("shares"), lambda e: F.concat(e["key"].cast("string"), F.lit(":"), F.round(e["value"] * 1000).cast("int").cast("string"))), ",")
    return out.withColumn("shares", shares)


RUN_CEILING, RUN_TILE, RUN_REPLAY = 2 << 30, 64 << 20, 12


def labelled_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled pixels of the small tiles, a quarter of the tiles to a shard."""
    px, scores = fixture(spark, sf_dir, "fx_px"), fixture(spark, sf_dir, "fx_scores").select("tile_id", "r", "c", "target")
    wide = bands_of(px).join(scores, ["tile_id", "r", "c"])
    return wide.select(F.col("tile_id").cast("string").alias("id"), F.concat(F.lit("shard_"), F.col("tile_id") % 4 + 1).alias("shard"), "r", "c", "bands", "target")


def _run_sql() -> str:
    """Shard after shard, as each depends on what those before have left in the store."""
    ctes = {
        "bb": _BANDS, "lab": "select cast(tile_id as varchar) id, tile_id % 4 s, r, c, bands b, target from bb join fx_scores using (tile_id, r, c)",
        "usable": f"select *, {_RAREST} rarest from (select id, s, avg(case when b[1] <> 0 or b[2] <> 0 or b[3] <> 0 or b[4] <> 0 then 1e0 else 0e0 end) ok, avg(case when target > 0 and target <> 255 then 1e0 else 0e0 end) coverage, list_sort(list_distinct(list(target) filter (where target <> 255))) class_ids from lab group by 1, 2) where ok >= 0.1e0 and coverage >= 0.05e0",
    }
    out = []
    for s in range(4):
        before = " union all ".join(f"select id, rarest from rep{i}" for i in range(s)) or "select id, rarest from usable where false"
        far = " + ".join(f"(b[{i}] - m{i}) * (b[{i}] - m{i})" for i in range(1, 5))
        ctes |= {
            f"old{s}": before, f"bud{s}": f"select greatest({RUN_CEILING} - {RUN_TILE} * count(*), 1073741824) budget, {RUN_TILE} * count(*) held from old{s}",
            f"adm{s}": f"select * from (select *, coalesce(sum({RUN_TILE}) over (order by id rows between unbounded preceding and 1 preceding), 0) before from usable where s = {s}) where before < (select budget from bud{s})",
            f"rep{s}": f"select id, rarest from (select *, row_number() over (partition by rarest order by coverage desc, id) rn from adm{s}) join (select class_id, {_share(RUN_REPLAY)} quota from fx_classes where class_id in (select rarest from adm{s})) on class_id = rarest where rn <= quota",
            f"cut{s}": f"select id, rarest, row_number() over (order by lpad(cast({_HID} as varchar), 10, '0') || ':' || id) > ceil(count(*) over () * 0.2e0) train from adm{s}",
            f"mix{s}": f"select id, rarest, 'current' origin from cut{s} where train union all select id, rarest, 'replay' from old{s}",
            f"wei{s}": f"select id, cast(floor((case when origin = 'replay' then least(nc * 0.3e0 / greatest(nr * 0.7e0, 1), 5) * w else w end) * 1000000 + 0.5e0) as bigint) iw from (select id, origin, (select sampler_w from fx_classes where class_id = rarest) w from mix{s}), (select count_if(origin = 'current') nc, count_if(origin = 'replay') nr from mix{s})",
            f"pts{s}": f"select k, cast(floor(cast(concat('0x', substr(md5(concat('42:', cast(k as varchar))), 1, 8)) as bigint) / 4294967296e0 * (select sum(iw) from wei{s})) as bigint) p from (select range k from range((select count(*) // 2 * 2 from wei{s})))",
            f"dra{s}": f"select k, id from pts{s} asof join (select *, coalesce(sum(iw) over (order by id rows between unbounded preceding and 1 preceding), 0)::bigint b from wei{s}) i on p >= b",
            f"mea{s}": f"select target, {', '.join(f'avg(b[{i}]) m{i}' for i in range(1, 5))} from dra{s} join lab using (id) where target <> 255 group by 1",
            f"pre{s}": f"select l.target, (select arg_min(m.target, row({far}, m.target)) from mea{s} m) pred from lab l join cut{s} using (id) where not train and l.target <> 255",
            f"iou{s}": f"select coalesce(avg(inter / cast(u as double)), 0) miou from (select k, count_if(pred = k and target = k) inter, count_if(pred = k or target = k) u from pre{s}, (select unnest(range(4)) k) group by 1) where u > 0",
        }
        out.append(f"select {s} s, budget, held, (select count(*) from adm{s}) n, (select count(*) from dra{s}) drawn, miou from bud{s}, iou{s}")
    ctes["every"] = " union all ".join(out)
    e4 = "cast(floor(miou * 10000 + 0.5e0) as int)"
    return oracle(f"""select cast(s as bigint) batch, concat('shard_', cast(s + 1 as varchar)) shard, 'done' status, cast(budget as bigint) budget, n admitted, drawn train_rows, drawn // 2 train_batches, round(miou, 6) val_miou, held < {RUN_CEILING} replay_ok, budget >= 1 budget_ok, held + n * {RUN_TILE} <= {RUN_CEILING} * 1.02e0 total_ok,
'complete' kind, case when {e4} / 10000e0 > 0.6 then 'good' when {e4} / 10000e0 > 0.4 then 'fair' else 'poor' end severity, concat('[shard_', cast(s + 1 as varchar), '] done (', cast(s + 1 as varchar), '/4), best mIoU 0.', lpad(cast({e4} as varchar), 4, '0'), ' at epoch 1 of 1') subject, case when s < 3 then concat('next: folder ', cast(s + 2 as varchar)) else 'all folders are done' end next_step from every""", "fx_px", "fx_scores", "fx_classes", **ctes)  # fmt: skip


@query(_run_sql())
def incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From landed pixels to alerts. Budgets bind: a tile counts as 64 MB of 2 GB."""
    pixels = labelled_shards(spark, sf_dir)
    path, folder = scratch(spark, "landed"), scratch(spark, "run")
    land(pixels, path, "shard", SHARDS)
    out = jobs.incremental_run(spark, path, pixels.schema, scratch(spark, "checkpoint"), folder, class_map(4), classes(spark), RUN_REPLAY, RUN_CEILING, RUN_TILE, 4, jobs.mean_fit(4))
    return rounded(out, "val_miou")
