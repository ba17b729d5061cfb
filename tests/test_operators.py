"""Worked examples, properties, edges and plans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rasterweave.fixtures import fixture
from rasterweave.functions import geo, grid
from rasterweave.model import class_map, classes
from rasterweave.operators import augment, filters, metrics, scoring, selection, spatial, stats
from rasterweave.sources import catalog, sinks
from rasterweave.streaming import progress

SF = "/root/testdata/sf0.001"
EDGE = "fid bigint, class_id int, x0 bigint, y0 bigint, x1 bigint, y1 bigint"


def ring(fid, points, class_id=1):
    return [(fid, class_id, *points[i], *points[(i + 1) % len(points)]) for i in range(len(points))]


def test_triangle_burns_pixels_whose_centres_are_inside(spark):
    edges = spark.createDataFrame(ring(1, [(0, 0), (6, 0), (0, 6)]), EDGE)
    got = {(r.row, r.col) for r in spatial.rasterize_polygons(edges, "fid", height=8, width=8).collect()}
    assert got == {(y, x) for y in range(8) for x in range(8) if (x + 0.5) + (y + 0.5) < 6}


def test_hole_is_left_out_and_all_touched_holds_the_centre_rule(spark):
    edges = spark.createDataFrame(ring(1, [(0, 0), (8, 0), (8, 8), (0, 8)]) + ring(1, [(2, 2), (6, 2), (6, 6), (2, 6)]), EDGE)
    inside = {(r.row, r.col) for r in spatial.rasterize_polygons(edges, "fid", height=8, width=8).collect()}
    assert len(inside) == 64 - 16
    touched = {(r.row, r.col) for r in spatial.rasterize_all_touched(edges, "fid", height=8, width=8).collect()}
    assert inside <= touched


def test_no_edges_burn_nothing(spark):
    assert spatial.rasterize_polygons(spark.createDataFrame([], EDGE), "fid", height=8, width=8).count() == 0


def test_tokens_of_300(spark):
    got = {r.class_id: r.tokens for r in selection.allocate_tokens(classes(spark), 300).collect()}
    assert got == {0: 9, 1: 46, 2: 153, 3: 92}


def test_replay_quota_is_trimmed_from_the_largest(spark):
    got = {r.class_id: r.quota for r in selection.allocate_replay(classes(spark), 3).collect()}
    assert sum(got.values()) == 3


def test_quota_above_the_pool_takes_all(spark):
    meta = spark.createDataFrame([("a", 0.5, [1]), ("b", None, None), ("c", 0.9, [1, 2])], "id string, coverage_ratio double, class_ids array<int>")
    assert {r.id for r in selection.replay_select(meta, classes(spark), class_map(4), 100).collect()} == {"a", "b", "c"}


def test_percentiles_interpolate(spark):
    px = spark.createDataFrame([(1, float(v)) for v in (1, 5, 2.5, 9, 7.25, 3, 0)], "band int, v double")
    row = stats.band_percentiles(px).first()
    assert (round(row.p_lo, 6), round(row.p_hi, 6)) == (0.12, 8.79)


def test_constant_band_scales_to_zero(spark):
    px = spark.createDataFrame([(1, 5.0), (1, 5.0)], "band int, v double")
    assert [r.v for r in stats.minmax_scale(px).collect()] == [0.0, 0.0]


@pytest.mark.parametrize("name", list(grid.SYMMETRIES))
def test_symmetry_and_its_inverse(name):
    f, back = grid.SYMMETRIES[name], grid.SYMMETRIES[grid.INVERSE.get(name, name)]
    assert all(back(*f(r, c, 5), 5) == (r, c) for r in range(5) for c in range(5))


def test_tta_of_a_constant_scorer_is_the_constant(spark):
    px = fixture(spark, SF, "fx_px").where("band = 1").select("tile_id", "r", "c", "v")
    scored = scoring.tta_variants(px, 8).withColumn("probs", F.array(F.lit(0.25)))
    out = scoring.tta_average(scoring.tta_undo(scored, 8), ["tile_id", "r", "c"], 1)
    assert out.count() == px.count() and out.where("probs[0] <> 0.25").isEmpty()


def test_blend_of_constants_is_the_constant(spark):
    rows = spark.createDataFrame([(r, c, w, 0, [0.1, 0.2, 0.3, 0.4]) for r in range(8) for c in range(8) for w in (0, 4) if w <= r < w + 8], "row int, col int, win_row int, win_col int, probs array<double>")
    out = scoring.blend_windows(rows, 8).select(F.round(F.col("probs")[3], 9).alias("p"))
    assert {r.p for r in out.collect()} == {0.4}


def test_class_shares_add_up_at_each_level(spark):
    mask = spark.createDataFrame([("a", 1, 0), ("a", 1, 1), ("a", 2, 1), ("b", 1, 3)], "scene string, tile int, class_id int")
    sums = stats.class_distribution(mask, "scene", "tile").groupBy("scene", "tile").agg(F.round(F.sum("share"), 9).alias("s")).collect()
    assert len(sums) == 6 and {r.s for r in sums} == {1.0}


def test_iou_without_pixels(spark):
    empty = spark.createDataFrame([], "pred int, target int, n bigint")
    rows = metrics.iou(empty).collect()
    assert len(rows) == 4 and all(r.iou is None and r.miou == 0.0 for r in rows)


def test_split_is_disjoint_and_exhaustive(spark):
    ids = fixture(spark, SF, "fx_tile_meta").select("id")
    split = selection.train_val_split(ids, "id")
    assert split.count() == ids.count() and split.select("id").distinct().count() == ids.count()
    assert split.where("is_val").count() == -(-ids.count() // 5)


def test_prefix_cap_admits_a_prefix(spark):
    tiles = spark.range(1000).select(F.format_string("%05d", "id").alias("id"), (F.col("id") % 7 + 1).alias("bytes"))
    kept = sorted(r.id for r in selection.cap_by_bytes(tiles, 500).collect())
    assert kept == [f"{i:05d}" for i in range(len(kept))] and sum(i % 7 + 1 for i in range(len(kept) - 1)) < 500 <= sum(i % 7 + 1 for i in range(len(kept)))


def test_malformed_prompts_are_rejected(spark):
    rows = spark.createDataFrame([(1, "1,2,road"), (2, "x,2,road"), (3, "1,2"), (4, None), (5, " 3 , 4 , lake ")], "seq int, txt string")
    good, bad = filters.parse_prompts(rows)
    assert {r.seq for r in good.collect()} == {1, 5} and {r.seq for r in bad.collect()} == {2, 3, 4}
    assert [r.seq for r in filters.validate_class(good, classes(spark), False).collect()] == [5]


def test_last_prompt_wins_and_outside_paints_nothing(spark):
    mask = spark.range(20).select(F.col("id").alias("row"), F.lit(3).cast("bigint").alias("col"), F.lit(0).alias("class_id"))
    prompts = spark.createDataFrame([(1, 3.0, 5.0, 1), (2, 3.0, 9.0, 2), (3, -90.0, -90.0, 3)], "seq int, x double, y double, class_id int")
    got = {r.row: r.class_id for r in spatial.point_prompt_override(mask, prompts).collect()}
    assert [got[i] for i in range(20)] == [1] * 4 + [2] * 10 + [0] * 6


def test_raster_smaller_than_a_tile(spark):
    small = spark.createDataFrame([("a", 100, 90)], "raster_id string, width int, height int")
    assert grid.tile_grid(small).count() == 0
    assert [(r.win_row, r.win_col) for r in grid.sliding_grid(small).collect()] == [(0, 0)]


def test_unknown_reference_system_is_an_error():
    with pytest.raises(ValueError, match="EPSG"):
        geo.reproject(F.lit(1.0), F.lit(2.0), 4326, 27700)


def test_reprojection_there_and_back(spark):
    pts = spark.createDataFrame([(78.5, 17.25), (82.9, -33.0), (81.0, 0.0)], "lon double, lat double")
    for epsg in (3857, 32644):
        x, y = geo.reproject(F.col("lon"), F.col("lat"), 4326, epsg)
        lon, lat = geo.reproject(F.col("x"), F.col("y"), epsg, 4326)
        out = pts.withColumns({"x": x, "y": y}).select((F.abs(lon - F.col("lon")) + F.abs(lat - F.col("lat"))).alias("d"))
        assert max(r.d for r in out.collect()) < 1e-7


def test_resume_outside_is_an_error(spark):
    with pytest.raises(ValueError, match="outside"):
        filters.resume_from(spark.range(3).withColumnRenamed("id", "step"), 9, 4)


def test_absent_replay_is_empty_and_absent_meta_fails(spark, tmp_path):
    assert sinks.read_replay(spark, f"file://{tmp_path}/none").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sinks.read_tile_meta(spark, f"file://{tmp_path}/none")


def test_flip_twice_is_nothing(spark):
    px = fixture(spark, SF, "fx_px").select("tile_id", "band", "r", "c", "v")
    assert augment.moved(augment.moved(px, "rot90", 8), "rot270", 8).exceptAll(px).isEmpty()


@pytest.mark.parametrize("build", [
    lambda s: spatial.grid_bbox_join(spatial.edge_boxes(fixture(s, SF, "fx_edges"), "fid"), spatial.edge_boxes(fixture(s, SF, "fx_edges").withColumnRenamed("fid", "other"), "other"), "fid", "other", 32.0),
    lambda s: spatial.rasterize_polygons(fixture(s, SF, "fx_edges"), "fid", height=104, width=80),
    lambda s: spatial.window_cover_join(s.range(100).select(F.col("id").alias("row"), F.col("id").alias("col")), s.range(9).select(F.col("id").alias("win_row"), F.col("id").alias("win_col")), 16),
])
def test_spatial_joins_have_no_nested_loop(spark, build):
    plan = build(spark)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_window_predicates_reach_the_scan(spark, tmp_path):
    path = f"file://{tmp_path}/blocks"
    catalog.to_blocks(fixture(spark, SF, "fx_px"), 8, 8).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = catalog.read_window(spark.read.parquet(path), [1], 0, 0, 8, 8, 8, 8)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(block_row" in plan


def test_closed_windows_of_the_stream_equal_the_batch(spark, tmp_path):
    events = fixture(spark, SF, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("run_id"), "value")
    events.repartitionByRange(3, "ts").write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp, run_id string, value double").parquet(f"file://{tmp_path}/in")
    out = progress.drained(progress.progress_snapshots(progress.watermarked(stream)), f"file://{tmp_path}/cp", f"file://{tmp_path}/out")
    batch = progress.progress_snapshots(events)
    assert out.count() > 0 and out.exceptAll(batch).isEmpty()
