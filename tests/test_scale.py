"""What keeps work in proportion: bounded covers of boxes, clipped edges, bracketed percentiles, sketches, tile files by place; and fitted classifiers against plain numbers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterweave.model import class_map
from rasterweave.operators import scoring, spatial, stats, tile_udfs
from rasterweave.sources import sinks

BOX = "id bigint, minx double, miny double, maxx double, maxy double"


def boxes(n: int, seed: int) -> list[tuple]:
    draw = random.Random(seed)
    out = []
    for i in range(n):
        w, h = (10 ** draw.uniform(-2, 5) for _ in range(2))
        x, y = draw.uniform(-5e4, 5e4), draw.uniform(-5e4, 5e4)
        out.append((i, x, y, x + w, y + h))
    return out + [(n, -1e9, -1e9, 1e9, 1e9), (n + 1, 0.0, 0.0, 32.0, 32.0), (n + 2, 32.0, 0.0, 64.0, 32.0), (n + 3, 5.0, 5.0, 5.0, 5.0), (n + 4, None, 0.0, 1.0, 1.0), (n, -1e9, -1e9, 1e9, 1e9)]


def test_boxes_of_any_size_meet_in_few_cells(spark):
    left, right = boxes(250, 1), boxes(250, 2)
    a, b = (spark.createDataFrame(x, BOX) for x in (left, right))
    got = sorted(tuple(r) for r in spatial.grid_bbox_join(a, b.withColumnRenamed("id", "other"), "id", "other", 32.0).collect())
    meets = lambda p, q: None not in (*p, *q) and p[1] < q[3] and p[3] > q[1] and p[2] < q[4] and p[4] > q[2]
    assert got == sorted({(p[0], q[0]) for p in left for q in right if meets(p, q)}) and len(got) > 500
    prefixed = a.select("id", *[F.col(c).alias(f"l_{c}") for c in ("minx", "miny", "maxx", "maxy")])
    levels = [r[0] for r in prefixed.select(spatial.level_of("l_", 32.0)).distinct().collect() if r[0] is not None]
    most = spatial.cells(prefixed, "l_", 32.0, levels).groupBy("id", "at").count().agg(F.max("count")).first()[0]
    assert most <= 8 and max(levels) > 20  # the box of 2 * 10**9 stands there twice


def test_edges_cost_what_is_left_of_them(spark):
    """A polygon a million times the raster becomes as many rows as the raster has."""
    far = 10**9
    edges = spark.createDataFrame([(1, -far, -far, far, -far), (1, far, -far, far, far), (1, far, far, -far, far), (1, -far, far, -far, -far), (2, 3, -far, 3, far), (2, 3, far, 6, far), (2, 6, far, 6, -far), (2, 6, -far, 3, -far)], "fid bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
    got = spatial.rasterize_polygons(edges, "fid", height=8, width=8)
    assert {(r.fid, r.row, r.col) for r in got.collect()} == {(1, r, c) for r in range(8) for c in range(8)} | {(2, r, c) for r in range(8) for c in range(3, 6)} and got.count() == 88
    touched = {(r.fid, r.row, r.col) for r in spatial.rasterize_all_touched(edges, "fid", height=8, width=8).collect()}
    assert touched == {(1, r, c) for r in range(8) for c in range(8)} | {(2, r, c) for r in range(8) for c in range(3, 7)}


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_bracketed_percentiles_are_exact(spark, accuracy):
    draw = np.random.default_rng(6)
    groups = {"normal": draw.normal(0, 1, 5000), "ties": draw.integers(0, 3, 4000).astype(float), "constant": np.full(1000, 2.5), "skewed": np.concatenate((np.zeros(4900), draw.exponential(1, 100))), "one": np.array([7.0]), "two": np.array([1.0, 2.0]), "wide": 10.0 ** draw.uniform(-300, 300, 3000)}
    rows = [(k, 1, float(x)) for k, v in groups.items() for x in v] + [(None, 2, float(x)) for x in range(101)] + [("normal", 1, None), ("nothing", 1, None)]
    pixels = spark.createDataFrame(rows, "raster string, band int, v double").repartition(6)
    for low, high in ((0.02, 0.98), (0.5, 0.5), (0.0, 1.0), (0.3, 0.301)):
        got = {(r.raster, r.band): (r.p_lo, r.p_hi) for r in stats.band_percentiles(pixels, "raster", low=low, high=high, spread=True, accuracy=accuracy).collect()}
        assert set(got) == {(k, 1) for k in groups} | {(None, 2)}
        for k, v in (*groups.items(), (None, np.arange(101.0))):
            for p, x in zip((low, high), got[k, 2 if k is None else 1], strict=True):
                assert math.isclose(x, float(np.quantile(v, p)), rel_tol=1e-12, abs_tol=1e-12), (k, p)
    few = stats.band_percentiles(pixels, "raster", spread=True, accuracy=accuracy)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in few


def test_sketches_of_shards_add_up(spark):
    rows = spark.range(40_000).select(F.concat(F.lit("s"), F.col("id") % 4).alias("shard"), (F.col("id") % 30_000).alias("id"), (F.col("id") % 17).alias("source"))
    sketches = stats.source_sketches(rows, "source", "id")
    assert sketches.count() == 4
    about = stats.distinct_from_sketches(sketches, "source", "id").first()
    assert about.source == 17 and abs(about.id - 30_000) < 0.03 * 30_000
    grown = stats.distinct_from_sketches(sketches.union(stats.source_sketches(rows.limit(0).union(spark.createDataFrame([("s9", 99_999, 99)], "shard string, id bigint, source bigint")), "source", "id")), "source", "id").first()
    assert grown.source == 18


def test_tiles_are_written_by_several_tasks_and_read_by_place(spark, tmp_path):
    path, n = f"file://{tmp_path}/tiles", 32
    tiles = spark.range(n * n).select("id", F.when(F.col("id") % 7 == 0, "b").otherwise("a").alias("shard"), (F.floor(F.col("id") / n) * 448).alias("trow"), (F.col("id") % n * 448).alias("tcol"))
    sinks.write_tiles(tiles, path, "trow", "tcol", per_file=64)
    bounds = spark.read.parquet(f"{path}-bounds").collect()
    assert sum(b.tiles for b in bounds) == n * n and len([b for b in bounds if b.shard == "a"]) >= 8 and max(b.tiles for b in bounds) < 200
    window = lambda df: df.where(F.col("trow").between(4 * 448, 9 * 448) & F.col("tcol").between(20 * 448, 24 * 448))
    found = sinks.read_tiles(spark, path, tiles.schema, "trow", "tcol", (4 * 448, 9 * 448), (20 * 448, 24 * 448))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, window(tiles).collect())) and len(found.inputFiles()) < len(bounds) / 2
    assert sinks.read_tiles(spark, path, tiles.schema, "trow", "tcol", (-9, -1), (0, 9)).count() == 0
    sinks.write_tiles(tiles, path, per_file=100)
    assert spark.read.parquet(path).count() == n * n and len(spark.read.parquet(path).inputFiles()) >= 8
    keys = spark.range(4096).select(sinks.z_order(F.floor(F.col("id") / 64), F.col("id") % 64).alias("z")).distinct()
    assert keys.count() == 4096 and keys.agg(F.max("z")).first()[0] == 4095


def test_a_classifier_learns_what_weighted_regression_learns(spark):
    """Separable classes are told apart on tiles that it has not seen; probabilities add up, and class weights move the border."""
    draw = np.random.default_rng(8)
    centre = np.array([[0, 0], [4, 0], [0, 4], [4, 4]])
    rows = [(int(i), *map(float, centre[i % 4] + draw.normal(0, 0.6, 2)), int(i % 4)) for i in range(800)]
    px = spark.createDataFrame(rows, "tile_id bigint, b1 double, b2 double, target int")
    model = tile_udfs.fit_pixel_classifier(px.where("tile_id % 5 <> 0"), ["b1", "b2"], class_map(5))
    out = tile_udfs.predict_pixels(px.where("tile_id % 5 = 0"), model).collect()
    assert len(out) == 160 and sum(r.pred == r.target for r in out) > 155 and all(abs(sum(r.probs) - 1) < 1e-9 and r.pred == int(np.argmax(r.probs)) for r in out)
    mixed = spark.createDataFrame([(i, 0.0, 0.0, int(i % 4 == 0)) for i in range(400)], "tile_id bigint, b1 double, b2 double, target int")
    share = lambda w: tile_udfs.predict_pixels(mixed.limit(1), tile_udfs.fit_pixel_classifier(mixed, ["b1", "b2"], w)).first().probs[1]
    assert abs(share({0: 1.0, 1: 1.0}) - 0.25) < 0.01 and abs(share({0: 1.0, 1: 3.0}) - 0.5) < 0.01


@pytest.mark.parametrize("block", [16, 24, 64, 1000])
def test_blocks_blend_what_pixels_blend(spark, block):
    """Windows in blocks of any size against pixels that are joined to their windows, with variants, gaps and a raster of odd sides."""
    draw = np.random.default_rng(3)
    height, width, size, step = 41, 53, 16, 6
    rows = [(r, c, draw.random(2).tolist()) for r in range(height) for c in range(width) if not (10 <= r < 14 and c > 40)]
    pixels = spark.createDataFrame(rows, "row bigint, col bigint, bands array<double>")

    def score(x: np.ndarray) -> np.ndarray:
        r, c = np.mgrid[0 : x.shape[2], 0 : x.shape[3]]
        return np.stack([x[:, 0] * (1 + r / 16), x[:, 1] - c / 16, x[:, 0] * x[:, 1] + 0 * r], axis=1)

    got = {(r.row, r.col): r.probs for r in scoring.blend_blocks(pixels, height, width, size, step, score, 2, k=3, block=block, batch=5).collect()}
    value, total = {(r, c): b for r, c, b in rows}, {}
    names = scoring.DEFAULT_VARIANTS
    for i in scoring.starts_of(height, size, step).tolist():
        for j in scoring.starts_of(width, size, step).tolist():
            for r in range(size):
                for c in range(size):
                    if (i + r, j + c) not in value:
                        continue
                    a, b = value[i + r, j + c]
                    probs = np.zeros(3)
                    for name in names:
                        y, x = scoring.SYMMETRIES[scoring.INVERSE.get(name, name)](r, c, size)
                        e = np.exp([a * (1 + y / 16), b - x / 16, a * b])
                        probs += e / e.sum() / len(names)
                    w = math.exp(-((r - 8) ** 2 + (c - 8) ** 2) / 32)
                    s = total.setdefault((i + r, j + c), [np.zeros(3), 0.0])
                    s[0] += w * probs
                    s[1] += w
    assert set(got) == set(total) and all(np.allclose(got[k], s / w, atol=1e-9) for k, (s, w) in total.items())
