"""Augmentation programs against single operations over long pixels and against plain loops."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterweave.operators import augment, programs, spatial, tile_udfs

N = 16
SCHEMA = "tile_id bigint, image array<double>, mask array<int>"


def tile(seed: int = 1, bands: int = 4) -> np.ndarray:
    return np.random.default_rng(seed).random((bands, N, N))


def long(spark, image: np.ndarray):
    rows = [(7, b + 1, r, c, float(image[b, r, c])) for b in range(len(image)) for r in range(N) for c in range(N)]
    return spark.createDataFrame(rows, "tile_id bigint, band int, r int, c int, v double")


def wide(df, bands: int = 3) -> np.ndarray:
    out = np.full((bands, N, N), np.nan)
    for x in df.where(f"band <= {bands}").collect():
        out[x.band - 1, x.r, x.c] = x.v
    return out


def ran(image: np.ndarray, *steps: tuple[str, list[float]], between: bool = False) -> tuple[np.ndarray, np.ndarray]:
    return programs.run_steps(image, np.arange(N * N).reshape(N, N), list(steps), between=between)


@pytest.mark.parametrize("case", ["affine", "grid_distortion", "optical_distortion", "rot90", "brightness_contrast", "gaussian_blur", "hue_saturation_value", "clahe", "random_shadow"])
def test_a_step_alone_does_what_its_operation_does(spark, case):
    image = tile()
    pixels = long(spark, image)
    if case == "affine":
        steps, expected = ("affine", [1.1, 1.1, 20.0, 0.5 / N, -1.0 / N, 0.0, math.degrees(math.atan(0.1))]), augment.affine(pixels, N, 1.1, 20.0, (0.5, -1.0), 0.1)
    elif case == "grid_distortion":
        length = [[spark.range(1).select(1 + (augment.hash_uniform(42, F.lit(7), F.lit(axis), F.lit(i)) * 2 - 1) * 0.2).first()[0] for i in range(5)] for axis in "rc"]
        steps, expected = (case, [*length[0], *length[1]]), augment.grid_distortion(pixels, N)
    elif case == "optical_distortion":
        steps, expected = (case, [0.15, 0.0, 0.0]), augment.optical_distortion(pixels, N)
    elif case == "rot90":
        steps, expected = (case, [1.0]), augment.moved(pixels, "rot90", N)
    elif case == "brightness_contrast":
        steps, expected = (case, [0.2, -0.1]), augment.brightness_contrast(pixels, 0.2, -0.1)
    elif case == "gaussian_blur":
        steps, expected = (case, [3.0]), augment.gaussian_blur(pixels, N)
    elif case == "hue_saturation_value":
        one = pixels.groupBy("tile_id", "r", "c").pivot("band", [1, 2, 3]).agg(F.first("v")).withColumnsRenamed({"1": "red", "2": "green", "3": "blue"})
        changed = augment.hue_saturation_value(one, 0.25, 0.1, -0.05)
        steps, expected = (case, [0.25, 0.1, -0.05]), changed.select("tile_id", "r", "c", F.posexplode(F.array("red", "green", "blue")).alias("b", "v")).withColumn("band", F.col("b") + 1)
    elif case == "clahe":
        steps, expected = (case, [2.0, 4.0]), augment.clahe(pixels, N, cells=4, clip=2.0)
    else:
        corners = [(1, 2), (3, 14), (12, 15), (14, 6), (8, 1)]
        edges = spark.createDataFrame([(7, *corners[i][::-1], *corners[(i + 1) % 5][::-1]) for i in range(5)], "tile_id bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
        steps, expected = (case, [1.0, *np.ravel(corners).astype(float), *[0.0] * 20]), augment.random_shadow(pixels, spatial.rasterize_polygons(edges, "tile_id", height=N, width=N))
    np.testing.assert_allclose(ran(image, steps)[0][:3], wide(expected), atol=1e-9)


def test_a_program_is_its_steps_one_after_the_other():
    """Symmetries compose exactly, the mask goes along, the fourth band stays, and a sampled place is what plain loops find."""
    image = tile(3)
    steps = [("hflip", []), ("rot90", [3.0]), ("transpose", []), ("vflip", [])]
    out, mask = ran(image, *steps)
    for planes, got in ((image[:3], out[:3]), (np.arange(N * N).reshape(1, N, N), mask[None])):
        turned = planes[:, :, ::-1]
        turned = np.rot90(turned, -3, axes=(1, 2)) if np.array_equal(ran(image, ("rot90", [1.0]))[1], np.rot90(np.arange(N * N).reshape(N, N), -1)) else np.rot90(turned, 3, axes=(1, 2))
        assert np.array_equal(got, turned.transpose(0, 2, 1)[:, ::-1])
    assert np.array_equal(out[3], image[3])
    shear = ("affine", [0.9, 1.1, 15.0, 0.05, -0.03, 2.0, -4.0])
    out, mask = ran(image, ("hflip", []), shear, between=True)
    r, c, inside = programs.places([("hflip", []), shear], N)
    for i in range(N):
        for j in range(N):
            y, x, ok = *(v[i, j] for v in programs.affine(*np.mgrid[0:N, 0:N].astype(float), N, shear[1])), True
            ok = -0.5 <= y < N - 0.5 and -0.5 <= x < N - 0.5
            assert ok == inside[i, j] and (not ok or (abs(r[i, j] - y) < 1e-12 and abs(c[i, j] - (N - 1 - x)) < 1e-12))
            if ok:
                y, x = min(max(y, 0), N - 1), min(max(N - 1 - x, 0), N - 1)
                y0, x0 = min(int(y), N - 2), min(int(x), N - 2)
                mean = sum(image[0, y0 + a, x0 + b] * (y - y0 if a else 1 - y + y0) * (x - x0 if b else 1 - x + x0) for a in (0, 1) for b in (0, 1))
                assert abs(out[0, i, j] - mean) < 1e-12
            else:
                assert out[0, i, j] == 0 and mask[i, j] == 0


def test_noise_dropout_and_sharpening_by_plain_loops():
    image = tile(5)
    out, mask = ran(image, ("coarse_dropout", [2.0, 1, 2, 3, 4, 15, 15, 4, 4, 0, 0, 9, 9]))
    gone = {(r, c) for r in range(1, 4) for c in range(2, 6)} | {(15, 15)}
    assert {(r, c) for r in range(N) for c in range(N) if (out[:3, r, c] == 0).all()} == gone and np.array_equal(out[3], image[3]) and np.array_equal(mask, np.arange(N * N).reshape(N, N))
    out = ran(image, ("sharpen", [0.2, 1.1]))[0]
    at = lambda r, c: image[0, min(max(r, 0), N - 1), min(max(c, 0), N - 1)]
    for r in range(N):
        for c in range(N):
            around = sum(at(r + i, c + j) for i in (-1, 0, 1) for j in (-1, 0, 1)) - image[0, r, c]
            assert abs(out[0, r, c] - (0.8 * image[0, r, c] + 0.2 * (9.1 * image[0, r, c] - around))) < 1e-12
    noise = (ran(image, ("gauss_noise", [12345.0, 0.03]))[0] - image)[:3]
    assert abs(noise.std() - 0.03) < 0.004 and abs(noise.mean()) < 0.004 and np.array_equal(ran(image, ("gauss_noise", [12345.0, 0.03]))[0] - image, ran(image, ("gauss_noise", [12345.0, 0.03]))[0] - image)


def test_programs_draw_in_their_ranges_and_no_join_runs_them(spark):
    tiles = spark.range(3000).withColumnRenamed("id", "tile_id")
    steps = programs.programs(tiles, [1, 2], 512).select("tile_id", "epoch", F.explode("steps").alias("s")).select("s.op", "s.p").collect()
    share = {op: sum(s.op == op for s in steps) / 6000 for op, _ in augment.OPERATIONS}
    assert all(abs(share[op] - p) < 0.03 for op, p in augment.OPERATIONS)
    drawn = lambda op, k: np.array([s.p[k] for s in steps if s.op == op])
    assert set(drawn("rot90", 0)) == {0, 1, 2, 3} and set(drawn("gaussian_blur", 0)) == {3, 5} and set(drawn("coarse_dropout", 0)) == set(range(1, 7)) and set(drawn("random_shadow", 0)) == {1, 2, 3}
    for op, k, low, high in (("affine", 2, -20, 20), ("affine", 0, 0.85, 1.15), ("optical_distortion", 1, -0.1, 0.1), ("coarse_dropout", 3, 16, 48), ("sharpen", 1, 0.8, 1.2)):
        x = drawn(op, k)
        assert low <= x.min() < low + 0.1 * (high - low) and high - 0.1 * (high - low) < x.max() <= high
    image = [float(x) for x in tile(2).ravel()]
    rows = [(i, None if i == 3 else image, None if i == 4 else list(range(N * N))) for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    done = programs.augmented(df.withColumn("ops", F.lit("clash")), [1, 2], N)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    out = done.collect()
    assert len(out) == 24 and all((r.image is None) == (r.tile_id in (3, 4)) == (r.mask is None) for r in out)
    again = {(r.tile_id, r.epoch): r for r in programs.augmented(df.repartition(5), [1, 2], N).collect()}
    assert all(again[r.tile_id, r.epoch] == r for r in out)
    assert len({tuple(r.image) for r in out if r.image}) > 15
    assert programs.augmented(df.limit(0), [1], N).count() == 0


def test_planes_of_broken_tiles_keep_their_rules(spark):
    """Pixels that are missing weigh nothing in a blur and are 0 where they are looked up; no pixel is joined."""
    draw = random.Random(4)
    kept = [(1, 1, r, c, draw.random()) for r in range(8) for c in range(8) if draw.random() < 0.7]
    pixels = spark.createDataFrame(kept, "tile_id bigint, band int, r int, c int, v double")
    value = {(r, c): v for _, _, r, c, v in kept}
    weights = augment.kernel(3, 0.8)
    got = {(x.r, x.c): x.v for x in augment.gaussian_blur(pixels, 8).collect()}
    for r in range(8):
        for c in range(8):
            near = [(value[r + i, c + j], w) for i, j, w in weights if (r + i, c + j) in value]
            assert ((r, c) in got) == bool(near) and (not near or abs(got[r, c] - sum(v * w for v, w in near) / sum(w for _, w in near)) < 1e-12)
    moved = augment.remap(pixels, F.col("r") + 1, F.col("c") - 2)
    assert {(x.r, x.c): x.v for x in moved.collect()} == {(r, c): value.get((r + 1, c - 2), 0.0) for r, c in value}
    assert "Join" not in moved._jdf.queryExecution().executedPlan().toString()


def test_long_keys_beside_null_ones_stay_as_they_are(spark):
    keys = [None, (1 << 53) + 1, (1 << 53) + 3]
    blocks = spark.createDataFrame([(k, [1.0, 2.0]) for k in keys], "key bigint, data array<double>").coalesce(1)
    out = tile_udfs.flat_map_blocks(blocks, lambda b: [(b["key"], float(b["data"].sum()))], ["key"], "same bigint, total double").collect()
    assert sorted(((r.key, r.same, r.total, r.error) for r in out), key=str) == sorted(((k, k, 3.0, None) for k in keys), key=str)
