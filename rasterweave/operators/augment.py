"""Augmentation of a tile table (tile_id, band, r, c, v), set-wise.

A plan tells per tile and epoch which operations happen, from hash uniforms; operators.programs draws all parameters and runs whole programs over packed tiles. Here each operation stands alone
over long pixels: symmetries and photometric operations are Column expressions, what looks at other pixels works on the planes of a tile, which meet in one shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from math import exp, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterweave.functions.grid import symmetry
from rasterweave.functions.scalars import hash_number, hash_uniform

Plane = dict[str, np.ndarray]
Rows = tuple[np.ndarray, np.ndarray, np.ndarray]

#: Operation, probability.
OPERATIONS = [
    ("hflip", 0.5), ("vflip", 0.5), ("rot90", 0.5), ("transpose", 0.3), ("affine", 0.5), ("elastic", 0.25), ("grid_distortion", 0.25), ("optical_distortion", 0.2), ("brightness_contrast", 0.5),
    ("hue_saturation_value", 0.3), ("clahe", 0.3), ("gauss_noise", 0.3), ("gaussian_blur", 0.2), ("sharpen", 0.2), ("coarse_dropout", 0.3), ("random_shadow", 0.2),
]


def augment_plan(tiles: DataFrame, epoch: int, seed: int = 42) -> DataFrame:
    """tile_id, op, u: the operations that happen to each tile in an epoch, and a uniform for their parameters."""
    ops = F.explode(F.array(*[F.struct(F.lit(name).alias("op"), F.lit(p).alias("p")) for name, p in OPERATIONS]))
    rows = tiles.select("tile_id", ops.alias("o")).select("tile_id", "o.op", "o.p")
    return rows.where(hash_uniform(seed, F.lit(epoch), "tile_id", "op") < F.col("p")).select("tile_id", "op", hash_uniform(seed + 1, F.lit(epoch), "tile_id", "op").alias("u"))


def moved(pixels: DataFrame, variant: str, size: int) -> DataFrame:
    """hflip, vflip, rot90, rot180, rot270, transpose: no join, each pixel goes to its place."""
    r, c = symmetry(F.lit(variant), F.col("r"), F.col("c"), size, inverse=True)
    return pixels.withColumns({"r": r.cast("int"), "c": c.cast("int")})


def nearest(x: Column) -> Column:
    return F.floor(x + 0.5).cast("int")


def per_plane(pixels: DataFrame, fn: Callable[[Plane], Rows], *extra: str) -> DataFrame:
    """tile_id, band, r, c, v that fn makes of each plane, the pixels of a tile's band, which meet in one shuffle; extra: further columns that fn sees."""

    def run(rows: pa.Table) -> pa.Table:
        at = {name: rows.column(name).fill_null(0).to_numpy() for name in ("r", "c", "v", *extra)}
        r, c, v = fn(at)
        same = pa.array(np.zeros(len(r), dtype=np.int64))
        return pa.table({"tile_id": rows.column("tile_id").take(same), "band": rows.column("band").take(same), "r": pa.array(r, pa.int32()), "c": pa.array(c, pa.int32()), "v": pa.array(v, pa.float64())})

    types = dict(pixels.dtypes)
    own = pixels.select("tile_id", "band", F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), F.col("v").cast("double").alias("v"), *extra)
    return own.groupBy("tile_id", "band").applyInArrow(run, f"tile_id {types['tile_id']}, band {types['band']}, r int, c int, v double")


def grid_of(plane: Plane, value: str = "v") -> np.ndarray:
    """The pixels at their places, 0 where there is none."""
    out = np.zeros((plane["r"].max() + 1, plane["c"].max() + 1))
    out[plane["r"], plane["c"]] = plane[value]
    return out


def taken(plane: Plane, rows: np.ndarray, cols: np.ndarray) -> Rows:
    """Every pixel with the value at its source place; 0 where that is outside."""
    values = grid_of(plane)
    inside = (rows >= 0) & (rows < values.shape[0]) & (cols >= 0) & (cols < values.shape[1])
    return plane["r"], plane["c"], np.where(inside, values[np.where(inside, rows, 0), np.where(inside, cols, 0)], 0.0)


def remap(pixels: DataFrame, source_r: Column, source_c: Column) -> DataFrame:
    """Every pixel takes the value of its source place; 0 where that is outside. Planes are looked up in memory, so pixels are shuffled once and never joined."""
    placed = pixels.withColumns({"_sr": nearest(source_r), "_sc": nearest(source_c)})
    return per_plane(placed, lambda plane: taken(plane, plane["_sr"], plane["_sc"]), "_sr", "_sc")


def affine(pixels: DataFrame, size: int, scale: float, degrees: float, shift: tuple[float, float], shear: float) -> DataFrame:
    """Scaled, turned, sheared and shifted about the centre: places come from the inverse transform."""
    mid = (size - 1) / 2
    y, x = F.col("r") - mid - shift[0], F.col("c") - mid - shift[1]
    angle = F.radians(F.lit(float(degrees)))
    x = x - shear * y
    sr = (F.cos(angle) * y - F.sin(angle) * x) / scale + mid
    sc = (F.sin(angle) * y + F.cos(angle) * x) / scale + mid
    return remap(pixels, sr, sc)


def stretch(at: Column, axis: str, size: int, steps: int, limit: float, seed: int) -> Column:
    """Piecewise linear: the axis's cells, each stretched by up to limit, together as long as before."""
    cell = size / steps
    length = F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda i: 1 + (hash_uniform(seed, "tile_id", F.lit(axis), i) * 2 - 1) * limit)
    total = F.aggregate(length, F.lit(0.0), lambda a, x: a + x)
    k = F.least(F.floor(at / cell), F.lit(steps - 1)).cast("int")
    before = F.aggregate(F.slice(length, 1, k), F.lit(0.0), lambda a, x: a + x)
    return (before + (at / cell - k) * F.get(length, k)) * size / total


def grid_distortion(pixels: DataFrame, size: int, steps: int = 5, limit: float = 0.2, seed: int = 42) -> DataFrame:
    return remap(pixels, stretch(F.col("r"), "r", size, steps, limit, seed), stretch(F.col("c"), "c", size, steps, limit, seed))


def optical_distortion(pixels: DataFrame, size: int, k: float = 0.15) -> DataFrame:
    mid = (size - 1) / 2
    y, x = (F.col("r") - mid) / mid, (F.col("c") - mid) / mid
    grow = 1 + k * (x * x + y * y)
    return remap(pixels, mid + (F.col("r") - mid) * grow, mid + (F.col("c") - mid) * grow)


def kernel(size: int, sigma: float) -> list[tuple[int, int, float]]:
    half = size // 2
    raw = [(i, j, exp(-(i * i + j * j) / (2 * sigma * sigma))) for i in range(-half, half + 1) for j in range(-half, half + 1)]
    total = sum(w for _, _, w in raw)
    return [(i, j, w / total) for i, j, w in raw]


def spread(values: np.ndarray, weights: list[tuple[int, int, float]]) -> np.ndarray:
    """Every value, times the weight, added at its place and offset."""
    (h, w), out = values.shape, np.zeros(values.shape)
    for i, j, weight in weights:
        if abs(i) < h and abs(j) < w:
            out[max(i, 0) : h + min(i, 0), max(j, 0) : w + min(j, 0)] += weight * values[max(-i, 0) : h - max(i, 0), max(-j, 0) : w - max(j, 0)]
    return out


def blurred(plane: Plane, passes: list[list[tuple[int, int, float]]], size: int, value: str = "v") -> tuple[np.ndarray, np.ndarray]:
    """Weighted means over neighbours by one kernel after the other, and which places they exist at; the weights of pixels that are there add up to one."""
    values, there = np.zeros((size, size)), np.zeros((size, size))
    values[plane["r"], plane["c"]], there[plane["r"], plane["c"]] = plane[value], 1.0
    for weights in passes:
        total, have = spread(values, weights), spread(there, weights)
        values, there = np.divide(total, have, out=np.zeros_like(total), where=have > 0), (have > 0).astype(float)
    return values, there > 0


def convolve(pixels: DataFrame, weights: list[tuple[int, int, float]], size: int) -> DataFrame:
    """Weighted means over neighbours; at the edge the weights inside add up to one. A plane is convolved where it lies, so a pixel is shuffled once, whatever the kernel."""

    def run(plane: Plane) -> Rows:
        values, there = blurred(plane, [weights], size)
        r, c = np.nonzero(there)
        return r, c, values[r, c]

    return per_plane(pixels, run)


def gaussian_blur(pixels: DataFrame, size: int, window: int = 3, sigma: float = 0.8) -> DataFrame:
    return convolve(pixels, kernel(window, sigma), size)


def sharpen(pixels: DataFrame, size: int, alpha: float = 0.3) -> DataFrame:
    """The picture plus alpha of its difference from its blur."""

    def run(plane: Plane) -> Rows:
        soft = blurred(plane, [kernel(3, 0.8)], size)[0][plane["r"], plane["c"]]
        return plane["r"], plane["c"], plane["v"] + alpha * (plane["v"] - soft)

    return per_plane(pixels, run)


def elastic(pixels: DataFrame, size: int, alpha: float = 60.0, sigma: float = 6.0, seed: int = 42) -> DataFrame:
    """Places shift by alpha times a smoothed noise field, one per tile and axis: blurred out to three deviations along columns and then along rows, plane by plane."""
    half = min(round(3 * sigma), size - 1)
    raw = [(i, exp(-i * i / (2 * sigma * sigma))) for i in range(-half, half + 1)]
    passes = [[(i, 0, w) for i, w in raw], [(0, i, w) for i, w in raw]]
    noise = {f"_n{axis}": hash_uniform(seed, "tile_id", F.lit(axis), "r", "c") * 2 - 1 for axis in (0, 1)}

    def run(plane: Plane) -> Rows:
        shift = [alpha * blurred(plane, passes, size, f"_n{axis}")[0][plane["r"], plane["c"]] for axis in (0, 1)]
        return taken(plane, *(np.floor(plane[at] + d + 0.5).astype(int) for at, d in zip("rc", shift, strict=True)))

    return per_plane(pixels.withColumns(noise), run, "_n0", "_n1")


def brightness_contrast(pixels: DataFrame, contrast: float, brightness: float) -> DataFrame:
    return pixels.withColumn("v", F.when(F.col("band") <= 3, F.col("v") * (1 + contrast) + brightness).otherwise(F.col("v")))


def hue_saturation_value(colours: DataFrame, hue: float, saturation: float, value: float) -> DataFrame:
    """colours (red, green, blue in 0..1) with hue (in sixths of the circle), saturation and value shifted."""
    r, g, b = F.col("red"), F.col("green"), F.col("blue")
    hi, lo = F.greatest(r, g, b), F.least(r, g, b)
    d = hi - lo
    h = F.when(d == 0, 0.0).when(hi == r, (g - b) / d).when(hi == g, (b - r) / d + 2).otherwise((r - g) / d + 4)
    s = F.when(hi > 0, d / hi).otherwise(0.0)
    clip = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    shifted = colours.withColumns({"_h": F.pmod(h + hue, F.lit(6.0)), "_s": clip(s + saturation), "_v": clip(hi + value)})

    def channel(n: int) -> Column:
        k = F.pmod(F.col("_h") + n, F.lit(6.0))
        return F.col("_v") - F.col("_v") * F.col("_s") * F.greatest(F.lit(0.0), F.least(k, 4 - k, F.lit(1.0)))

    return shifted.withColumns({"red": channel(5), "green": channel(3), "blue": channel(1)}).drop("_h", "_s", "_v")


def clahe(pixels: DataFrame, size: int, cells: int = 8, bins: int = 256, clip: float = 3.0) -> DataFrame:
    """Histogram equalisation in cells x cells parts with clipped counts, blended bilinearly between the cells around a pixel. Values lie in 0..1.

    What a cell's counts lose above the limit, one at least, is spread over all bins. A cell is told by the levels that it has, with running sums; a pixel
    looks its level up in four cells.
    """
    width = size // cells
    area, cell = float(width * width), ["tile_id", "band", "cr", "cc"]
    level = F.greatest(F.least(F.floor(F.col("v") * bins), F.lit(bins - 1)), F.lit(0)).cast("int")
    px = pixels.select("tile_id", "band", "r", "c", level.alias("level"))
    own = px.withColumns({"cr": F.floor(F.col("r") / width).cast("int"), "cc": F.floor(F.col("c") / width).cast("int")})
    counts = own.groupBy(*cell, "level").agg(F.count("*").alias("n")).withColumn("held", F.least(F.col("n").cast("double"), F.lit(max(clip * area / bins, 1.0))))
    upto = F.sum("held").over(Window.partitionBy(*cell).orderBy("level"))
    summed = counts.withColumn("upto", upto).groupBy(*cell).agg(F.sort_array(F.collect_list(F.struct("level", "upto"))).alias("levels"), F.sum(F.col("n") - F.col("held")).alias("cut"))
    at = lambda c: (F.col(c) + 0.5) / width - 0.5
    part = lambda c: at(c) - F.floor(at(c))
    inside = lambda k: F.least(F.greatest(k, F.lit(0)), F.lit(cells - 1)).cast("int")
    near = lambda c: F.explode(F.array(F.struct(inside(F.floor(at(c))).alias("k"), (1 - part(c)).alias("w")), F.struct(inside(F.floor(at(c)) + 1).alias("k"), part(c).alias("w"))))
    around = px.withColumn("_a", near("r")).withColumn("_b", near("c"))
    joined = around.withColumns({"cr": F.col("_a.k"), "cc": F.col("_b.k"), "w": F.col("_a.w") * F.col("_b.w")}).join(summed, cell)
    below = F.coalesce(F.array_max(F.transform(F.filter("levels", lambda x: x["level"] <= F.col("level")), lambda x: x["upto"])), F.lit(0.0))
    value = (below + (F.col("level") + 1) * F.col("cut") / bins) / area
    return joined.groupBy("tile_id", "band", "r", "c").agg(F.sum(F.col("w") * value).alias("v"))


def gauss_noise(pixels: DataFrame, sigma: float = 0.05, seed: int = 42) -> DataFrame:
    """Box-Muller on two hash uniforms per value."""
    place = ("tile_id", "band", "r", "c")
    u = (hash_number(f"{seed}a", *place) + 1) / float(1 << 32)
    normal = F.sqrt(-2 * F.log(u)) * F.cos(2 * pi * hash_uniform(f"{seed}b", *place))
    return pixels.withColumn("v", F.col("v") + sigma * normal)


def holes(tiles: DataFrame, size: int, most: int = 3, least_px: int = 1, most_px: int = 3, seed: int = 42) -> DataFrame:
    """tile_id, r0, c0, h, w: 1 to most seeded rectangles per tile."""
    n = 1 + hash_number(f"{seed}n", "tile_id") % most
    rows = tiles.select("tile_id", F.explode(F.sequence(F.lit(1).cast("bigint"), n)).alias("k"))
    draw = lambda name, of: hash_number(f"{seed}{name}", "tile_id", "k") % of
    return rows.select("tile_id", draw("r", size).alias("r0"), draw("c", size).alias("c0"), (least_px + draw("h", most_px - least_px + 1)).alias("h"), (least_px + draw("w", most_px - least_px + 1)).alias("w"))


def coarse_dropout(pixels: DataFrame, rectangles: DataFrame) -> DataFrame:
    """0 inside the rectangles: those become pixels, and an equi join finds them."""
    gone = rectangles.select("tile_id", F.explode(F.sequence("r0", F.col("r0") + F.col("h") - 1)).alias("r"), "c0", "w").select("tile_id", "r", F.explode(F.sequence("c0", F.col("c0") + F.col("w") - 1)).alias("c")).distinct()
    marked = pixels.join(gone.withColumn("_gone", F.lit(True)), ["tile_id", "r", "c"], "left")
    return marked.select("tile_id", "band", "r", "c", F.when(F.col("_gone"), 0.0).otherwise(F.col("v")).alias("v"))


def random_shadow(pixels: DataFrame, shaded: DataFrame, factor: float = 0.5) -> DataFrame:
    """factor times the first three bands inside the burned polygons (tile_id, row, col)."""
    marked = pixels.join(shaded.select("tile_id", F.col("row").alias("r"), F.col("col").alias("c"), F.lit(True).alias("_s")).distinct(), ["tile_id", "r", "c"], "left")
    return marked.select("tile_id", "band", "r", "c", F.when(F.col("_s") & (F.col("band") <= 3), F.col("v") * factor).otherwise(F.col("v")).alias("v"))
