"""Scores over pixels: colours, blending of windows, symmetries and resizing."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterweave.functions.grid import DEFAULT_VARIANTS, INVERSE, SYMMETRIES, symmetry
from rasterweave.model import CLASSES
from rasterweave.operators.metrics import of_size
from rasterweave.session import saved


def colorize(class_id: Column, reverse: bool = False) -> Column:
    """The class's colour, black for an unknown one."""
    out = F.array(*[F.lit(0)] * 3)
    for c in CLASSES:
        rgb = c[6][::-1] if reverse else c[6]
        out = F.when(class_id == c[0], F.array(*map(F.lit, rgb))).otherwise(out)
    return out


def to_rgb8(bands: Column) -> Column:
    """The first three bands, or the first one three times, from 0..1 to whole 0..255, truncated; a null one is 0."""
    three = F.when(F.size(bands) >= 3, F.slice(bands, 1, 3)).otherwise(F.array_repeat(F.get(bands, F.lit(0)), 3))
    return F.transform(three, lambda v: F.least(F.greatest(v * 255, F.lit(0.0)), F.lit(255.0)).cast("int"))


def overlay_blend(rgb: Column, class_id: Column, alpha: float = 0.45) -> Column:
    """The colour over the picture where there is a class."""
    mixed = F.zip_with(rgb, colorize(class_id), lambda a, b: (a * (1 - alpha) + b * alpha).cast("int"))
    return F.when(class_id == 0, rgb).otherwise(mixed)


def gaussian_weight(r: Column, c: Column, size: int, sigma_ratio: float = 0.25) -> Column:
    """1 at size div 2, falling off with a deviation of size * sigma_ratio."""
    half, s = size // 2, size * sigma_ratio
    return F.exp(-(F.pow(r - half, F.lit(2)) + F.pow(c - half, F.lit(2))) / (2 * s * s))


def blend_windows(scores: DataFrame, size: int, k: int = 4, sigma_ratio: float = 0.25) -> DataFrame:
    """Scores (row, col, win_row, win_col, probs) of covering windows as one probs per pixel: weighted sums over the sum of weights."""
    w = gaussian_weight(F.col("row") - F.col("win_row"), F.col("col") - F.col("win_col"), size, sigma_ratio)
    weighted = scores.withColumn("w", w)
    sums = weighted.groupBy("row", "col").agg(*[F.sum(F.col("probs")[i] * F.col("w")).alias(f"p{i}") for i in range(k)], F.sum("w").alias("w"))
    return sums.select("row", "col", F.array(*[F.col(f"p{i}") / F.greatest("w", F.lit(1e-6)) for i in range(k)]).alias("probs"))


def tta_variants(pixels: DataFrame, n: int, full_d4: bool = False, value: str = "v") -> DataFrame:
    """pixels (r, c) of square tiles once per variant, at their places there; variant_no tells variants of one name apart."""
    names = tuple(SYMMETRIES) if full_d4 else DEFAULT_VARIANTS
    rows = pixels.select("*", F.posexplode(F.array(*map(F.lit, names))).alias("variant_no", "variant"))
    r, c = symmetry(F.col("variant"), F.col("r"), F.col("c"), n, inverse=True)  # where a source pixel goes
    return rows.withColumns({"r": r, "c": c})


def tta_undo(scores: DataFrame, n: int) -> DataFrame:
    """Scores at variants' places, back at the tile's own."""
    r, c = symmetry(F.col("variant"), F.col("r"), F.col("c"), n)
    return scores.withColumns({"r": r, "c": c})


def tta_average(scores: DataFrame, keys: list[str], k: int = 4) -> DataFrame:
    sums = scores.groupBy(*keys).agg(*[F.avg(F.col("probs")[i]).alias(f"p{i}") for i in range(k)])
    return sums.select(*keys, F.array(*[F.col(f"p{i}") for i in range(k)]).alias("probs"))


Scorer = Callable[[np.ndarray], np.ndarray]


def with_variants(windows: np.ndarray, score: Scorer, names: tuple[str, ...]) -> np.ndarray:
    """Mean class probabilities (n, k, size, size) of windows (n, bands, size, size), each seen in every variant and turned back."""
    n, places = windows.shape[-1], np.mgrid[0 : windows.shape[-1], 0 : windows.shape[-1]]
    total: np.ndarray | float = 0.0
    for name in names:
        there, back = SYMMETRIES[name](*places, n), SYMMETRIES[INVERSE.get(name, name)](*places, n)
        logits = score(windows[:, :, there[0], there[1]])
        raised = np.exp(logits - logits.max(1, keepdims=True))
        total = total + (raised / raised.sum(1, keepdims=True))[:, :, back[0], back[1]]
    return total / len(names)


def starts_of(length: int, size: int, step: int) -> np.ndarray:
    """First pixels of the windows along an axis: every step, the last one ends at the edge."""
    last = max(length - size, 0)
    return np.unique(np.append(np.arange(0, last + 1, step), last))


def blend_blocks(pixels: DataFrame, height: int, width: int, size: int, step: int, score: Scorer, bands: int, k: int = 4, block: int | None = None, names: tuple[str, ...] = DEFAULT_VARIANTS, sigma_ratio: float = 0.25, batch: int = 16) -> DataFrame:
    """row, col, probs of pixels (row, col, bands): sliding windows of a raster, scored as arrays and blended, block by block.

    A block (of at least a window's size) has the windows that start in it; a pixel goes to its own block and, within a window's size of a border, to the ones above and to
    the left, whose windows reach it. Windows never leave a task: it adds their weighted scores up, and only sums of pixels that other blocks' windows reach too, the halos, are shuffled once more.
    Pixels that are not there count as zeros in the windows and are not told. Bands that a pixel lacks are NaN to the scorer; probabilities that are not a number are told as null.
    """
    block = max(size, block or 4 * size)
    rows_at, cols_at = starts_of(height, size, step), starts_of(width, size, step)
    reach = lambda c: F.explode(F.sequence(F.greatest(F.floor((F.col(c) - size + 1) / block), F.lit(0)).cast("int"), F.floor(F.col(c) / block).cast("int")))
    dealt = pixels.select("row", "col", of_size(F.col("bands"), bands).alias("bands")).withColumn("block_row", reach("row")).withColumn("block_col", reach("col"))
    half, s = size // 2, size * sigma_ratio
    r, c = np.mgrid[0:size, 0:size]
    weight = np.exp(-((r - half) ** 2 + (c - half) ** 2) / (2 * s * s))

    def run(table: pa.Table) -> pa.Table:
        top, left = (table.column(n)[0].as_py() * block for n in ("block_row", "block_col"))
        rows, cols = (table.column(n).to_numpy() for n in ("row", "col"))
        image = np.zeros((bands, block + size, block + size))
        image[:, rows - top, cols - left] = table.column("bands").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, bands).T
        total, weights = np.zeros((k, *image.shape[1:])), np.zeros(image.shape[1:])
        own = [(i - top, j - left) for i in rows_at[(rows_at >= top) & (rows_at < top + block)].tolist() for j in cols_at[(cols_at >= left) & (cols_at < left + block)].tolist()]
        for begin in range(0, len(own), batch):
            places = own[begin : begin + batch]
            probs = with_variants(np.stack([image[:, i : i + size, j : j + size] for i, j in places]), score, names)
            for (i, j), p in zip(places, probs, strict=True):
                total[:, i : i + size, j : j + size] += p * weight
                weights[i : i + size, j : j + size] += weight
        sums, have = total[:, rows - top, cols - left].T, weights[rows - top, cols - left]
        # all of this block's own pixels that no window of the blocks before reaches
        whole = (rows < top + block) & (cols < left + block) & ((rows >= top + size - 1) | (top == 0)) & ((cols >= left + size - 1) | (left == 0))
        told = have > 0
        return pa.table({"row": table.column("row").filter(told), "col": table.column("col").filter(told), "whole": whole[told], "w": have[told], "s": pa.array(list(sums[told]), pa.list_(pa.float64()))})

    types = dict(pixels.dtypes)
    parts = saved(dealt.groupBy("block_row", "block_col").applyInArrow(run, f"row {types['row']}, col {types['col']}, whole boolean, w double, s array<double>"), "blended")
    halo = parts.where("not whole").groupBy("row", "col").agg(F.sum("w").alias("w"), *[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(k)])
    summed = parts.where("whole").select("row", "col", "w", "s").unionByName(halo.select("row", "col", "w", F.array(*[f"s{i}" for i in range(k)]).alias("s")))
    return summed.select("row", "col", F.transform("s", lambda x: F.when(~F.isnan(x), x / F.greatest("w", F.lit(1e-6)))).alias("probs"))


def bilinear_resize(pixels: DataFrame, keys: list[str], height: int, width: int, new_height: int, new_width: int, value: str = "v") -> DataFrame:
    """Pixels (keys, r, c, value) at a new size, centres at half pixels, edges clamped. A pixel goes to the targets within one pixel of it, whose numbers follow from its own."""

    def near(df: DataFrame, name: str, new: int, old: int) -> DataFrame:
        place = lambda i: (i + 0.5) * old / new - 0.5
        at = F.col(name)
        first = F.when(at == 0, 0).otherwise(F.greatest(F.ceil(((at - 1) + 0.5) * new / old - 0.5), F.lit(0)))
        last = F.when(at == old - 1, new - 1).otherwise(F.least(F.floor(((at + 1) + 0.5) * new / old - 0.5), F.lit(new - 1)))
        spread = df.withColumn(f"new_{name}", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
        clamped = F.least(F.greatest(place(F.col(f"new_{name}")), F.lit(0.0)), F.lit(old - 1.0))
        return spread.withColumn(f"w_{name}", 1 - F.abs(clamped - at)).where(F.col(f"w_{name}") > 0)

    spread = near(near(pixels, "r", new_height, height), "c", new_width, width)
    return spread.groupBy(*keys, F.col("new_r").alias("r"), F.col("new_c").alias("c")).agg(F.sum(F.col(value) * F.col("w_r") * F.col("w_c")).alias(value))
