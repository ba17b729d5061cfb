"""Augmentation programs: what happens to each tile in each epoch, drawn by Spark's functions and run over packed tiles.

A packed tile is a row (tile_id, image, mask): the image band by band and row by row in one array, the mask row by row. A program is an array of steps
(op, p) that is computed from the tile's id, so no join brings it to the tile. Running it composes the coordinate maps of all geometric steps into one
and then takes every pixel once, the mask's along with the image's; what changes colours follows in the program's order. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterweave.operators.augment import OPERATIONS

#: The ranges that parameters are drawn from.
SCALE, SHIFT, TURN, SHEAR = (0.85, 1.15), (-0.06, 0.06), (-20.0, 20.0), (-5.0, 5.0)
ALPHA, SIGMA = 60.0, 6.0
STEPS, STRETCH = 5, (-0.2, 0.2)
LENS, LENS_SHIFT = (-0.15, 0.15), (-0.1, 0.1)
CONTRAST, BRIGHTNESS = (-0.25, 0.25), (-0.25, 0.25)
HUE, SATURATION, VALUE = (-10 / 30, 10 / 30), (-20 / 255, 20 / 255), (-15 / 255, 15 / 255)
CLIP = (1.0, 3.0)
SHARPEN, LIGHTNESS = (0.1, 0.3), (0.8, 1.2)
HOLES, HOLE = (1, 6), (16 / 512, 48 / 512)
SHADOWS, CORNERS, SHADE = (1, 3), 5, 0.5
#: Our own: the deviation of noise, which has no stated range.
NOISE = (0.01, 0.05)
#: The modulus of the noise that is computed from whole numbers alike in every engine.
PRIME = 2147483647
STEP = "struct<op:string,p:array<double>>"


def parameters(op: str, size: int, draw: Callable[[str, float, float], str], whole: Callable[[str, int, int], str]) -> list[str]:
    """SQL of a step's parameters. draw(name, low, high) is uniform, whole(name, low, high) a whole number, both ends included."""
    match op:
        case "rot90":
            return [whole("k", 0, 3)]
        case "affine":
            return [draw("sy", *SCALE), draw("sx", *SCALE), draw("turn", *TURN), draw("dy", *SHIFT), draw("dx", *SHIFT), draw("hy", *SHEAR), draw("hx", *SHEAR)]
        case "elastic":
            return [whole("noise", 0, PRIME - 1), f"{ALPHA}D", f"{SIGMA}D"]
        case "grid_distortion":
            return [f"1 + {draw(f'{axis}{i}', *STRETCH)}" for axis in "rc" for i in range(STEPS)]
        case "optical_distortion":
            return [draw("k", *LENS), draw("dy", *LENS_SHIFT), draw("dx", *LENS_SHIFT)]
        case "brightness_contrast":
            return [draw("contrast", *CONTRAST), draw("brightness", *BRIGHTNESS)]
        case "hue_saturation_value":
            return [draw("hue", *HUE), draw("saturation", *SATURATION), draw("value", *VALUE)]
        case "clahe":
            return [draw("clip", *CLIP), f"{min(8, size // 4)}"]
        case "gauss_noise":
            return [whole("noise", 0, PRIME - 1), draw("sigma", *NOISE)]
        case "gaussian_blur":
            return [f"1 + 2 * {whole('window', 1, 2)}"]
        case "sharpen":
            return [draw("alpha", *SHARPEN), draw("lightness", *LIGHTNESS)]
        case "coarse_dropout":
            side = lambda name: whole(name, max(1, round(size * HOLE[0])), max(1, round(size * HOLE[1])))
            return [whole("n", *HOLES)] + [x for i in range(HOLES[1]) for x in (whole(f"r{i}", 0, size - 1), whole(f"c{i}", 0, size - 1), side(f"h{i}"), side(f"w{i}"))]
        case "random_shadow":
            return [whole("n", *SHADOWS)] + [draw(f"{axis}{i}", 0, size) for i in range(SHADOWS[1] * CORNERS) for axis in "yx"]
    return []


def program(tile_id: str, epoch: str, size: int, seed: int = 42, only: tuple[str, ...] | None = None) -> str:
    """SQL of the steps of a tile in an epoch, array<struct<op, p>>: each operation, or of `only` these, with its probability, in the fixed order, with parameters in their ranges. Text, as some hundred draws are slow to build as Columns."""
    steps = []
    for op, chance in OPERATIONS:
        if only is not None and op not in only:
            continue
        number = lambda name, op=op: f"cast(conv(substring(md5(concat_ws(':', '{seed}{op}.{name}', cast({epoch} as string), cast({tile_id} as string))), 1, 8), 16, 10) as bigint)"
        draw = lambda name, low, high, number=number: f"({low!r}D + {high - low!r}D * ({number(name)} / 4294967296D))"
        whole = lambda name, low, high, number=number: f"({low} + {number(name)} % {high - low + 1})"
        own = ", ".join(f"cast({x} as double)" for x in parameters(op, size, draw, whole))
        p = f"array({own})" if own else "cast(array() as array<double>)"
        steps.append(f"if({number('on')} / 4294967296D < {chance}D, named_struct('op', '{op}', 'p', {p}), null)")
    return f"filter(array({', '.join(steps)}), s -> s is not null)" if steps else f"cast(array() as array<{STEP}>)"


def programs(tiles: DataFrame, epochs: list[int], size: int, seed: int = 42) -> DataFrame:
    """tile_id, epoch, steps."""
    rows = tiles.select("tile_id", F.explode(F.array(*map(F.lit, epochs))).alias("epoch"))
    return rows.select("tile_id", "epoch", F.expr(program("tile_id", "epoch", size, seed)).alias("steps"))


# --- coordinate maps: the source place of every target place ------------------------------------------------------

Places = tuple[np.ndarray, np.ndarray]


def uniforms(base: float, count: int, stream: int) -> np.ndarray:
    """Numbers in [-1, 1) from whole numbers modulo a prime, squared twice."""
    x = (int(base) + 7919 * np.arange(stream * count, (stream + 1) * count, dtype=np.int64)) % PRIME
    for add in (48271, 69621):
        x = (x * x + add * x + 12345) % PRIME
    return x / PRIME * 2 - 1


def smooth(field: np.ndarray, sigma: float, half: int) -> np.ndarray:
    """Gaussian means along both axes; at the edge the weights inside add up to one."""
    offsets = range(-half, half + 1)
    for axis in (0, 1):
        n, total, weight = field.shape[axis], np.zeros(field.shape), np.zeros(field.shape)
        into, of = (lambda a, s, axis=axis: a[s] if axis == 0 else a[:, s]), lambda i: slice(max(i, 0), max(min(n + i, n), 0))
        for i in offsets:
            w = exp(-i * i / (2 * sigma * sigma))
            into(total, of(-i))[...] += w * into(field, of(i))
            into(weight, of(-i))[...] += w
        field = total / weight
    return field


def turned(r: np.ndarray, c: np.ndarray, n: int, p: list[float]) -> Places:
    for _ in range(int(p[0])):
        r, c = c, n - 1 - r
    return r, c


def affine(r: np.ndarray, c: np.ndarray, n: int, p: list[float]) -> Places:
    sy, sx, turn, dy, dx, hy, hx = p
    mid, turn = (n - 1) / 2, np.radians(turn)
    y, x = r - mid - dy * n, c - mid - dx * n
    x = x - np.tan(np.radians(hx)) * y
    y = y - np.tan(np.radians(hy)) * x
    return (np.cos(turn) * y - np.sin(turn) * x) / sy + mid, (np.sin(turn) * y + np.cos(turn) * x) / sx + mid


def elastic(r: np.ndarray, c: np.ndarray, n: int, p: list[float]) -> Places:
    half = min(round(3 * p[2]), n - 1)
    down, right = (smooth(uniforms(p[0], n * n, axis).reshape(n, n), p[2], half) for axis in (0, 1))
    at = tuple(np.clip(np.floor(x + 0.5), 0, n - 1).astype(int) for x in (r, c))
    return r + p[1] * down[at], c + p[1] * right[at]


def grid_distortion(r: np.ndarray, c: np.ndarray, n: int, p: list[float]) -> Places:
    out, cell = [], n / STEPS
    for at, length in ((r, np.array(p[:STEPS])), (c, np.array(p[STEPS:]))):
        k = np.clip(np.floor(at / cell), 0, STEPS - 1).astype(int)
        before = np.concatenate(([0.0], np.cumsum(length)))[k]
        out.append((before + (at / cell - k) * length[k]) * n / length.sum())
    return out[0], out[1]


def optical_distortion(r: np.ndarray, c: np.ndarray, n: int, p: list[float]) -> Places:
    mid = (n - 1) / 2
    y, x = r - mid - p[1] * n, c - mid - p[2] * n
    grow = 1 + p[0] * ((y / mid) ** 2 + (x / mid) ** 2)
    return mid + p[1] * n + y * grow, mid + p[2] * n + x * grow


MAPS: dict[str, Callable[[np.ndarray, np.ndarray, int, list[float]], Places]] = {
    "hflip": lambda r, c, n, p: (r, n - 1 - c), "vflip": lambda r, c, n, p: (n - 1 - r, c), "rot90": turned, "transpose": lambda r, c, n, p: (c, r),
    "affine": affine, "elastic": elastic, "grid_distortion": grid_distortion, "optical_distortion": optical_distortion,
}


def places(steps: list[tuple[str, list[float]]], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Source rows and columns of every target pixel under all geometric steps, and which of them no step has put outside the tile."""
    r, c = (x.astype(float) for x in np.mgrid[0:n, 0:n])
    inside = np.ones((n, n), dtype=bool)
    for op, p in reversed([s for s in steps if s[0] in MAPS]):
        r, c = MAPS[op](r, c, n, p)
        inside &= (r >= -0.5) & (r < n - 0.5) & (c >= -0.5) & (c < n - 0.5)
        r, c = np.where(inside, r, 0.0), np.where(inside, c, 0.0)
    return r, c, inside


def sampled(planes: np.ndarray, r: np.ndarray, c: np.ndarray, inside: np.ndarray, between: bool) -> np.ndarray:
    """The planes (k, n, n) at the places, 0 outside; between: blended from the four pixels around, else the nearest one."""
    n = planes.shape[1]
    if not between:
        return np.where(inside, planes[:, np.floor(r + 0.5).astype(int), np.floor(c + 0.5).astype(int)], 0)
    r, c = np.clip(r, 0, n - 1), np.clip(c, 0, n - 1)
    r0, c0 = np.minimum(np.floor(r).astype(int), max(n - 2, 0)), np.minimum(np.floor(c).astype(int), max(n - 2, 0))
    r1, c1, a, b = np.minimum(r0 + 1, n - 1), np.minimum(c0 + 1, n - 1), r - r0, c - c0
    mixed = (planes[:, r0, c0] * (1 - b) + planes[:, r0, c1] * b) * (1 - a) + (planes[:, r1, c0] * (1 - b) + planes[:, r1, c1] * b) * a
    return np.where(inside, mixed, 0)


# --- colours ------------------------------------------------------------------------------------------------------


def hsv(bands: np.ndarray, p: list[float]) -> np.ndarray:
    """Hue, in sixths of the circle, saturation and value shifted; the latter two are kept in 0..1."""
    if len(bands) < 3:
        return bands
    red, green, blue = bands
    hi, d = bands.max(0), bands.max(0) - bands.min(0)
    safe = np.where(d == 0, 1.0, d)
    h = np.select([d == 0, hi == red, hi == green], [0.0, (green - blue) / safe, (blue - red) / safe + 2], (red - green) / safe + 4)
    h = np.mod(h + p[0], 6.0)
    s = np.clip(np.where(hi > 0, d / np.where(hi > 0, hi, 1.0), 0.0) + p[1], 0, 1)
    v = np.clip(hi + p[2], 0, 1)
    channel = lambda k: v - v * s * np.clip(np.minimum(k, 4 - k), 0, 1)
    return np.stack([channel(np.mod(h + k, 6.0)) for k in (5, 3, 1)])


def equalised(plane: np.ndarray, clip: float, cells: int, bins: int = 256) -> np.ndarray:
    """Contrast-limited equalisation of a plane in 0..1 by cells x cells histograms, blended between the cells around a pixel."""
    n = len(plane)
    width = n // cells
    area = float(width * width)
    level = np.clip(np.floor(plane * bins), 0, bins - 1).astype(int)
    at = (np.arange(n) + 0.5) / width - 0.5
    below, part = np.floor(at).astype(int), at - np.floor(at)
    owner = np.arange(n) // width
    key = ((owner[:, None] * (owner[-1] + 1) + owner[None, :]) * bins + level).ravel()
    counts = np.bincount(key, minlength=(owner[-1] + 1) ** 2 * bins).reshape(owner[-1] + 1, owner[-1] + 1, bins).astype(float)
    held = np.minimum(counts, max(clip * area / bins, 1.0))
    cut = (counts - held).sum(2, keepdims=True)
    table = (held.cumsum(2) + (np.arange(bins) + 1) * cut / bins) / area
    out = np.zeros(plane.shape)
    for dr, wr in ((0, 1 - part), (1, part)):
        for dc, wc in ((0, 1 - part), (1, part)):
            cr, cc = np.clip(below + dr, 0, cells - 1), np.clip(below + dc, 0, cells - 1)
            out += wr[:, None] * wc[None, :] * table[cr[:, None], cc[None, :], level]
    return out


def shaded(n: int, corners: np.ndarray) -> np.ndarray:
    """Pixels whose centres lie inside a polygon (y, x), by crossings."""
    y, x = np.arange(n)[:, None] + 0.5, np.arange(n)[None, :] + 0.5
    odd = np.zeros((n, n), dtype=bool)
    for (y0, x0), (y1, x1) in zip(corners, np.roll(corners, -1, axis=0), strict=True):
        if y0 != y1:
            odd ^= (y >= min(y0, y1)) & (y < max(y0, y1)) & (x0 + (y - y0) * (x1 - x0) / (y1 - y0) > x)
    return odd


def sharpened(plane: np.ndarray, alpha: float, lightness: float) -> np.ndarray:
    """The plane mixed with its 3 x 3 Laplacian sharpening; beyond the edge pixels repeat."""
    n = len(plane)
    wide = np.pad(plane, 1, mode="edge")
    around = sum(wide[i : i + n, j : j + n] for i in range(3) for j in range(3)) - plane
    return (1 - alpha) * plane + alpha * ((8 + lightness) * plane - around)


def coloured(bands: np.ndarray, op: str, p: list[float]) -> np.ndarray:
    """The bands (k, n, n) after a step that leaves places as they are."""
    n = bands.shape[1]
    match op:
        case "brightness_contrast":
            return bands * (1 + p[0]) + p[1]
        case "hue_saturation_value":
            return hsv(bands, p)
        case "clahe":
            return np.stack([equalised(b, p[0], max(1, int(p[1]))) for b in bands])
        case "gauss_noise":
            first, second = (uniforms(p[0], bands.size, k) for k in (0, 1))
            return bands + p[1] * (np.sqrt(-2 * np.log((first + 1) / 2 + 1e-10)) * np.cos(np.pi * second)).reshape(bands.shape)
        case "gaussian_blur":
            return np.stack([smooth(b, 0.3 * ((p[0] - 1) / 2 - 1) + 0.8, int(p[0]) // 2) for b in bands])
        case "sharpen":
            return np.stack([sharpened(b, *p) for b in bands])
        case "coarse_dropout":
            out = bands.copy()
            for r, c, h, w in np.array(p[1:]).reshape(-1, 4)[: int(p[0])].astype(int):
                out[:, r : r + h, c : c + w] = 0
            return out
        case "random_shadow":
            dark = np.zeros((n, n), dtype=bool)
            for corners in np.array(p[1:]).reshape(-1, CORNERS, 2)[: int(p[0])]:
                dark |= shaded(n, corners)
            return np.where(dark, bands * SHADE, bands)
    raise ValueError(f"no operation named {op}")


def run_steps(image: np.ndarray, mask: np.ndarray, steps: list[tuple[str, list[float]]], front: int = 3, between: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A tile's image (k, n, n) and mask (n, n) after a program. Steps change the first `front` bands, further ones pass through as they are."""
    bands = image[:front].astype(float)
    if any(op in MAPS for op, _ in steps):
        r, c, inside = places(steps, image.shape[1])
        bands, mask = sampled(bands, r, c, inside, between), sampled(mask[None], r, c, inside, False)[0]
    for op, p in steps:
        if op not in MAPS and len(bands):
            bands = coloured(bands, op, p)
    return np.concatenate((bands, image[front:])), mask


def augmented(tiles: DataFrame, epochs: list[int], size: int, seed: int = 42, front: int | str = 3, between: bool = True, only: tuple[str, ...] | None = None) -> DataFrame:
    """tiles (tile_id, image, mask, ...; flat arrays) once per epoch, with epoch, ops (the names of the steps) and image and mask after that epoch's program; only: of these operations. front: how many bands of an image steps change, or the column that has their number.

    A null image or mask stays null and so does its partner. What is sent to a worker at once is bounded by spark.sql.execution.arrow.maxBytesPerBatch.
    """
    planned = tiles.withColumn("_programs", F.expr(f"transform(array({', '.join(map(str, epochs))}), e -> named_struct('epoch', e, 'steps', {program('tile_id', 'e', size, seed, only)}))"))
    rest = [c for c in tiles.columns if c not in ("image", "mask", "epoch", "ops")]
    schema = tiles.select(*rest, F.lit(0).alias("epoch"), F.array().cast("array<string>").alias("ops"), "image", "mask").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: batch.schema.get_field_index(name) for name in batch.schema.names}
            for i in range(batch.num_rows):  # a tile is what one step works on
                image, mask = batch.column(at["image"])[i], batch.column(at["mask"])[i]
                plans, made = batch.column(at["_programs"])[i].as_py(), []
                first = batch.column(at[front])[i].as_py() if isinstance(front, str) else front
                for plan in plans:
                    own = [(s["op"], s["p"]) for s in plan["steps"]]
                    if image.is_valid and mask.is_valid:
                        x, m = run_steps(image.values.to_numpy(zero_copy_only=False).reshape(-1, size, size), mask.values.to_numpy(zero_copy_only=False).reshape(size, size), own, first, between)
                        made.append((x.ravel(), m.ravel(), [op for op, _ in own]))
                    else:
                        made.append((None, None, [op for op, _ in own]))
                there = pa.array([i] * len(plans))
                made_arrays = [pa.array([m[2] for m in made], pa.list_(pa.string())), *(pa.array([m[j] for m in made], batch.column(at[name]).type) for j, name in ((0, "image"), (1, "mask")))]
                yield pa.RecordBatch.from_arrays([*(batch.column(at[c]).take(there) for c in rest), pa.array([p["epoch"] for p in plans], pa.int32()), *made_arrays], names=[*rest, "epoch", "ops", "image", "mask"])

    return planned.mapInArrow(run, schema)


def packed_tiles(pixels: DataFrame, masks: DataFrame) -> DataFrame:
    """tile_id, bands (those that the image has, in order), image, mask from long pixels (tile_id, band, r, c, v) and masks (tile_id, r, c, class_id): each tile's values meet once."""
    values = lambda *names: F.transform(F.sort_array(F.collect_list(F.struct(*names))), lambda s: s[names[-1]])
    return pixels.groupBy("tile_id").agg(F.sort_array(F.collect_set("band")).alias("bands"), values("band", "r", "c", "v").alias("image")).join(masks.groupBy("tile_id").agg(values("r", "c", "class_id").alias("mask")), "tile_id")
