"""Statistics of bands, tiles and classes, and the scalings that use them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterweave.functions.scalars import hash_number
from rasterweave.model import RGB_MEAN, RGB_STD
from rasterweave.session import saved

FIRST_BANDS = 5


def band_stats(pixels: DataFrame, *keys: str, value: str = "v") -> DataFrame:
    """Least, largest, mean and population deviation per raster and band, of the first five bands; an empty band has no row."""
    v = F.col(value)
    return pixels.where(F.col("band") <= FIRST_BANDS).groupBy(*keys, "band").agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))


def random_windows(rasters: DataFrame, n: int, tile: int, seed: int = 42) -> DataFrame:
    """rasters (raster_id, width, height) with n seeded window origins each, inside the raster."""
    at = rasters.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    place = lambda axis, size: hash_number(f"{seed}{axis}", "raster_id", "k") % F.greatest(F.col(size) - tile, F.lit(1))
    return at.withColumns({"win_row": place("r", "height"), "win_col": place("c", "width")})


#: Rank error of the sketches that bracket percentiles, as one part in so many, and how many such parts a bracket takes on either side.
ACCURACY, MARGIN = 10_000, 3


def few(df: DataFrame, most: int = 100_000) -> DataFrame:
    """df written once, and marked for a broadcast if it has so few rows."""
    rows = saved(df, "few")
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def band_percentiles(pixels: DataFrame, *keys: str, low: float = 0.02, high: float = 0.98, spread: bool = False, value: str = "v", accuracy: int = ACCURACY, margin: int = MARGIN) -> DataFrame:
    """Linear interpolation between ranks, exact. spread: for groups that outgrow a task.

    Spread, a pass of mergeable sketches brackets both percentiles of every group; a second pass counts what lies outside the brackets as a whole and inside them value by value, so
    tasks send some parts in `accuracy` of a group besides ties, and running counts over those find the ranks exactly. Merged sketches may err by more than they promise: a group whose rank
    turns out to lie outside its bracket goes round again with a wider one, at last with all of its values.
    """
    if not spread:
        return pixels.groupBy(*keys, "band").agg(F.percentile(value, low).alias("p_lo"), F.percentile(value, high).alias("p_hi"))
    by = [*keys, "band"]
    at = [min(max(p + side * margin / accuracy, 0.0), 1.0) for p in (low, high) for side in (-1, 1)]
    real = pixels.where(F.col(value).isNotNull())
    ends = few(real.groupBy(*by).agg(F.percentile_approx(value, at, accuracy).alias("_e"), F.count("*").alias("_total")).select(*by, "_total", *[F.col("_e")[i].alias(f"_e{i}") for i in range(4)]))
    same = [real[c].eqNullSafe(ends[c]) for c in by]
    v, e = F.col(value), [F.col(f"_e{i}") for i in range(4)]
    # a row's place in order: its value where that matters, else just before, between or just after the brackets
    put = lambda x, side: F.struct(x.alias("x"), F.lit(side).alias("side"))
    place = F.when(v < e[0], put(e[0], -1)).when(v <= e[1], put(v, 0)).when(v < e[2], put(e[1], 1)).when(v <= e[3], put(v, 0)).otherwise(put(e[3], 1))
    counts = real.join(ends, reduce(Column.__and__, same)).select(*[real[c] for c in by], "_total", place.alias("_place")).groupBy(*by, "_total", "_place").agg(F.count("*").alias("_n"))
    ranked = counts.withColumn("_upto", F.sum("_n").over(Window.partitionBy(*by).orderBy("_place")))
    rank = lambda p: p * (F.col("_total") - 1)
    held = lambda k: (F.col("_upto") - F.col("_n") <= k) & (k < F.col("_upto"))
    of = lambda k: F.max(F.when(held(k) & (F.col("_place.side") == 0), F.col("_place.x").cast("double")))
    marks = {f"_{name}_{end}": of(f(rank(p))) for name, p in (("lo", low), ("hi", high)) for end, f in (("below", F.floor), ("above", F.ceil))}
    found = saved(ranked.groupBy(*by, "_total").agg(*[m.alias(k) for k, m in marks.items()]), "percentiles")
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in marks])
    between = lambda name, p: F.col(f"_{name}_below") + (F.col(f"_{name}_above") - F.col(f"_{name}_below")) * (rank(p) - F.floor(rank(p)))
    out = found.where(whole).select(*by, between("lo", low).alias("p_lo"), between("hi", high).alias("p_hi"))
    if margin >= accuracy or found.where(~whole).isEmpty():
        return out
    missed = found.where(~whole).select(*[F.col(c).alias(f"_{c}") for c in by])
    again = real.join(few(missed), reduce(Column.__and__, [real[c].eqNullSafe(F.col(f"_{c}")) for c in by]), "left_semi")
    return out.unionByName(band_percentiles(again, *keys, low=low, high=high, spread=True, value=value, accuracy=accuracy, margin=8 * margin))


def source_sketches(meta: DataFrame, *columns: str) -> DataFrame:
    """A row per shard with a mergeable sketch of the distinct values of each column."""
    return meta.groupBy("shard").agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(14)).alias(c) for c in columns])


def distinct_from_sketches(sketches: DataFrame, *columns: str) -> DataFrame:
    """About how many distinct values the shards have together, from sketches alone; within about 1 % (14 bits), exact for few."""
    return sketches.agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])


def band_minmax(pixels: DataFrame, *keys: str, value: str = "v") -> DataFrame:
    return pixels.groupBy(*keys, "band").agg(F.min(value).alias("lo"), F.max(value).alias("hi"))


def clip(x: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(x, F.lit(lo)), F.lit(hi))


def percentile_scale(pixels: DataFrame, *keys: str, spread: bool = False) -> DataFrame:
    """clip((v - p2) / (p98 - p2 + 1e-6), 0, 1) per group and band; spread as in band_percentiles. A row per group and band joins back, by a broadcast where these are few."""
    joined = pixels.join(few(band_percentiles(pixels, *keys, spread=spread)), [*keys, "band"])
    return joined.withColumn("v", clip((F.col("v") - F.col("p_lo")) / (F.col("p_hi") - F.col("p_lo") + 1e-6), 0.0, 1.0)).drop("p_lo", "p_hi")


def standardize_rgb(pixels: DataFrame) -> DataFrame:
    """(v - mean) / deviation for bands 1 to 3, others as they are."""
    out = F.col("v")
    for band, (m, s) in enumerate(zip(RGB_MEAN, RGB_STD, strict=True), 1):
        out = F.when(F.col("band") == band, (F.col("v") - m) / s).otherwise(out)
    return pixels.withColumn("v", out)


def minmax_scale(pixels: DataFrame, *keys: str) -> DataFrame:
    """(v - min) / (max - min); a constant band becomes 0."""
    joined = pixels.join(few(band_minmax(pixels, *keys)), [*keys, "band"])
    return joined.withColumn("v", F.when(F.col("hi") > F.col("lo"), (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0.0)).drop("lo", "hi")


def tile_ratios(pixels: DataFrame, key: str, valid: str = "valid", covered: str = "covered") -> DataFrame:
    return pixels.groupBy(key).agg(F.avg(F.col(valid).cast("double")).alias("valid_ratio"), F.avg(F.col(covered).cast("double")).alias("coverage_ratio"))


def tile_class_set(mask: DataFrame, key: str) -> DataFrame:
    return mask.groupBy(key).agg(F.sort_array(F.collect_set("class_id")).alias("class_ids"))


def class_tile_counts(meta: DataFrame, classes: DataFrame) -> DataFrame:
    """class_id, label, n_tiles that contain it, and their share of all tiles in percent; classes without tiles have 0."""
    total = meta.agg(F.count("*").alias("total"))
    counted = meta.select(F.explode("class_ids").alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n_tiles"))
    filled = F.broadcast(classes.select("class_id", "label")).join(counted, "class_id", "left").crossJoin(F.broadcast(total))
    n = F.coalesce("n_tiles", F.lit(0).cast("bigint"))
    return filled.select("class_id", "label", n.alias("n_tiles"), F.when(F.col("total") > 0, n * 100.0 / F.col("total")).otherwise(0.0).alias("percent"))


def class_distribution(mask: DataFrame, *levels: str) -> DataFrame:
    """levels, class_id, n, share: pixels per class at each level of a rollup and over all, and their share of the level's pixels; a level that is summed up is null.

    The pixels are counted once; the levels above add up those counts.
    """
    base = mask.groupBy(*levels, "class_id").agg(F.count("*").alias("n"))
    out, total = None, None
    for k in range(len(levels), -1, -1):
        keys = levels[:k]
        part = base.groupBy(*keys, "class_id").agg(F.sum("n").alias("n"))
        total = base.groupBy(*keys).agg(F.sum("n").alias("total"))
        part = part.join(total, list(keys)) if keys else part.crossJoin(F.broadcast(total))
        part = part.select(*[F.col(c) if c in keys else F.lit(None).cast(dict(mask.dtypes)[c]).alias(c) for c in levels], "class_id", "n", (F.col("n") / F.col("total")).alias("share"))
        out = part if out is None else out.union(part)
    return out


def weight_map(weights: dict[int, float]) -> Column:
    return F.create_map(*[F.lit(x) for k, w in weights.items() for x in (int(k), float(w))])


def rarest_class(class_ids: Column, weights: dict[int, float]) -> Column:
    """The class of the largest sampler weight; of equals, the least id."""
    w = weight_map(weights)
    best = F.array_max(F.transform(class_ids, lambda c: F.struct(F.coalesce(w[c], F.lit(1.0)).alias("w"), (-c).alias("neg"))))
    return -best["neg"]


def sample_weight(class_ids: Column, weights: dict[int, float]) -> Column:
    """The largest class weight of a tile; 1 for a class without one."""
    w = weight_map(weights)
    return F.array_max(F.transform(class_ids, lambda c: F.coalesce(w[c], F.lit(1.0))))


def layer_summary(features: DataFrame) -> DataFrame:
    """features (layer, geom_type, minx, miny, maxx, maxy, attrs) by layer: how many, geometry types, bounds, attribute names."""
    return features.groupBy("layer").agg(
        F.count("*").alias("features"), F.sort_array(F.collect_set("geom_type")).alias("geom_types"), F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.map_keys("attrs"))))).alias("columns"),
    )


def dir_bytes(files: DataFrame, folders: DataFrame) -> DataFrame:
    """folder, bytes of the files in it, 0 if there are none."""
    summed = files.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).agg(F.sum("length").alias("bytes"))
    return folders.join(summed, "folder", "left").select("folder", F.coalesce("bytes", F.lit(0).cast("bigint")).alias("bytes"))


def percent_of_total(counts: DataFrame, total: DataFrame) -> DataFrame:
    """counts (..., n) with percent of total (one row: total)."""
    return counts.crossJoin(F.broadcast(total)).withColumn("percent", F.col("n") * 100.0 / F.col("total")).drop("total")


def class_coverage_string(counts: DataFrame) -> DataFrame:
    """One row: label=count in class order."""
    pairs = F.sort_array(F.collect_list(F.struct("class_id", F.concat_ws("=", "label", F.col("n_tiles").cast("string")).alias("text"))))
    return counts.agg(F.array_join(F.transform(pairs, lambda p: p["text"]), ", ").alias("coverage"))


def run_summary(meta: DataFrame, counts: DataFrame, budget_gb: float, bytes_per_tile: int) -> DataFrame:
    """One row: total_tiles, budget_gb, used_gb, class_tile_counts as a map."""
    by_class = counts.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("class_id", "n_tiles")))).alias("class_tile_counts"))
    total = meta.agg(F.count("*").alias("total_tiles"))
    return total.crossJoin(by_class).select("total_tiles", F.lit(budget_gb).alias("budget_gb"), (F.col("total_tiles") * bytes_per_tile / float(1 << 30)).alias("used_gb"), "class_tile_counts")
