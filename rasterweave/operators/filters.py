"""Projections, filters and predicates over pixels, tiles and prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterweave.functions.scalars import hash_number

MIN_VALID, MIN_COVERAGE = 0.1, 0.05


def select_bands(bands: Column, wanted: list[int], n_bands: int) -> Column:
    """1-based bands of an array, of the list's first n_bands."""
    return F.transform(F.array(*map(F.lit, wanted[:n_bands])), lambda i: F.element_at(bands, i))


def drop_nodata(pixels: DataFrame, value: str = "v", nodata: str = "nodata") -> DataFrame:
    return pixels.where(F.col(nodata).isNull() | (F.col(value) != F.col(nodata)))


def valid_mask(pixels: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    """keys and valid: whether any band differs from 0."""
    return pixels.groupBy(*keys).agg(F.bool_or(F.col(value) != 0).alias("valid"))


def filter_tiles_quality(ratios: DataFrame, coverage_setting: float = 0.0) -> DataFrame:
    """Tiles of which a tenth is valid, and of which the setting, but 5 % at least, is covered."""
    return ratios.where((F.col("valid_ratio") >= MIN_VALID) & (F.col("coverage_ratio") >= max(coverage_setting, MIN_COVERAGE)))


def filter_tiles_with_class(tiles: DataFrame, class_id: int, id_col: str = "id", classes_col: str = "class_ids", sample: int = 200, seed: int = 42) -> DataFrame:
    """Of a sample of tiles in hash order, those that have a class; all tiles if none of them has it."""
    sampled = tiles.orderBy(hash_number(seed, id_col), id_col).limit(sample)
    chosen = sampled.where(F.array_contains(F.coalesce(classes_col, F.array().cast("array<int>")), class_id))
    found = chosen.agg((F.count("*") > 0).alias("some"))
    # one row of found meets every tile: a filter by a scalar, not a product
    return chosen.union(tiles.crossJoin(F.broadcast(found)).where("not some").drop("some"))


def default_class_ids(meta: DataFrame) -> DataFrame:
    return meta.withColumns({"class_ids": F.coalesce("class_ids", F.array(F.lit(0))), "coverage_ratio": F.coalesce("coverage_ratio", F.lit(0.0))})


def drop_null_geometry(features: DataFrame, rings: str = "rings") -> DataFrame:
    return features.where(F.col(rings).isNotNull() & (F.size(rings) > 0))


def parse_prompts(prompts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(seq, x, y, class_name) of `x,y,class` texts, and the rest (seq, txt)."""
    parts = F.split("txt", ",")
    parsed = prompts.select("seq", "txt", F.size(parts).alias("n"), F.trim(F.get(parts, F.lit(0))).try_cast("double").alias("x"), F.trim(F.get(parts, F.lit(1))).try_cast("double").alias("y"), F.trim(F.get(parts, F.lit(2))).alias("class_name"))
    good = (F.col("n") == 3) & F.col("x").isNotNull() & F.col("y").isNotNull()
    return parsed.where(good).select("seq", "x", "y", "class_name"), parsed.where(~good).select("seq", "txt")


def validate_class(prompts: DataFrame, classes: DataFrame, known: bool = True) -> DataFrame:
    """The prompts whose class is known, or the others."""
    return prompts.join(F.broadcast(classes.select("class_name")), "class_name", "left_semi" if known else "left_anti")


def resume_from(shards: DataFrame, step: int, total: int) -> DataFrame:
    if not 1 <= step <= total:
        raise ValueError(f"resume step {step} is outside 1..{total}")
    return shards.where(F.col("step") >= step)
