"""Joins of tiles with their parts, places, sources and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_image_mask(images: DataFrame, masks: DataFrame, key: str = "id") -> DataFrame:
    return images.join(masks, key)


def complete_pairs(meta: DataFrame, images: DataFrame, masks: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """The tiles of which both files exist, and the others."""
    have = meta.join(images.select(key), key, "left_semi").join(masks.select(key), key, "left_semi")
    return have, meta.join(have.select(key), key, "left_anti")


def locate_tile(current: DataFrame, replay: DataFrame, key: str = "id") -> DataFrame:
    """key and path: the replay store's, else the current shard's."""
    return current.join(replay.withColumnRenamed("path", "replay_path"), key, "left").select(key, F.coalesce("replay_path", "path").alias("path"))


def semi_by_source(tiles: DataFrame, sources: DataFrame) -> DataFrame:
    return tiles.join(sources.select("source"), "source", "left_semi")


def label_lookup(df: DataFrame, classes: DataFrame, class_col: str = "class_id") -> DataFrame:
    """df with label: the class's, or cls and its number."""
    names = F.broadcast(classes.select(F.col("class_id").alias("_class"), "label"))
    fallback: Column = F.concat(F.lit("cls"), F.col(class_col))
    return df.join(names, F.col(class_col) == F.col("_class"), "left").withColumn("label", F.coalesce("label", fallback)).drop("_class")
