"""User functions, aggregates and table functions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.fixtures import fixture, oracle
from rasterweave.model import class_map
from rasterweave.operators import metrics, tile_udfs
from rasterweave.queries.aggregations import _PAIRS, IOU_SQL, pairs, rounded
from rasterweave.queries.functions import TILE_SQL, bands_of
from rasterweave.registry import query


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of four bands, null where a tile lacks one, and masks."""
    values = lambda *c: F.transform(F.sort_array(F.collect_list(F.struct(*c))), lambda s: s[c[-1]])
    planes = fixture(spark, sf_dir, "fx_px").groupBy(F.col("tile_id").alias("id"), "band").agg(values("r", "c", "v").alias("plane"))
    none = F.array_repeat(F.lit(None).cast("double"), 64)
    image = planes.groupBy("id").agg(F.concat(*[F.coalesce(F.first(F.when(F.col("band") == i, F.col("plane")), ignorenulls=True), none) for i in range(1, 5)]).alias("image"))
    mask = fixture(spark, sf_dir, "fx_scores").groupBy(F.col("tile_id").alias("id")).agg(values("r", "c", "target").alias("mask"))
    return image.join(mask, "id")


@query(oracle("select tile_id id, round(sum(case when band <= 3 then 1 - v else v end), 5) total, (select cast(sum(target * (8 - c)) as bigint) from fx_scores s where s.tile_id = p.tile_id) mask_check from fx_px p group by 1", "fx_px", "fx_scores"))
def map_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = tile_udfs.map_tiles(_tiles(spark, sf_dir), lambda image, mask: (1 - image, mask[:, ::-1]), 4, 8)
    total = F.aggregate(F.filter("image", lambda x: x.isNotNull() & ~F.isnan(x)), F.lit(0.0), lambda a, x: a + x)
    check = F.aggregate(F.transform("mask", lambda x, i: x * (i % 8 + 1)), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return mapped.select("id", F.round(total, 5).alias("total"), check.alias("mask_check"))


def _scorer():
    weight = np.array([[1.0, -1.0, 0.5, 0.0], [0.0, 2.0, -0.5, 1.0], [-1.0, 0.0, 1.0, 0.5], [0.5, 0.5, 0.5, -1.0]])

    def score(x: np.ndarray) -> np.ndarray:
        raised = np.exp(x @ weight)
        return raised / raised.sum(1, keepdims=True)

    return score


_Z = ("b[1] - b[3] + 0.5e0 * b[4]", "-b[1] + 2 * b[2] + 0.5e0 * b[4]", "0.5e0 * b[1] - 0.5e0 * b[2] + b[3] + 0.5e0 * b[4]", "b[2] + 0.5e0 * b[3] - b[4]")


@query(oracle("select tile_id, r, c, " + ", ".join(f"round(e{i} / (e0 + e1 + e2 + e3), 6) p{i}" for i in range(4)) + " from (select tile_id, r, c, " + ", ".join(f"exp({z}) e{i}" for i, z in enumerate(_Z)) + " from (select tile_id, r, c, list(v order by band) b from fx_px group by 1, 2, 3))", "fx_px"))
def score_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = tile_udfs.score_tiles(bands_of(fixture(spark, sf_dir, "fx_px")).withColumnRenamed("bands", "x"), _scorer)
    return scored.select("tile_id", "r", "c", *[F.round(F.col("probs")[i], 6).alias(f"p{i}") for i in range(4)])


@query(oracle("select tile_id, band, half, round(total, 5) total, error from (select tile_id, band, cast(r // 4 as bigint) half, sum(v) total, cast(null as varchar) error from fx_px where tile_id % 10 <> 0 group by 1, 2, 3 union all select distinct tile_id, band, null, null, 'ValueError: no data' from fx_px where tile_id % 10 = 0)", "fx_px"))
def flat_map_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = fixture(spark, sf_dir, "fx_px").groupBy("tile_id", "band").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "c", "v"))), lambda s: s.v).alias("data"))

    def halves(block: dict) -> list[tuple]:
        data = np.array(block["data"])
        if not data.any():
            raise ValueError("no data")
        return [(i, float(half.sum())) for i, half in enumerate((data[:32], data[32:]))]

    return rounded(tile_udfs.flat_map_blocks(blocks, halves, ["tile_id", "band"], "half bigint, total double"), "total", digits=5)


@query(TILE_SQL)
def tile_grid_udtf(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.udtf.register("tile_grid_udtf", tile_udfs.TileGrid)
    return spark.sql("select raster_id, row, col from {rasters}, lateral tile_grid_udtf(width, height, 512, 64)", rasters=fixture(spark, sf_dir, "fx_rasters"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = bands_of(fixture(spark, sf_dir, "fx_px")).select("tile_id", "r", "c", *[F.col("bands")[i].alias(f"b{i + 1}") for i in range(4)])
    return wide.join(fixture(spark, sf_dir, "fx_scores").select("tile_id", "r", "c", "target"), ["tile_id", "r", "c"]).where("target <> 255")


@query()
def fit_pixel_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted model's counts of predictions by class."""
    px = _labelled(spark, sf_dir)
    model = tile_udfs.fit_pixel_classifier(px, ["b1", "b2", "b3", "b4"], class_map(5))
    return tile_udfs.predict_pixels(px, model).groupBy("pred").agg(F.count("*").alias("n"))


@query()
def predict_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for all pixels; the model learns from tiles that are not held out."""
    px = _labelled(spark, sf_dir).withColumn("held_out", F.col("tile_id") % 5 == 0)
    model = tile_udfs.fit_pixel_classifier(px.where("not held_out"), ["b1", "b2", "b3", "b4"], class_map(5))
    return tile_udfs.predict_pixels(px, model).select("tile_id", "r", "c", "held_out", "target", "pred")


@query(oracle(f"select distinct miou from ({IOU_SQL})", "fx_scores", "fx_classes", pairs=_PAIRS))
def miou_udaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    confusion = metrics.confusion_matrix(pairs(spark, sf_dir))
    return rounded(confusion.agg(tile_udfs.miou_udaf()("pred", "target", "n").alias("miou")), "miou", digits=9)
