"""User functions over tiles: transforms, scorers, block functions, a tile-grid table function, a pixel classifier and an IoU aggregate."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf, udtf

from rasterweave.operators.metrics import argmax_class
from rasterweave.operators.stats import weight_map

Transform = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def map_tiles(tiles: DataFrame, fn: Transform, bands: int, size: int) -> DataFrame:
    """tiles (id, image, mask; flat arrays) with fn on the first three bands and the mask; further bands pass through. Nulls of an image are NaN to fn, and stay nulls or NaN."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            images, masks = [], []
            for image, mask in zip(frame["image"], frame["mask"], strict=True):
                image = np.array(image, dtype=float).reshape(bands, size, size)
                front, mask = fn(image[:3], np.array(mask).reshape(size, size))
                images.append(np.concatenate((front, image[3:])).ravel())
                masks.append(mask.ravel())
            yield frame.assign(image=images, mask=masks)

    return tiles.mapInPandas(run, tiles.schema)


def score_tiles(tiles: DataFrame, load: Callable[[], Callable[[np.ndarray], np.ndarray]], k: int = 4) -> DataFrame:
    """tiles with probs: load runs once per worker and gives the scorer, which takes a batch of rows of the column x and returns k probabilities each. Rows that hold a null are not scored; their probs are null."""

    @pandas_udf("array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = load()
        for x in batches:
            out, whole = pd.Series([None] * len(x), dtype=object), x.notna().to_numpy()
            if whole.any():
                out[whole] = pd.Series(list(scorer(np.stack(x[whole].to_numpy()))), index=out.index[whole])
            yield out

    return tiles.withColumn("probs", score(F.when(F.forall("x", lambda v: v.isNotNull()), F.col("x"))))


def flat_map_blocks(blocks: DataFrame, fn: Callable[[dict], list[tuple]], keys: list[str], schema: str) -> DataFrame:
    """keys, and the rows of schema that fn makes of each block (a dict of its columns), with error; a block that fails is one row with its keys and the message."""
    types = dict(blocks.dtypes)
    out_schema = ", ".join([*(f"{k} {types[k]}" for k in keys), schema, "error string"])
    made = blocks.sparkSession.createDataFrame([], schema).toArrow().schema

    def plain(column: pa.Array) -> list:
        """A value per block: arrays as numpy has them, the rest as Python has it, so that whole numbers stay whole beside nulls."""
        if pa.types.is_list(column.type) and pa.types.is_primitive(column.type.value_type):
            return [x.values.to_numpy(zero_copy_only=False) if x.is_valid else None for x in column]
        return column.to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows, errors = [], [], []
            for i, values in enumerate(zip(*map(plain, batch.columns), strict=True)):
                try:
                    own = [tuple(row) for row in fn(dict(zip(batch.schema.names, values, strict=True)))]
                    errors += [None] * len(own)
                except Exception as e:  # any failure stays with its block
                    own = [(None,) * len(made)]
                    errors.append(f"{type(e).__name__}: {e}")
                at += [i] * len(own)
                rows += own
            columns = [pa.array([row[j] for row in rows], field.type) for j, field in enumerate(made)]
            there = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(there) for k in keys), *columns, pa.array(errors, pa.string())], names=[*keys, *made.names, "error"])

    return blocks.mapInArrow(run, out_schema)


@udtf(returnType="row int, col int")
class TileGrid:
    """(width, height, tile, overlap) -> origins of whole tiles."""

    def eval(self, width: int, height: int, tile: int, overlap: int):
        for row in range(0, height - tile + 1, tile - overlap):
            for col in range(0, width - tile + 1, tile - overlap):
                yield row, col


def fit_pixel_classifier(pixels: DataFrame, bands: list[str], weights: dict[int, float]) -> PipelineModel:
    """Multinomial logistic regression on pixels (bands, target), weighted by class; the fit is distributed. Pixels that lack a band are not learnt from."""
    rows = pixels.dropna(subset=bands).withColumn("weight", weight_map(weights)[F.col("target")])
    return Pipeline(stages=[VectorAssembler(inputCols=bands, outputCol="features", handleInvalid="keep"), LogisticRegression(labelCol="target", weightCol="weight", family="multinomial", maxIter=15)]).fit(rows)


def predict_pixels(pixels: DataFrame, model: PipelineModel) -> DataFrame:
    """pixels with probs and pred, both null where a pixel lacks a band."""
    scored = model.transform(pixels).withColumn("probs", vector_to_array("probability"))
    scored = scored.withColumn("probs", F.when(~F.exists("probs", F.isnan), F.col("probs")))
    return scored.withColumn("pred", argmax_class(F.col("probs"))).drop("features", "rawPrediction", "probability", "prediction")


def miou_udaf(k: int = 4):
    """mean IoU of (pred, target, n) rows as one aggregate; over confusion counts, of which there are k * k."""

    @pandas_udf("double")
    def miou(pred: pd.Series, target: pd.Series, n: pd.Series) -> float:
        table = np.zeros((k, k))
        np.add.at(table, (pred.to_numpy(), target.to_numpy()), n.to_numpy())
        inter, union = np.diag(table), table.sum(0) + table.sum(1) - np.diag(table)
        return float((inter[union > 0] / union[union > 0]).mean()) if (union > 0).any() else 0.0

    return miou
