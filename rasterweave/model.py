"""Tables of the engine: schemas and the class dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TILE, OVERLAP, STRIDE, CHUNK = 512, 64, 448, 8192
IGNORE = 255
N_CLASSES = 4
#: Id, name, label, overlay priority, sampler weight, loss weight, colour.
CLASSES = [
    (0, "background", "Background", 0, 0.3, 0.4, [50, 50, 50]),
    (1, "builtup", "Built-up", 1, 1.5, 1.2, [210, 140, 80]),
    (2, "road", "Road", 3, 5.0, 4.0, [255, 220, 80]),
    (3, "waterbody", "Water Body", 2, 3.0, 2.0, [80, 160, 230]),
]
#: Mean and deviation of the first three bands.
RGB_MEAN, RGB_STD = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)

CLASS_SCHEMA = T.StructType([
    T.StructField("class_id", T.IntegerType()), T.StructField("class_name", T.StringType()), T.StructField("label", T.StringType()), T.StructField("priority", T.IntegerType()),
    T.StructField("sampler_w", T.DoubleType()), T.StructField("loss_w", T.DoubleType()), T.StructField("rgb", T.ArrayType(T.IntegerType())),
])
RING = "array<struct<x:double,y:double>>"
RASTER_SCHEMA = "raster_id string, width int, height int, n_bands int, itemsize int, crs int, minx double, miny double, maxx double, maxy double, nodata double"
PIXEL_SCHEMA = "tile_id bigint, band int, r int, c int, v double"
FEATURE_SCHEMA = f"feature_id bigint, layer string, class_id int, crs int, geom_type string, rings array<{RING}>, attrs map<string,string>"
TILE_META_SCHEMA = "id string, source string, shard string, trow bigint, tcol bigint, coverage_ratio double, class_ids array<int>"
EPOCH_SCHEMA = "run_id string, epoch int, ts timestamp, train_loss double, val_loss double, train_miou double, val_miou double"


def classes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CLASSES, CLASS_SCHEMA)


def class_map(column: int) -> dict[int, float]:
    """class_id to a column of CLASSES, by its place there."""
    return {c[0]: c[column] for c in CLASSES}
