"""Sinks and what reads them back: tiles, tile metadata, replay slices, masks and histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rasterweave.model import CLASSES, IGNORE, TILE_META_SCHEMA


#: Rows that one file of tiles holds, about, at 4.4 MB a tile.
FILE_TILES = 64


def z_order(row: str | Column, col: str | Column) -> Column:
    """Interleaves the low 16 bits of two whole numbers, so that places near each other in both axes have near keys."""

    def apart(x: Column) -> Column:
        x = x.cast("bigint").bitwiseAND(0xFFFF)
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(mask)
        return x

    return F.shiftleft(apart(F.col(row) if isinstance(row, str) else row), 1).bitwiseOR(apart(F.col(col) if isinstance(col, str) else col))


def write_tiles(tiles: DataFrame, path: str, row: str | None = None, col: str | None = None, step: int = 448, per_file: int = FILE_TILES) -> None:
    """Tile rows by shard, in files of about per_file tiles: a shard is cut into ranges, so several tasks write it.

    With the columns of a tile's place, files follow a space-filling order of places (in units of step) and `path-bounds` holds the bounds of each file,
    shard, file, tiles, lo_row, hi_row, lo_col, hi_col, by which read_tiles leaves files unopened. Without, tiles are sorted by id. Tiles are passed over three times (number, ranges, rows), so what is costly to make
    should be a written table.
    """
    spark = tiles.sparkSession
    keys = [z_order(F.floor(F.col(row) / step), F.floor(F.col(col) / step)).alias("_z")] if row and col else []
    keyed = tiles.select("*", *keys)
    order = ["shard", "_z", "id"] if keys else ["shard", "id"]
    parts = max(1, -(-tiles.count() // per_file))
    keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_z").write.mode("overwrite").partitionBy("shard").parquet(path)
    if keys:
        written = spark.read.schema(tiles.schema).parquet(path).select("shard", row, col, F.col("_metadata.file_name").alias("file"))
        bounds = written.groupBy("shard", "file").agg(F.count("*").alias("tiles"), F.min(row).alias("lo_row"), F.max(row).alias("hi_row"), F.min(col).alias("lo_col"), F.max(col).alias("hi_col"))
        bounds.write.mode("overwrite").parquet(f"{path}-bounds")


def read_tiles(spark: SparkSession, path: str, schema: StructType, row: str, col: str, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """Tiles whose place lies in the ranges, both ends included, from the files whose bounds meet them; no other file is opened."""
    bounds = spark.read.parquet(f"{path}-bounds").where((F.col("hi_row") >= rows[0]) & (F.col("lo_row") <= rows[1]) & (F.col("hi_col") >= cols[0]) & (F.col("lo_col") <= cols[1]))
    files = [f"{path}/shard={r.shard}/{r.file}" for r in bounds.select("shard", "file").collect()]  # a row per file of the window
    if not files:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", path).parquet(*files)
    return found.select(*schema.names).where(F.col(row).between(*rows) & F.col(col).between(*cols))


def write_tile_meta(meta: DataFrame, path: str) -> None:
    """The rows, and beside them a summary: tiles, sources, shards, and how many tiles show each class, as one document."""
    meta.write.mode("overwrite").json(path)
    by_class = meta.select(F.explode("class_ids").alias("c")).groupBy("c").agg(F.count("*").alias("n")).agg(F.sort_array(F.collect_list(F.struct(F.col("c").alias("class_id"), F.col("n").alias("tiles")))).alias("classes"))  # a row per class
    whole = meta.agg(F.count("*").alias("total_tiles"), F.countDistinct("source").alias("sources"), F.countDistinct("shard").alias("shards"))
    whole.crossJoin(F.broadcast(by_class)).write.mode("overwrite").json(f"{path}-summary")


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("total_tiles bigint, sources bigint, shards bigint, classes array<struct<class_id:int,tiles:bigint>>").json(f"{path}-summary")


def read_tile_meta(spark: SparkSession, path: str) -> DataFrame:
    """Fails if there is none."""
    return spark.read.schema(TILE_META_SCHEMA).json(path)


def write_replay(selected: DataFrame, path: str) -> None:
    """Replaces the slices of the shards that selected has; other shards' stay. A repeated write changes nothing."""
    selected.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)


def read_replay(spark: SparkSession, path: str, schema: str = TILE_META_SCHEMA) -> DataFrame:
    """All shards' slices; empty if there are none."""
    empty = spark.createDataFrame([], schema)
    if not path_exists(spark, path):
        return empty
    return spark.read.schema(schema).parquet(path).select(*empty.columns)


def write_slice(selected: DataFrame, path: str, batch: int) -> None:
    """The replay slices of the shards of a batch (at least one row each), as a version of their own: rows first, then the manifest that makes them visible.

    A batch that is written again, whole or after it broke off anywhere, replaces itself and nothing else.
    """
    spark = selected.sparkSession
    selected.write.mode("overwrite").partitionBy("shard").parquet(f"{path}/data/batch={batch}")
    written = spark.read.schema(selected.schema).parquet(f"{path}/data/batch={batch}")
    written.groupBy("shard").agg(F.count("*").alias("tiles")).write.mode("overwrite").parquet(f"{path}/manifest/batch={batch}")


def slices(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """shard, batch, tiles: each shard's latest version among the batches before that number, or all. A row per shard."""
    if not path_exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], "shard string, batch bigint, tiles bigint")
    versions = spark.read.schema("shard string, tiles bigint, batch bigint").parquet(f"{path}/manifest")
    return versions.where(F.col("batch") < before if before is not None else F.lit(True)).groupBy("shard").agg(F.max("batch").alias("batch"), F.max_by("tiles", "batch").alias("tiles"))


def read_slices(spark: SparkSession, path: str, schema: StructType | str, before: int | None = None) -> DataFrame:
    """The rows of slices(); other versions are pruned by their folders. A batch that reads what stood before it finds the same again when it is repeated."""
    empty = spark.createDataFrame([], schema)
    if not path_exists(spark, f"{path}/manifest"):
        return empty
    rows = spark.read.schema(StructType([*empty.schema.fields, StructField("batch", LongType())])).parquet(f"{path}/data")
    return rows.join(F.broadcast(slices(spark, path, before).select("shard", "batch")), ["shard", "batch"]).select(*empty.columns)


def drop_superseded(spark: SparkSession, path: str, before: int) -> None:
    """Deletes the versions that no batch from that number on can read, their manifests first."""
    kept = {r.batch for r in slices(spark, path, before).collect()}  # a row per shard
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for batch in range(before):
        for part in ("manifest", "data") if batch not in kept else ():
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}/batch={batch}"), True)


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at))


def clear_shard(spark: SparkSession, path: str, shard: str) -> None:
    """Drops one shard's files; the others' stay."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/shard={shard}")
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def write_mask(mask: DataFrame, path: str) -> None:
    """Class per pixel, the nodata value where it is null; the column's metadata names the classes."""
    names = {f"class_{c[0]}": c[2] for c in CLASSES} | {"nodata": str(IGNORE)}
    value = F.coalesce(F.col("class_id").cast("smallint"), F.lit(IGNORE).cast("smallint"))
    mask.withColumn("class_id", value.alias("class_id", metadata=names)).write.mode("overwrite").option("compression", "zstd").parquet(path)


#: Epochs of a run that one row of a history holds.
CHUNK_EPOCHS = 10_000


def write_history(epochs: DataFrame, path: str, chunk: int = CHUNK_EPOCHS) -> None:
    """Rows of parallel arrays, one for each chunk of a run's epochs (by number), so that a long run is no one row. read_history puts them together."""
    rows = epochs.groupBy("run_id", F.floor(F.col("epoch") / chunk).alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("epoch", "val_miou", "val_loss"))).alias("h"))
    rows.select("run_id", "chunk", "h.epoch", "h.val_miou", "h.val_loss").write.mode("overwrite").json(path)


def read_history(history: DataFrame) -> DataFrame:
    """run_id, epoch, val_miou, val_loss from parallel arrays."""
    return history.select("run_id", F.inline(F.arrays_zip("epoch", "val_miou", "val_loss")))
