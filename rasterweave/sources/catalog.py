"""Scans: file listings, raster catalogues, pixel windows, run logs and shard lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LARGE_MB = 4096


def list_files(spark: SparkSession, roots: list[str], suffixes: tuple[str, ...]) -> DataFrame:
    """path, length, modificationTime of the files below the roots, each once; contents are not read."""
    glob = "*.{" + ",".join(suffixes) + "}"
    parts = [spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root).select("path", "length", "modificationTime") for root in roots]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.dropDuplicates(["path"])


def resolve_layers(classes: DataFrame, files: DataFrame) -> DataFrame:
    """classes (class_id, class_name, layer_file) with the path of the first file of that name, and found or missing."""
    named = files.withColumn("layer_file", F.substring_index("path", "/", -1)).groupBy("layer_file").agg(F.min("path").alias("path"))
    return classes.join(named, "layer_file", "left").withColumn("status", F.when(F.col("path").isNull(), "missing").otherwise("found"))


def raster_catalog(rasters: DataFrame) -> DataFrame:
    """rasters with pixel_count, raw_mb and large."""
    pixels = F.col("width").cast("bigint") * F.col("height")
    raw = pixels * F.col("n_bands") * F.col("itemsize") / 1048576
    return rasters.withColumns({"pixel_count": pixels, "raw_mb": raw, "large": raw > LARGE_MB})


def to_blocks(pixels: DataFrame, height: int, width: int) -> DataFrame:
    """Long pixels (gr, gc, band, v) as blocks of row-major arrays with nulls where there is no pixel."""
    at = (F.pmod("gr", F.lit(height)) * width + F.pmod("gc", F.lit(width))).cast("int")
    grouped = pixels.groupBy(F.floor(F.col("gr") / height).alias("block_row"), F.floor(F.col("gc") / width).alias("block_col"), "band").agg(F.map_from_entries(F.collect_list(F.struct(at.alias("at"), "v"))).alias("m"))
    data = F.transform(F.sequence(F.lit(0), F.lit(height * width - 1)), lambda i: F.col("m")[i])
    return grouped.select("block_row", "block_col", "band", F.lit(height).alias("h"), F.lit(width).alias("w"), data.alias("data"))


def read_window(blocks: DataFrame, bands: list[int], col: int, row: int, width: int, height: int, block_height: int, block_width: int) -> DataFrame:
    """band, gr, gc, v in a window; block and band predicates reach the scan, so other blocks are not read."""
    wanted = blocks.where(
        F.col("band").isin(*bands) & F.col("block_row").between(row // block_height, (row + height - 1) // block_height) & F.col("block_col").between(col // block_width, (col + width - 1) // block_width)
    )
    px = wanted.select("band", "block_row", "block_col", "w", "h", F.posexplode("data").alias("at", "v")).where(F.col("v").isNotNull())
    px = px.select("band", (F.col("block_row") * F.col("h") + F.floor(F.col("at") / F.col("w"))).alias("gr"), (F.col("block_col") * F.col("w") + F.col("at") % F.col("w")).alias("gc"), "v")
    return px.where(F.col("gr").between(row, row + height - 1) & F.col("gc").between(col, col + width - 1))


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of run logs stored as `line_no<TAB>line` under run_id=... folders."""
    raw = spark.read.option("basePath", path).text(path)
    return raw.select("run_id", F.substring_index("value", "\t", 1).cast("bigint").alias("line_no"), F.expr("substring(value, instr(value, '\\t') + 1)").alias("line"))


def parse_shard_list(text: Column, default: list[str]) -> Column:
    """Names of a colon-separated list, trimmed, empties dropped; the default where nothing is left or the text is null."""
    names = F.filter(F.transform(F.split(text, ":"), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.coalesce(F.size(names), F.lit(0)) > 0, names).otherwise(F.array(*map(F.lit, default)))
