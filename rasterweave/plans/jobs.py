"""Whole jobs: inspection, preprocessing, training sets, prediction, sample reports and incremental runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.functions import grid, scalars
from rasterweave.model import CLASSES, IGNORE
from rasterweave.operators import filters, metrics, scoring, selection, spatial, stats
from rasterweave.session import saved
from rasterweave.sources import catalog, sinks
from rasterweave.streaming import shards
from rasterweave.streaming.alerts import alert_rows, complete_rows


def inspect(rasters: DataFrame, edges: DataFrame, pixels: DataFrame) -> DataFrame:
    """Per raster: size in MB, whether large, overlapping layers with their number of features, and the mean of each band (null without pixels). pixels: raster_id, band, v."""
    boxes = spatial.edge_boxes(edges, "class_id", "fid").withColumn("layer", F.col("class_id").cast("string"))
    summary = stats.layer_summary(boxes.withColumns({"geom_type": F.lit("Polygon"), "attrs": F.create_map(F.lit("fid"), F.col("fid").cast("string"))}))
    overlap = spatial.bbox_overlap_join(rasters, summary)
    named = overlap.select("raster_id", F.explode(F.split("layers", ",")).alias("layer")).join(summary.select("layer", "features"), "layer")
    features = named.groupBy("raster_id").agg(F.sum("features").alias("features"))
    means = stats.band_stats(pixels, "raster_id").groupBy("raster_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("band", "mean"))), lambda s: F.round(s["mean"], 6)).alias("band_means"))
    found = catalog.raster_catalog(rasters).join(overlap, "raster_id").join(features, "raster_id", "left").join(means, "raster_id", "left")
    return found.select("raster_id", "pixel_count", "raw_mb", "large", "layers", F.coalesce("features", F.lit(0)).cast("bigint").alias("features"), "band_means")


def preprocess(pixels: DataFrame, edges: DataFrame, classes: DataFrame, weights: dict[int, float], stem: str, tile: int, step: int, max_tiles: int, budget: int, seed: int = 42) -> DataFrame:
    """Pixels (band, gr, gc, v) and edges to the metadata of the tiles that are kept, in a seeded order up to a budget in bytes, and summed up in used_gb and total_tiles.

    Bands are scaled between their percentiles over the whole raster. Polygons are burned once; every pixel knows whether it is valid, its class and its scaled mean
    before it is dealt to its tiles, so the pixel grid is shuffled for bands and for tiles only. Quotas are two window functions over tile rows.
    """
    size = pixels.agg((F.max("gr") + 1).alias("height"), (F.max("gc") + 1).alias("width"), F.count_distinct("band").alias("bands"))
    height, width, bands = (int(x) for x in size.first())
    mask = spatial.overlay_by_priority(spatial.rasterize_polygons(edges, "class_id", "fid", height=height, width=width), classes)
    scaled = stats.percentile_scale(pixels.select(F.lit(0).alias("raster"), "band", "gr", "gc", "v", F.col("v").alias("raw")), "raster", spread=True)
    valid = scaled.groupBy("gr", "gc").agg(F.bool_or(F.col("raw") != 0).alias("valid"), F.avg("v").alias("shade"))
    px = valid.join(mask.select(F.col("row").alias("gr"), F.col("col").alias("gc"), "class_id"), ["gr", "gc"], "left").withColumn("class_id", F.coalesce("class_id", F.lit(0)))
    dealt = grid.crop_tiles(px, tile, step, F.lit(height), F.lit(width))
    tiles = dealt.groupBy("tile_row", "tile_col").agg(F.avg(F.col("valid").cast("double")).alias("valid_ratio"), F.avg((F.col("class_id") > 0).cast("double")).alias("coverage_ratio"), F.sort_array(F.collect_set("class_id")).alias("class_ids"), F.avg("shade").alias("shade"))
    kept = filters.filter_tiles_quality(tiles).withColumn("id", scalars.tile_id(F.lit(stem), "tile_row", "tile_col"))
    capped = selection.cap_by_tokens(selection.with_rarest(kept, weights), selection.allocate_tokens(classes, max_tiles), max_tiles)
    one = tile * tile * (bands * 4 + 1)
    ordered = capped.withColumns({"bytes": F.lit(one).cast("bigint"), "place": F.concat(F.lpad(scalars.hash_number(seed, "id").cast("string"), 10, "0"), F.lit(":"), "id")})
    ordered = saved(ordered, "ordered")  # ranges are found by a pass of their own, which shall not burn and scale once more
    chosen = saved(selection.cap_by_bytes(ordered, budget, order="place").drop("before"), "chosen")
    summary = stats.run_summary(chosen, stats.class_tile_counts(chosen, classes), budget / scalars.GIB, one).select("total_tiles", "used_gb")
    return chosen.select("id", "tile_row", "tile_col", "valid_ratio", "coverage_ratio", "class_ids", "rarest", "shade").crossJoin(F.broadcast(summary))


def build_training_set(current: DataFrame, replay: DataFrame, weights: dict[int, float], batch: int = 2, seed: int = 42) -> DataFrame:
    """Sampled batches of training tiles, those of the current shard with replayed ones: k, id, origin, w, batch. Validation tiles are left out.

    As many draws, with replacement and by weight in millionths, as there are tiles; an incomplete last batch is dropped.
    """
    spark = current.sparkSession
    train = selection.train_val_split(current, "id", seed=seed).where("not is_val").drop("is_val")
    mixed = selection.replay_weights(selection.union_current_replay(train, replay, exclude_current=True), weights).select("id", "origin", "w")
    mixed = saved(mixed, "mixed")
    items = mixed.select("id", F.floor(F.col("w") * 1_000_000 + 0.5).alias("weight"))
    n = mixed.count()
    drawn = selection.weighted_sample_replace(items, spark.range(n // batch * batch).select(F.col("id").alias("k")), weight="weight", seed=seed)
    return drawn.join(mixed, "id").select("k", "id", "origin", "w", F.floor(F.col("k") / batch).alias("batch"))


def predict(pixels: DataFrame, windows: DataFrame, size: int, prompts: DataFrame, scorer, use_tta: bool = True) -> DataFrame:
    """Mask (row, col, class_id) of a raster: scaled bands, sliding windows, a column scorer, blending, the likeliest class, prompts on top.

    scorer takes the bands and the place in the window, both Columns, and gives a logit per class; their softmax is the class probabilities. With use_tta it sees each window in every
    variant, and what it says of a pixel at its places there is averaged. Logits and exponentials are bound to names per variant, so each is computed once.
    """
    scaled = stats.minmax_scale(pixels.withColumn("one", F.lit(1)), "one")
    bands = scaled.groupBy(F.col("gr").alias("row"), F.col("gc").alias("col")).agg(F.transform(F.sort_array(F.collect_list(F.struct("band", "v"))), lambda s: s.v).alias("bands"))
    covered = spatial.window_cover_join(bands, windows, size)
    r, c = F.col("row") - F.col("win_row"), F.col("col") - F.col("win_col")
    names = grid.DEFAULT_VARIANTS if use_tta else ("identity",)
    places = F.array(*[F.struct(a.alias("r"), b.alias("c")) for a, b in (grid.SYMMETRIES[grid.INVERSE.get(v, v)](r, c, size) for v in names)])
    logits = F.transform(places, lambda p: scorer(F.col("bands"), p["r"], p["c"]))
    # transform binds what it runs over, so arrays and their sums stand in structs, once per variant
    raised = F.transform(logits, lambda x: F.transform(x, F.exp))
    summed_up = F.transform(raised, lambda x: F.struct(x.alias("e"), F.aggregate(x, F.lit(0.0), lambda a, y: a + y).alias("s")))
    shares = F.transform(summed_up, lambda p: F.transform(p["e"], lambda y: y / p["s"]))
    none = F.array(*[F.lit(0.0)] * len(CLASSES))
    summed = F.aggregate(shares, none, lambda a, p: F.zip_with(a, p, lambda x, y: x + y))
    mask = scoring.blend_windows(covered.withColumn("probs", F.transform(summed, lambda x: x / len(names))), size).select("row", "col", metrics.argmax_class(F.col("probs")).alias("class_id"))
    return spatial.point_prompt_override(mask, prompts)


def predict_blocks(pixels: DataFrame, size: int, step: int, prompts: DataFrame, score: scoring.Scorer, block: int | None = None, use_tta: bool = True) -> DataFrame:
    """As predict, with a scorer of arrays (windows, bands, size, size) to logits (windows, classes, size, size): the form for models that look at more than a pixel. Windows are scored where their block lies, so
    pixels are shuffled once with the halos of their blocks, and sums of halos once."""
    height, width, bands = (int(x) for x in pixels.agg(F.max("gr") + 1, F.max("gc") + 1, F.count_distinct("band")).first())
    scaled = stats.minmax_scale(pixels.withColumn("one", F.lit(1)), "one")
    wide = scaled.groupBy(F.col("gr").alias("row"), F.col("gc").alias("col")).agg(F.transform(F.sort_array(F.collect_list(F.struct("band", "v"))), lambda s: s.v).alias("bands"))
    probs = scoring.blend_blocks(wide, height, width, size, step, score, bands, len(CLASSES), block, grid.DEFAULT_VARIANTS if use_tta else ("identity",))
    return spatial.point_prompt_override(probs.select("row", "col", metrics.argmax_class(F.col("probs")).alias("class_id")), prompts)


def sample_report(tiles: DataFrame, pixels: DataFrame, mask: DataFrame, show_class: int, n: int, seed: int = 42) -> DataFrame:
    """Up to n validation tiles (id, source, class_ids), by source, of those that show a class: a row per pixel with its rgb, its class's colour and the overlay of both, with the tile's labels and class shares.

    pixels: id, r, c, bands. mask: id, r, c, class_id. Only the pixels of the chosen tiles are coloured.
    """
    chosen = filters.filter_tiles_with_class(selection.group_split(tiles, seed=seed), show_class, seed=seed)
    sampled = selection.sample_n(chosen, "id", n, seed)
    label = F.map_from_entries(F.array(*[F.struct(F.lit(c[0]), F.lit(c[2])) for c in CLASSES]))
    sampled = sampled.select("id", "source", F.array_join(F.transform("class_ids", lambda c: F.coalesce(F.element_at(label, c), F.concat(F.lit("cls"), c))), "|").alias("labels"))
    own = mask.join(F.broadcast(sampled.select("id")), "id", "left_semi")
    shares = stats.class_distribution(own, "id").groupBy("id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("class_id", "share")))).alias("shares"))
    rgb = scoring.to_rgb8(F.col("bands"))
    shown = pixels.join(own, ["id", "r", "c"]).join(F.broadcast(sampled), "id").join(shares, "id")
    return shown.select("id", "source", "labels", "shares", "r", "c", rgb.alias("rgb"), scoring.colorize(F.col("class_id")).alias("colour"), scoring.overlay_blend(rgb, F.col("class_id")).alias("overlay"))


def shard_tiles(pixels: DataFrame) -> DataFrame:
    """Tiles (id, shard, coverage_ratio, class_ids, valid_ratio) of labelled pixels (id, shard, bands, target) that are valid and covered enough."""
    real = F.col("target") != IGNORE
    ratios = pixels.groupBy("id", "shard").agg(
        F.avg(F.exists("bands", lambda v: F.coalesce(v, F.lit(0.0)) != 0).cast("double")).alias("valid_ratio"), F.avg((real & (F.col("target") > 0)).cast("double")).alias("coverage_ratio"), F.sort_array(F.collect_set(F.when(real, F.col("target")))).alias("class_ids"),
    )
    return filters.filter_tiles_quality(ratios)


RUN = "batch bigint, shard string, status string, budget bigint, admitted bigint, train_rows bigint, train_batches bigint, val_miou double, replay_ok boolean, budget_ok boolean, total_ok boolean"
Fit = Callable[[DataFrame], Callable[[DataFrame], DataFrame]]


def mean_fit(bands: int) -> Fit:
    """Fits class means and predicts the nearest one."""

    def fit(train: DataFrame) -> Callable[[DataFrame], DataFrame]:
        means = metrics.class_means(train, bands)
        return lambda pixels: pixels.withColumn("pred", metrics.nearest_mean(F.col("bands"), means))

    return fit


def incremental_run(spark: SparkSession, source: str, schema, checkpoint: str, folder: str, weights: dict[int, float], classes: DataFrame, n_replay: int, ceiling: int, bytes_per_tile: int, total: int, fit: Fit) -> DataFrame:
    """All shards of labelled pixels (id, shard, r, c, bands, target) from their landing to their alert, one after the other; a row per shard.

    A shard's tiles are checked, capped by what the replay store leaves of the ceiling, split, mixed with replayed tiles and drawn by weight; fit learns from the pixels of the draws (n: how often each was
    drawn) and is measured by mean IoU on the validation tiles. Then the shard's slice joins the store, pixels and all, and an alert tells of the shard. A shard without a usable tile is skipped and told
    as an error; an error in fitting stops the run. All that a batch reads is as of the batch before it and all that it writes bears its number, so a batch that is repeated writes the same again.
    """
    log, store = f"{folder}/runs", f"{folder}/replay"

    def each(pixels: DataFrame, number: int) -> None:
        shard = pixels.agg(F.min("shard")).first()[0]
        held = sinks.slices(spark, f"{store}/tiles", before=number).agg(F.coalesce(F.sum("tiles"), F.lit(0)).alias("n")).first().n * bytes_per_tile
        budget = max(ceiling - held, scalars.GIB)
        kept = saved(shard_tiles(pixels).drop("valid_ratio"), "kept")
        if kept.isEmpty():
            done = spark.createDataFrame([(number, shard, "skipped: no tiles", budget, 0, 0, 0, None, held < ceiling, budget >= 1, held <= ceiling * 1.02)], RUN)
        else:
            admitted = saved(selection.cap_by_bytes(kept.withColumn("bytes", F.lit(bytes_per_tile).cast("bigint")), budget).drop("bytes", "before"), "admitted")
            replay = sinks.read_slices(spark, f"{store}/tiles", admitted.schema, before=number)
            drawn = saved(build_training_set(admitted, replay, weights), "drawn")
            often = drawn.groupBy("id").agg(F.count("*").alias("n"))
            every = pixels.unionByName(sinks.read_slices(spark, f"{store}/pixels", pixels.schema, before=number))
            model = fit(every.join(often, "id"))
            held_out = selection.train_val_split(admitted, "id").where("is_val").select("id")
            scored = model(pixels.join(held_out, "id", "left_semi"))
            miou = metrics.iou(metrics.confusion_matrix(scored)).agg(F.max("miou")).first()[0]
            chosen = selection.replay_select(admitted, classes, weights, n_replay).select(*admitted.columns)
            sinks.write_slice(pixels.join(chosen.select("id"), "id", "left_semi").select(*pixels.columns), f"{store}/pixels", number)
            sinks.write_slice(chosen, f"{store}/tiles", number)
            n, rows = admitted.count(), drawn.count()
            done = spark.createDataFrame([(number, shard, "done", budget, n, rows, rows // 2, float(miou), held < ceiling, budget >= 1, held + n * bytes_per_tile <= ceiling * 1.02)], RUN)
        state = done.select("batch", F.col("shard").alias("run_id"), F.col("batch").alias("epoch"), F.lit(0).alias("best_e4"), F.lit(True).alias("failed"), "status", F.floor(F.coalesce("val_miou", F.lit(0.0)) * 10000 + 0.5).cast("int").alias("e4"))
        good = state.where("status = 'done'").select("run_id", (F.col("batch") + 1).alias("step"), F.lit(total).alias("total"), F.col("e4").alias("best_e4"), F.lit(1).alias("best_epoch"), F.lit(1).alias("epochs"))
        alert = complete_rows(good).unionByName(alert_rows(state.where("status <> 'done'")))  # one row
        done.crossJoin(alert.drop("run_id")).write.mode("overwrite").parquet(f"{log}/batch={number}")

    shards.drain(spark, source, schema, checkpoint, each)
    schema = f"{RUN}, kind string, severity string, subject string, next_step string"
    return spark.read.schema(schema).parquet(log).select(*[c.split()[0] for c in schema.split(", ")])
