"""Spatial joins: overlap of boxes, burning of polygons, overlay by priority, prompts and sliding windows.

Predicates on ranges become equi joins on grid cells or pixel rows with a residual filter, so none of the plans has a nested loop.
Edges are (fid, class_id, x0, y0, x1, y1); pixels (row, col) have their centre at + 0.5. Columns beyond those are kept where a
group key allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overlaps(a: str, b: str) -> Column:
    """Strict overlap of boxes whose columns have the prefixes a and b."""
    c = lambda p, n: F.col(f"{p}{n}")
    return (c(a, "minx") < c(b, "maxx")) & (c(a, "maxx") > c(b, "minx")) & (c(a, "miny") < c(b, "maxy")) & (c(a, "maxy") > c(b, "miny"))


def edge_boxes(edges: DataFrame, *keys: str) -> DataFrame:
    """Bounds of the edges of each key."""
    lo, hi = lambda a, b: F.min(F.least(a, b)), lambda a, b: F.max(F.greatest(a, b))
    return edges.groupBy(*keys).agg(lo("x0", "x1").alias("minx"), lo("y0", "y1").alias("miny"), hi("x0", "x1").alias("maxx"), hi("y0", "y1").alias("maxy"))


#: Boxes that a join may send to every task.
MOST_BROADCAST = 10_000


def bbox_overlap_join(rasters: DataFrame, layers: DataFrame, cell: float = 32.0) -> DataFrame:
    """raster_id, layers: the names of overlapping layers in order, or none. Up to MOST_BROADCAST layers, counted first, are broadcast; more meet the rasters by grid cells of several levels, from `cell` upward."""
    box = ("minx", "miny", "maxx", "maxy")
    if layers.limit(MOST_BROADCAST + 1).count() > MOST_BROADCAST:
        pairs = grid_bbox_join(rasters, layers, "raster_id", "layer", cell)
        joined = rasters.select("raster_id").join(pairs, "raster_id", "left")
    else:
        small = layers.select(F.col("layer"), *[F.col(c).alias(f"l_{c}") for c in box])
        joined = rasters.select("raster_id", *[F.col(c).alias(f"r_{c}") for c in box]).join(F.broadcast(small), overlaps("r_", "l_"), "left")
    names = F.array_join(F.sort_array(F.collect_list("layer")), ",")
    return joined.groupBy("raster_id").agg(F.when(names == "", "none").otherwise(names).alias("layers"))


def level_of(prefix: str, size: float) -> Column:
    """The least level whose cells, of size * 2^level, are as large as the box: it touches two of them along an axis at most."""
    extent = F.greatest(F.col(f"{prefix}maxx") - F.col(f"{prefix}minx"), F.col(f"{prefix}maxy") - F.col(f"{prefix}miny"))
    level = F.greatest(F.ceil(F.log2(F.greatest(extent, F.lit(size)) / size)), F.lit(0))
    return (level + F.when(F.pow(F.lit(2.0), level) * size < extent, 1).otherwise(0)).cast("int")


def cells(df: DataFrame, prefix: str, size: float, levels: list[int]) -> DataFrame:
    """df with level and with a row for each cell (at, cell_x, cell_y) that its box touches, on its own level and on those of levels that are coarser: four cells a level at most, whatever its extent."""
    leveled = df.withColumn("level", level_of(prefix, size))
    at = F.explode(F.array_distinct(F.concat(F.array("level"), F.filter(F.array(*map(F.lit, levels)), lambda x: x > F.col("level")))))
    span = lambda lo, hi: F.sequence(F.floor(F.col(prefix + lo) / F.col("_w")), F.floor(F.col(prefix + hi) / F.col("_w")))
    rows = leveled.withColumn("at", at).withColumn("_w", F.pow(F.lit(2.0), F.col("at")) * size)
    return rows.withColumn("cell_x", F.explode(span("minx", "maxx"))).withColumn("cell_y", F.explode(span("miny", "maxy"))).drop("_w")


def grid_bbox_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, size: float) -> DataFrame:
    """Pairs of ids of strictly overlapping boxes: an equi join on cells, then the exact predicate.

    A box is covered by cells of the level that fits its extent. Two boxes meet on the coarser one's level, where the finer one's box has its cells too, in the one cell
    that holds the least corner of their overlap; so each pair of rows is found once, and no box is cut into cells by its area. Ids are told once each, however often they stand there.
    """
    box = ("minx", "miny", "maxx", "maxy")
    sides = [df.select(F.col(i), *[F.col(c).cast("double").alias(f"{p}{c}") for c in box]) for df, i, p in ((left, left_id, "l_"), (right, right_id, "r_"))]
    levels = [[r.level for r in df.select(level_of(p, size).alias("level")).where("level is not null").distinct().collect()] for df, p in zip(sides, ("l_", "r_"), strict=True)]  # tens of rows
    a = cells(sides[0], "l_", size, levels[1]).withColumnRenamed("level", "l_level")
    b = cells(sides[1], "r_", size, levels[0]).withColumnRenamed("level", "r_level")
    width = F.pow(F.lit(2.0), F.col("at")) * size
    first = (F.col("cell_x") == F.floor(F.greatest("l_minx", "r_minx") / width)) & (F.col("cell_y") == F.floor(F.greatest("l_miny", "r_miny") / width))
    met = a.join(b, ["at", "cell_x", "cell_y"]).where((F.col("at") == F.greatest("l_level", "r_level")) & first & overlaps("l_", "r_"))
    return met.select(left_id, right_id).distinct()


def spans(edges: DataFrame, *keys: str, rows: tuple[int, int] | None = None) -> DataFrame:
    """keys, row, first, last: the runs of pixels whose centres lie inside, by the even-odd rule over all rings; within the rows (both ends included), if given.

    Each edge gives its crossing with the centre line of every row between its ends, of those rows only, so an edge costs what is left of it after clipping; crossings of a key and row, in order, pair up.
    """
    lo, hi = F.ceil(F.least("y0", "y1").cast("double") - 0.5), F.ceil(F.greatest("y0", "y1").cast("double") - 0.5) - 1
    if rows is not None:
        lo, hi = F.greatest(lo, F.lit(rows[0])), F.least(hi, F.lit(rows[1]))
    sloped = edges.where(F.col("y0") != F.col("y1")).withColumn("lo", lo).withColumn("hi", hi).where("lo <= hi")
    crossing = sloped.withColumn("row", F.explode(F.sequence("lo", "hi")))
    x = F.col("x0") + (F.col("row") + 0.5 - F.col("y0")) * (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))
    crossed = crossing.select(*keys, "row", x.alias("x")).groupBy(*keys, "row").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.floor(F.size("xs") / 2).cast("int") - 1), lambda i: F.struct(F.ceil(F.get("xs", i * 2) - 0.5).alias("first"), (F.ceil(F.get("xs", i * 2 + 1) - 0.5) - 1).alias("last"))))
    return crossed.where(F.size("xs") >= 2).select(*keys, "row", pair.alias("s")).select(*keys, "row", "s.first", "s.last").where("first <= last")


def rasterize_polygons(edges: DataFrame, *keys: str, height: int, width: int) -> DataFrame:
    """keys, row, col of the pixels inside, clipped to the raster. Runs of a key and row don't overlap, so each pixel comes once."""
    clipped = spans(edges, *keys, rows=(0, height - 1)).withColumns({"first": F.greatest("first", F.lit(0)), "last": F.least("last", F.lit(width - 1))}).where("first <= last")
    return clipped.select(*keys, "row", F.explode(F.sequence("first", "last")).alias("col"))


def rasterize_all_touched(edges: DataFrame, *keys: str, height: int, width: int) -> DataFrame:
    """Also the pixels that an edge passes through; pixels are half open, vertices whole numbers. Edges are clipped to the raster before they become pixels."""
    top, bottom = F.least("y0", "y1"), F.greatest("y0", "y1")
    from_, to = F.greatest(top, F.lit(0)), F.least(F.greatest(top, bottom - 1), F.lit(height - 1))
    rows = edges.where(from_ <= to).withColumn("row", F.explode(F.sequence(from_, to)))
    at = lambda y: F.col("x0") + (y - F.col("y0")) * (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))
    flat = F.col("y0") == F.col("y1")
    xa = F.when(flat, F.col("x0").cast("double")).otherwise(at(F.greatest("row", top)))
    xb = F.when(flat, F.col("x1").cast("double")).otherwise(at(F.least(F.col("row") + 1, bottom)))
    rows = rows.withColumns({"xa": xa, "xb": xb})
    lo = F.floor(F.least("xa", "xb"))
    rows = rows.withColumns({"first": F.greatest(lo, F.lit(0)), "last": F.least(F.greatest(lo, F.ceil(F.greatest("xa", "xb")) - 1), F.lit(width - 1))}).where("first <= last")
    touched = rows.select(*keys, F.col("row").cast("bigint").alias("row"), F.explode(F.sequence("first", "last")).alias("col"))
    return touched.union(rasterize_polygons(edges, *keys, height=height, width=width)).distinct()


def overlay_by_priority(burned: DataFrame, classes: DataFrame) -> DataFrame:
    """row, col, class_id: where classes overlap, the one that is painted last."""
    ranked = burned.join(F.broadcast(classes.select("class_id", "priority")), "class_id")
    return ranked.groupBy("row", "col").agg(F.max_by("class_id", "priority").alias("class_id"))


def onto_grid(grid: DataFrame, mask: DataFrame) -> DataFrame:
    """Every pixel of grid (row, col) with its class, 0 where there is none."""
    return grid.join(mask, ["row", "col"], "left").withColumn("class_id", F.coalesce("class_id", F.lit(0)))


def coverage_union(burned: DataFrame) -> DataFrame:
    return burned.select("row", "col").distinct()


def point_prompt_override(mask: DataFrame, prompts: DataFrame, size: int = 10) -> DataFrame:
    """mask (row, col, class_id) with the class of the last prompt (seq, x, y, class_id) whose half-open box of size pixels holds the pixel."""
    span = lambda c: F.sequence((F.floor(c) - size // 2).cast("bigint"), (F.floor(c) + size - size // 2 - 1).cast("bigint"))
    boxes = prompts.select("seq", F.col("class_id").alias("prompt_class"), F.explode(span("y")).alias("row"), "x").select("seq", "prompt_class", "row", F.explode(span("x")).alias("col"))
    last = boxes.groupBy("row", "col").agg(F.max_by("prompt_class", "seq").alias("prompt_class"))
    return mask.join(last, ["row", "col"], "left").select(*[c for c in mask.columns if c != "class_id"], F.coalesce("prompt_class", "class_id").alias("class_id"))


def window_cover_join(pixels: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """pixels (row, col) with each window (win_row, win_col) that covers them: windows are found by the cells of their size that they touch."""
    cell = lambda c: F.floor(F.col(c) / size)
    both = lambda c: F.explode(F.array_distinct(F.array(cell(c), F.floor((F.col(c) + size - 1) / size))))
    dealt = windows.withColumn("cell_row", both("win_row")).withColumn("cell_col", both("win_col"))
    joined = pixels.withColumns({"cell_row": cell("row"), "cell_col": cell("col")}).join(dealt, ["cell_row", "cell_col"])
    inside = F.col("row").between(F.col("win_row"), F.col("win_row") + size - 1) & F.col("col").between(F.col("win_col"), F.col("win_col") + size - 1)
    return joined.where(inside).drop("cell_row", "cell_col")
