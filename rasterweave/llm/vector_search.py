"""Exact top-k search by inner product as a Voronoi join.

The largest inner products are the least distances once every vector gets one more component, sqrt(M^2 - |x|^2) with M the largest norm, and every query a
zero. Pivots cut data and queries into cells. Summaries of the cells (counts, radii, and the few least distances to the pivot) bound the k-th least distance of every
query of a cell, and with the triangle inequality they tell which shell of which data cell it can come from. Data rows are replicated to the groups of query
cells that need their shell and to no others; each piece of a group's data is solved with the group's queries, and the pieces' results are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterweave.llm.common import removed, saved, table
from rasterweave.llm.vectors import matrix, products, whole_vectors

SCALE, K, EVERY = 1024, 10, 100
#: At most so many pivots; queries of a group and data rows of a piece that one task holds, for 64 components (fewer for longer vectors).
PIVOTS, QUERIES, PIECE = 256, 8192, 2048
STEP = 256
#: What rounding can add to a distance, relative to its terms.
SLACK = 1e-9


def lifted(x: np.ndarray, sq: np.ndarray, top: int) -> np.ndarray:
    """Vectors with their last component, sqrt(top - |x|^2)."""
    return np.concatenate((x.astype(np.float64), np.sqrt(np.maximum(top - sq.astype(np.float64), 0.0))[:, None]), axis=1)


def gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of the rows of a from those of b."""
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :], 0.0))


def in_cells(rows: DataFrame, pivots: np.ndarray, width: int, top: int, every: int) -> DataFrame:
    """rows with row (a number of their own), cell and gap (nearest pivot, distance), and query_cell and query_gap where the id is divisible by every."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 4096):
                batch = whole.slice(begin, 4096)
                x, sq = matrix(batch.column(1), width), np.asarray(batch.column(2))
                far = gaps(lifted(x, sq, top), pivots)
                cell = far.argmin(1)
                asked = gaps(np.concatenate((x, np.zeros((len(x), 1))), axis=1), pivots)
                query_cell, is_query = asked.argmin(1), np.asarray(batch.column(3))
                here = np.arange(len(x))
                made = [pa.array(cell, pa.int32()), pa.array(far[here, cell]), pa.array(query_cell, pa.int32(), mask=~is_query), pa.array(asked[here, query_cell], mask=~is_query)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], names=["id", "v", "sq", "cell", "gap", "query_cell", "query_gap"])

    asked = F.coalesce(F.col("id") % every == 0, F.lit(False)).alias("asked")
    schema = rows.select("id", "v", "sq", F.lit(0).alias("cell"), F.lit(0.0).alias("gap"), F.lit(None).cast("int").alias("query_cell"), F.lit(None).cast("double").alias("query_gap")).schema
    return rows.select("id", "v", "sq", asked).mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


def shells(pivots: np.ndarray, queries: dict[int, tuple[int, float]], nearest: list[tuple[int, float]], k: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each query cell the least and largest distance to each pivot of data rows that may be among a query's k nearest.

    queries: count and radius per query cell. nearest: cell and distance of the k + 1 rows nearest to each pivot, one more than k because a query's own row may be one. Where
    there are fewer rows than that everything may be needed.
    """
    apart, out = gaps(pivots, pivots), {}
    size = np.sqrt((pivots * pivots).sum(1))
    # rounding of a distance comes from the terms of its square
    slack = lambda i, radius: np.sqrt(SLACK) * (size[i] + size + radius)
    cell, gap = np.array([c for c, _ in nearest], dtype=np.int64), np.array([g for _, g in nearest])
    for i, (_, radius) in queries.items():
        reach = np.sort(radius + apart[i][cell] + gap)
        most = float(reach[k]) if len(reach) > k else np.inf
        out[i] = (apart[i] - radius - most - slack(i, radius), apart[i] + radius + most + slack(i, radius))
    return out


def packs(pivots: np.ndarray, queries: dict[int, tuple[int, float]], most: int) -> list[tuple[list[int], int]]:
    """Query cells that are worked on together, neighbours with neighbours, up to so many queries; and into how many parts a cell with more is cut."""
    left, out, held = dict(queries), [], 0
    apart = gaps(pivots, pivots)
    at = min(left, default=None)
    while left:
        count = left.pop(at)[0]
        if count > most:
            out.append(([at], -(-count // most)))
            held = most
        elif out and held + count <= most:
            out[-1][0].append(at)
            held += count
        else:
            out.append(([at], 1))
            held = count
        at = min(left, key=lambda c: (apart[at][c], c)) if left else None
    return out


def solved(width: int, k: int, bounds: dict[int, tuple[np.ndarray, np.ndarray]]):
    """Of a group's queries and a piece of its data, the k best rows of each query."""

    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        q, d = queries.combine_chunks(), data.combine_chunks()
        found = []
        if q.num_rows and d.num_rows:
            column = lambda t, name: t.column(name).chunk(0)
            order = np.argsort(np.asarray(column(q, "query_cell")), kind="stable")
            q_x, q_cell, q_row, q_id = matrix(column(q, "v"), width)[order], np.asarray(column(q, "query_cell"))[order], np.asarray(column(q, "row"))[order], np.asarray(column(q, "id"))[order]
            d_x, cell, gap, row = matrix(column(d, "v"), width), np.asarray(column(d, "cell")), np.asarray(column(d, "gap")), np.asarray(column(d, "row"))
            ids = column(d, "id")
            unnamed, named = np.asarray(ids.is_null()), np.asarray(ids.fill_null(0))
            for begin in range(0, len(q_x), STEP):
                at = slice(begin, begin + STEP)
                cells = [bounds[c] for c in np.unique(q_cell[at])]
                lo, hi = np.min([b[0] for b in cells], axis=0), np.max([b[1] for b in cells], axis=0)
                near = np.flatnonzero((gap >= lo[cell]) & (gap <= hi[cell]))
                if not len(near):
                    continue
                score = products(q_x[at], d_x[near])
                own = q_row[at][:, None] == row[near][None, :]
                lowest = np.where(own, -np.inf if score.dtype == np.float64 else np.iinfo(np.int64).min, score)
                n = len(near)
                least = np.partition(lowest, n - k, axis=1)[:, n - k] if n > k else np.full(len(score), -np.inf)
                i, j = np.nonzero((lowest >= least[:, None]) & ~own)
                best = np.lexsort((row[near][j], named[near][j], unnamed[near][j], -lowest[i, j], i))
                i, j = i[best], j[best]
                first = np.searchsorted(i, i)
                kept = np.arange(len(i)) - first < k
                i, j = i[kept], j[kept]
                found.append((q_row[at][i], q_id[at][i], near[j], score[i, j].astype(np.int64)))
        rows = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, dtype=np.int64)] * 4
        there = pa.array(rows[2], pa.int64())
        return pa.table({"query_row": pa.array(rows[0], pa.int64()), "query_id": pa.array(rows[1]).cast(q.schema.field("id").type), "row": d.column("row").take(there), "id": d.column("id").take(there), "score": pa.array(rows[3], pa.int64())})

    return run


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY, scale: int = SCALE, pivots: int = PIVOTS, queries: int = QUERIES, piece: int = PIECE) -> DataFrame:
    """query_id, rank, id, score: the k largest inner products of floor(scale * x) for every query, a row whose id is divisible by every, with all other rows; ties to the smaller id, null ids last.

    Vectors that are null or hold null or non-finite components take no part; shorter vectors count as the longest one with zeros behind, components beyond
    2**26 as that (vectors of up to 2,047 components then have sums within a long). A row is another one by its place, not by its id, so repeated rows are queries and candidates each. Fewer
    candidates than k make fewer rows, no queries none.
    """
    spark = vectors.sparkSession
    base = saved(whole_vectors(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")), scale, ["id"], "vector"), "vectors")
    n, longest, top = base.agg(F.count("*"), F.max(F.octet_length("v")), F.max("sq")).first()
    width = max(1, (longest or 0) // 4)
    queries, piece = (max(1, m * 64 // max(width, 64)) for m in (queries, piece))
    # the sample is bounded: pivots only decide where work is saved, never what is found
    sample = base.select("v", "sq").orderBy(F.xxhash64("id", "v"), "v").limit(min(pivots, max(1, int(n**0.5)))).distinct().collect()
    at = np.zeros((len(sample), width), dtype=np.int32)
    for i, r in enumerate(sorted(sample)):
        at[i, : len(r.v) // 4] = np.frombuffer(r.v, np.int32)
    points = lifted(at, (at.astype(np.int64) ** 2).sum(1), top or 0)
    result = "query_row bigint, query_id {0}, row bigint, id {0}, score bigint".format(dict(base.dtypes)["id"])
    if not n:
        return spark.createDataFrame([], result).select("query_id", F.lit(1).alias("rank"), "id", "score")
    rows = saved(in_cells(base, points, width, top, every), "cells")
    removed(base)
    asked = {r.query_cell: (r.n, r.radius) for r in rows.where("query_cell is not null").groupBy("query_cell").agg(F.count("*").alias("n"), F.max("query_gap").alias("radius")).collect()}  # a row per pivot
    held = {r.cell: (r.n, r.least, r.most) for r in rows.groupBy("cell").agg(F.count("*").alias("n"), F.min("gap").alias("least"), F.max("gap").alias("most")).collect()}
    ranked = rows.select("cell", "gap", F.row_number().over(Window.partitionBy("cell").orderBy("gap")).alias("rn")).where(F.col("rn") <= k + 1)
    bounds = shells(points, asked, [(r.cell, r.gap) for r in ranked.collect()], k)  # k + 1 rows per pivot
    dealt, wanted = [], []
    for number, (cells, parts) in enumerate(packs(points, asked, queries)):
        lo, hi = np.min([bounds[c][0] for c in cells], axis=0), np.max([bounds[c][1] for c in cells], axis=0)
        needed = [c for c, (_, least, most) in held.items() if lo[c] <= most and hi[c] >= least]
        pieces = max(1, -(-sum(held[c][0] for c in needed) // piece))
        dealt += [(c, number, parts, pieces) for c in cells]
        wanted += [(c, float(lo[c]), float(hi[c]), number, parts, pieces) for c in needed]
    # at most a row per pivot, and per pair of pivots
    to = F.broadcast(spark.createDataFrame(dealt, "query_cell int, pack int, parts int, pieces int"))
    needs = F.broadcast(spark.createDataFrame(wanted, "cell int, lo double, hi double, pack int, parts int, pieces int"))
    part = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int").alias("part")
    asking = spark.read.schema(rows.schema).parquet(rows._saved_at)  # the same table under other names
    sought = asking.join(to, "query_cell").select("id", "v", "row", "query_cell", "pack", part, F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    spread = rows.join(needs, "cell").where(F.col("gap").between(F.col("lo"), F.col("hi")))
    spread = spread.select("id", "v", "row", "cell", "gap", "pack", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("row", F.lit("piece")), F.col("pieces")).cast("int").alias("piece"))
    place = ["pack", "part", "piece"]
    local = sought.groupBy(*place).cogroup(spread.groupBy(*place)).applyInArrow(solved(width, k, bounds), result)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row"))
    return local.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
