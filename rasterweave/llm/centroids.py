"""Clustering around centroids by bit planes and popcounts.

A vector of 64 whole components becomes one 64-bit word per bit of their two's complement: bit i of plane b is bit b of component i. The
inner product of two vectors is then the sum, over pairs of planes, of popcount(plane & plane) times the planes' weights, which is exact, and so are
squared distances; sums per centroid come from the bits of the planes as well. Planes are made once; every round reads them alone, and only counts
and sums per centroid and component leave a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.llm.common import removed, saved, table
from rasterweave.llm.vectors import binaries, matrix, whole_vectors

K, ROUNDS, DIM, SCALE = 8, 10, 64, 1024
STEP = 4096


def weights(n: int) -> np.ndarray:
    """What each of n planes counts; the last one is the sign."""
    out = np.int64(1) << np.arange(n, dtype=np.int64)
    out[-1] = -out[-1]
    return out


def pack(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Planes (n, p) of whole vectors (n, 64), and how many of them each vector needs, its sign plane included."""
    need = np.frexp(np.where(x < 0, ~x, x).max(1, initial=0).astype(np.float64))[1] + 1
    p = int(need.max(initial=1))
    bits = ((x[:, None, :] >> np.arange(p, dtype=np.int32)[None, :, None]) & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little").view("<u8")[..., 0], need.astype(np.int64)


def unpack(planes: np.ndarray) -> np.ndarray:
    """The whole vectors (n, 64) of planes (n, p)."""
    bits = np.unpackbits(np.ascontiguousarray(planes, dtype="<u8").view(np.uint8).reshape(*planes.shape, 8), axis=2, bitorder="little")
    return np.einsum("npi,p->ni", bits.astype(np.int64), weights(planes.shape[1]))


def read_planes(column: pa.Array) -> np.ndarray:
    """Planes (p, n) of a binary column; a vector with fewer planes than others gets its sign plane again, which changes no value."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) // 8
    flat, count = np.frombuffer(column.buffers()[2], "<u8"), np.diff(offsets)
    return flat[offsets[:-1][None, :] + np.minimum(np.arange(count.max())[:, None], count[None, :] - 1)]


def plane_products(planes: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Inner products of the vectors of planes (p, n) with a centroid's planes (q,)."""
    mine, out = weights(len(planes)), np.zeros(planes.shape[1], dtype=np.int64)
    for weight, word in zip(weights(len(centroid)), centroid, strict=True):
        if word:
            out += weight * (mine @ np.bitwise_count(planes & word).astype(np.int64))
    return out


def nearest(planes: np.ndarray, sq: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, the smaller one of ties, and the squared distance."""
    words, need = pack(centroids.astype(np.int32))
    own = (centroids.astype(np.int64) ** 2).sum(1)
    distance = np.stack([sq - 2 * plane_products(planes, words[k, : need[k]]) + own[k] for k in range(len(centroids))])
    cluster = distance.argmin(0)
    return cluster, distance[cluster, np.arange(len(cluster))]


def sums(planes: np.ndarray, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """How many vectors each centroid has, and the sums (k, 64) of their components: counts of ones per plane and place."""
    total, mine = np.zeros((k, DIM), dtype=np.int64), weights(len(planes))
    for c in range(k):
        at = np.flatnonzero(cluster == c)
        for b in range(len(planes)) if len(at) else ():
            total[c] += mine[b] * np.unpackbits(planes[b][at].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.bincount(cluster, minlength=k), total


def packed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """id, planes (binary), sq: the vectors of exactly 64 finite components, none null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, STEP):
                batch = whole.slice(begin, STEP)
                words, need = pack(matrix(batch.column(1), DIM))
                held = np.arange(words.shape[1])[None, :] < need[:, None]
                yield pa.RecordBatch.from_arrays([batch.column(0), binaries(words[held], need * 8), batch.column(2)], names=["id", "planes", "sq"])

    rows = whole_vectors(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")), scale, ["id"], "vector", DIM)
    return rows.mapInArrow(run, rows.select("id", F.col("v").alias("planes"), "sq").schema)


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of `seed:<id>`, in that order; those of one id by their planes. A null id is the text null."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256)
    found = rows.select(order.alias("order"), "planes").orderBy("order", "planes").limit(k).collect()  # k rows
    return np.array([unpack(np.frombuffer(r.planes, "<u8")[None, :])[0] for r in found], dtype=np.int64).reshape(-1, DIM)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: each the floors of its vectors' means; one without vectors stays."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, DIM), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                planes = read_planes(batch.column(0))
                n, s = sums(planes, nearest(planes, np.asarray(batch.column(1)), centroids)[0], k)
                count += n
                total += s
        cluster, place = np.divmod(np.arange(k * DIM), DIM)
        yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(place, pa.int32()), pa.array(count[cluster]), pa.array(total.ravel())], names=["cluster", "place", "n", "s"])

    parts = rows.select("planes", "sq").mapInArrow(run, "cluster int, place int, n bigint, s bigint")
    out = centroids.copy()
    for r in parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s")).collect():  # k * 64 rows
        if r.n:
            out[r.cluster, r.place] = int(r.s) // r.n
    return out


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """id, cluster, distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, distance = nearest(read_planes(batch.column(1)), np.asarray(batch.column(2)), centroids)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"])

    return rows.mapInArrow(run, rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")).schema)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS, scale: int = SCALE, seed: int = 3) -> tuple[DataFrame, np.ndarray]:
    """id, cluster, distance of every kept vector after so many rounds from the first centroids, and the final centroids (k, 64).

    Kept are vectors of exactly 64 components, none null or non-finite; components beyond 2**26 count as that. Fewer vectors than k make as many
    centroids as there are vectors, and no vectors none and no rows. Repeated rows and equal vectors count as often as they stand there. A null id keeps its row.
    """
    rows = saved(packed(vectors, id_col, vector_col, scale), "planes")
    at = first_centroids(rows, k, seed)
    for _ in range(rounds if len(at) else 0):
        now = moved(rows, at)
        if (now == at).all():  # nothing moves any more, so later rounds would change nothing
            break
        at = now
    out = saved(assigned(rows, at), "assigned")
    removed(rows)
    return out, at


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of distances beyond a long count as its largest number."""
    rows, at = cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in at]
    inertia = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("inertia"))
    found = {r.cluster: int(r.inertia) for r in inertia.collect()}  # a row per centroid
    long = lambda n: min(n, (1 << 63) - 1)
    facts = spark.createDataFrame([(c, long(found.get(c, 0)), long(sum(found.values())), name) for c, name in enumerate(names)], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
