"""Codes of vectors by product codebooks, fitted with norm-of-sum bounds.

A vector is cut into parts, and each part has a codebook of its own. After the first round every part of every vector keeps, per group of its codebook's
entries, a lower bound of the distance to the nearest of them that it is not assigned to, and the round in which the bound was true. The
codebooks of all rounds are kept. A bound of round T still holds in round t less the largest net displacement of the group's entries, |C_t - C_T|, which is
at most (and mostly well below) the sum of the drifts of the rounds between. Only groups whose bound doesn't exceed the exact distance to the
assigned entry are measured again, so the codes are those of a full search, ties included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.llm.common import removed, saved, table
from rasterweave.llm.vectors import binaries, matrix, square_distances, whole_vectors

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
GROUPS = 4


def rounded_down(x: np.ndarray) -> np.ndarray:
    """Lower bounds as 32-bit floats that don't exceed them."""
    out = x.astype(np.float32)
    return np.where(out > x, np.nextafter(out, np.float32(-np.inf)), out)


class Books:
    """The codebooks of all rounds so far: history[t] is (parts, entries, width)."""

    def __init__(self, history: list[np.ndarray]):
        self.history = history
        self.now = history[-1]
        entries = self.now.shape[1]
        self.groups = [slice(int(g[0]), int(g[-1]) + 1) for g in np.array_split(np.arange(entries), GROUPS) if len(g)]
        # net displacement since each round, the largest of a group; (rounds, parts, groups)
        net = [np.sqrt(((self.now - old).astype(np.float64) ** 2).sum(2)) for old in history]
        self.net = np.array([[[d[p, g].max() for g in self.groups] for p in range(len(d))] for d in net]) * (1 + 1e-9) + 1e-6

    def searched(self, part: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes, squared distances and lower bounds per group from all distances."""
        d = square_distances(x, self.now[part])
        code = d.argmin(1)
        rows = np.arange(len(x))
        best = d[rows, code]
        other = d.astype(np.float64)
        other[rows, code] = np.inf
        return code, best, rounded_down(np.sqrt(np.stack([other[:, g].min(1, initial=np.inf) for g in self.groups], 1)))

    def renewed(self, part: int, x: np.ndarray, code: np.ndarray, lower: np.ndarray, stamp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """Codes, squared distances, bounds and their stamps from those of earlier rounds; and how many distances were measured."""
        t, rows = len(self.history) - 1, np.arange(len(x))
        own = x.astype(np.int64) - self.now[part][code]
        best, last = (own * own).sum(1), code
        root = np.sqrt(best.astype(np.float64))
        net = lower - self.net[stamp, part, np.arange(len(self.groups))[None, :]]
        open_ = net <= root[:, None] * (1 + 1e-9) + 1e-6
        code, best, found, measured = code.copy(), best.copy(), [], len(x)
        for g, at in enumerate(self.groups):
            again = np.flatnonzero(open_[:, g])
            d = square_distances(x[again], self.now[part][at])
            measured += d.size
            first, of = d.argmin(1), np.arange(len(again))
            least, entry = d[of, first], first + at.start
            rest = d.astype(np.float64)
            rest[of, first] = np.inf
            found.append((again, least, entry, rest.min(1, initial=np.inf)))
            nearer = (least < best[again]) | ((least == best[again]) & (entry < code[again]))
            best[again[nearer]], code[again[nearer]] = least[nearer], entry[nearer]
        lower, stamp = lower.copy(), stamp.copy()
        group_of = np.repeat(np.arange(len(self.groups)), [g.stop - g.start for g in self.groups])
        left = np.flatnonzero(code != last)  # the entry that a part has left belongs to its group's bound again
        lower[left, group_of[last[left]]] = rounded_down(np.minimum(net[left, group_of[last[left]]], root[left] * (1 - 1e-9)))
        stamp[left, group_of[last[left]]] = t
        for g, (again, least, entry, second) in enumerate(found):
            lower[again, g] = rounded_down(np.sqrt(np.where(entry == code[again], second, least)))
            stamp[again, g] = t
        return code[rows], best, lower, stamp, measured


def first_books(rows: DataFrame, width: int, parts: int, entries: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids, ascending; a null id counts as the largest, and vectors of one id come by their bytes."""
    found = rows.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    flat = np.zeros((len(found), width), dtype=np.int64)
    for i, r in enumerate(found):
        flat[i, : len(r.v) // 4] = np.frombuffer(r.v, np.int32)
    return flat.reshape(len(found), parts, width // parts).transpose(1, 0, 2)


def coded(rows: DataFrame, history: list[np.ndarray], width: int) -> DataFrame:
    """rows (id, label, v, and from the second round on codes, bounds and stamps) with the codes of this round, error, bounds and stamps."""
    books, first = Books(history), len(history) == 1
    parts, n_groups = len(books.now), len(books.groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = matrix(batch.column(2), width).reshape(n, parts, -1)
            codes, error = np.empty((n, parts), dtype=np.uint8), np.zeros(n, dtype=np.int64)
            lower, stamp = np.empty((n, parts, n_groups), dtype=np.float32), np.zeros((n, parts, n_groups), dtype=np.uint8)
            if not first:
                old = [np.frombuffer(b"".join(c.to_pylist()), t).reshape(n, parts, -1) for c, t in zip(batch.columns[3:6], (np.uint8, np.float32, np.uint8), strict=True)]
            for p in range(parts):
                if first:
                    code, best, lower[:, p] = books.searched(p, x[:, p])
                else:
                    code, best, lower[:, p], stamp[:, p], _ = books.renewed(p, x[:, p], old[0][:, p, 0].astype(np.int64), old[1][:, p].astype(np.float64), old[2][:, p])
                codes[:, p] = code
                error += best
            sizes = np.full(n, parts, dtype=np.int64)
            made = [binaries(codes, sizes), binaries(lower, sizes * n_groups * 4), binaries(stamp, sizes * n_groups), pa.array(error)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], names=["id", "label", "v", "codes", "bounds", "stamps", "error"])

    empty = F.lit(b"")
    schema = rows.select("id", "label", "v", empty.alias("codes"), empty.alias("bounds"), empty.alias("stamps"), F.lit(0).cast("bigint").alias("error")).schema
    return rows.select("id", "label", "v", *([] if first else ["codes", "bounds", "stamps"])).mapInArrow(run, schema)


def renewed_books(rows: DataFrame, now: np.ndarray, width: int) -> np.ndarray:
    """The floors of the means of the parts that each entry has; an entry without any stays. Only sums per entry and place leave a task."""
    parts, entries, w = now.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), dtype=np.int64), np.zeros((parts, entries, w), dtype=np.int64)
        for batch in batches:
            x = matrix(batch.column(0), width).reshape(batch.num_rows, parts, w)
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, parts)
            for p in range(parts):
                count[p] += np.bincount(codes[:, p], minlength=entries)
                for i in range(w):
                    total[p, :, i] += np.bincount(codes[:, p], weights=x[:, p, i], minlength=entries).astype(np.int64)
        entry, place = np.divmod(np.arange(total.size), w)
        used = count.ravel()[entry] > 0
        yield pa.RecordBatch.from_arrays([pa.array(entry[used], pa.int32()), pa.array(place[used], pa.int32()), pa.array(count.ravel()[entry][used]), pa.array(total.ravel()[used])], names=["entry", "place", "n", "s"])

    sums = rows.select("v", "codes").mapInArrow(run, "entry int, place int, n bigint, s bigint")
    out = now.copy().reshape(parts * entries, w)
    for r in sums.groupBy("entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s")).collect():  # a row per number of the codebooks
        out[r.entry, r.place] = int(r.s) // r.n
    return out.reshape(now.shape)


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """id, label, codes (a byte per part), error of every kept vector, and the final codebooks (parts, entries, width); up to 256 entries.

    Dropped are vectors that are null or hold null or non-finite components. Shorter vectors count as the longest one with zeros behind, and all are
    filled up with zeros to a multiple of parts; components beyond 2**26 count as that. Fewer vectors than entries make as many entries; no
    vectors make no rows. Repeated rows and equal vectors count as often as they stand there; null ids and labels stay.
    """
    base = saved(whole_vectors(vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")), scale, ["id", "label"], "vector"), "vectors")
    longest = base.agg(F.max(F.octet_length("v"))).first()[0] or 0
    width = max(1, -(-longest // 4 // parts)) * parts
    history, rows = [first_books(base, width, parts, entries)], base
    for _ in range(rounds if history[0].shape[1] else 0):
        following = saved(coded(rows, history, width), "coded")
        removed(rows)
        rows = following
        history.append(renewed_books(rows, history[-1], width))
    if not history[0].shape[1]:
        return base.select("id", "label", F.lit(b"").alias("codes"), F.lit(0).cast("bigint").alias("error")), history[-1]
    out = saved(coded(rows, history, width).select("id", "label", "codes", "error"), "codes")
    removed(rows)
    return out, history[-1]


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An error, or a sum of them, beyond a long counts as its largest number."""
    rows, books = encode(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    total = F.least(F.sum(F.col("error").cast("decimal(20,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("bigint")
    by_label = saved(rows.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")), "label-errors")
    few = by_label.count() <= 100_000
    name = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    joined = rows.join(F.broadcast(by_label) if few else by_label, rows["label"].eqNullSafe(by_label["of"]))
    return joined.select(F.col("id").alias("vec_id"), F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(name).alias("codebooks_sha256"))
