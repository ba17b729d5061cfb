"""Codes, searches and clusters of vectors against plain versions over whole numbers."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import SF

from rasterweave.llm import centroids, vector_codes, vector_search, vectors
from rasterweave.llm.centroids import op13_centroids
from rasterweave.llm.vector_codes import op11_vector_codes
from rasterweave.llm.vector_search import op12_top_k

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, sq string, row string, cell int, codes string, cluster string"


def rows() -> list[tuple]:
    """Null ids, shared ids, nulls and non-finite components, other lengths, equal vectors, large components and columns that clash."""
    draw = random.Random(11)
    vector = lambda n=64, s=0.2: [float(np.float32(draw.gauss(0, s))) for _ in range(n)]
    same = vector()
    out = [(i, vector(), i % 4 if i % 9 else None) for i in range(120)]
    out += [(200 + i, same, 7) for i in range(60)]  # more than k equal ones
    out += [(300, None, 1), (301, [*vector(63), None], 1), (302, [*vector(63), math.nan], 1), (400, [*vector(63), math.inf], 1), (304, [], 1), (305, vector(63), 1), (306, vector(70), None)]
    out += [(None, vector(), 3), (None, same, None), (100, vector(), 2), (100, vector(), 2), (-100, vector(), 2), (1 << 60, [0.0] * 64, 5), (500, [900.0, -900.0] * 32, 5), (600, vector(64, 30.0), 5)]
    return [(*r, "v", "sq", "row", 1, "codes", "cluster") for r in out]


def frame(spark, data: list[tuple] | None = None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)


def plain(data, scale: int, length: int | None = None) -> list[tuple]:
    """id, whole vector, label of the kept rows."""
    good = [r for r in data if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and (length is None or len(r[1]) == length)]
    return [(r[0], [max(-vectors.LIMIT, min(vectors.LIMIT, math.floor(scale * x))) for x in r[1]], r[2]) for r in good]


def sha(numbers) -> str:
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def distance(a, b) -> int:
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def codes(data, entries: int = 64, parts: int = 16) -> list[tuple]:
    kept = plain(data, 256)
    width = -(-max((len(v) for _, v, _ in kept), default=1) // parts)
    kept = [(i, v + [0] * (width * parts - len(v)), label) for i, v, label in kept]
    ordered = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], np.int32).tobytes()))
    books = [[v[p * width : (p + 1) * width] for _, v, _ in ordered[:entries]] for p in range(parts)]

    def assign():
        out = []
        for _, v, _ in kept:
            near = [min((distance(v[p * width : (p + 1) * width], e), j) for j, e in enumerate(books[p])) for p in range(parts)]
            out.append(([j for _, j in near], sum(d for d, _ in near)))
        return out

    for _ in range(2):
        found = assign()
        for p in range(parts):
            for j in range(len(books[p])):
                own = [v[p * width : (p + 1) * width] for (_, v, _), (c, _) in zip(kept, found, strict=True) if c[p] == j]
                if own:
                    books[p][j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found, total = assign(), Counter()
    for (_, _, label), (_, error) in zip(kept, found, strict=True):
        total[label] += error
    name = sha(x for book in books for e in book for x in e)
    return sorted(((i, "".join(f"{j:02x}" for j in c), error, total[label], name) for (i, _, label), (c, error) in zip(kept, found, strict=True)), key=repr)


def searched(data, k: int = 10, every: int = 100) -> list[tuple]:
    kept, out = plain(data, 1024), []
    for q, (i, v, _) in enumerate(kept):
        if i is not None and i % every == 0:
            scores = [(-sum(x * y for x, y in zip(v, w, strict=False)), j is None, j or 0) for n, (j, w, _) in enumerate(kept) if n != q]
            out += [(i, rank, None if none else j, -s) for rank, (s, none, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def clustered(data, k: int = 8, rounds: int = 10) -> list[tuple]:
    kept = plain(data, 1024, 64)
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), centroids.pack(np.array([r[1]], np.int32))[0].tobytes()))
    at = [v for _, v, _ in order[:k]]
    assign = lambda: [min((distance(v, c), n) for n, c in enumerate(at)) for _, v, _ in kept]
    for _ in range(rounds):
        found = assign()
        for n in range(len(at)):
            own = [v for (_, v, _), (_, c) in zip(kept, found, strict=True) if c == n]
            if own:
                at[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found, inertia = assign(), Counter()
    for d, n in found:
        inertia[n] += d
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), sha(at[n])) for (i, _, _), (d, n) in zip(kept, found, strict=True)), key=repr)


def answered(df, *columns: str) -> list[tuple]:
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def query(spark, monkeypatch, module, run, data, *columns: str) -> list[tuple]:
    monkeypatch.setattr(module, "table", lambda *_: frame(spark, data))
    return answered(run(spark, ""), *columns)


@pytest.mark.parametrize("case", ["edges", "few", "empty", "one"])
def test_of_edge_cases(spark, monkeypatch, case):
    data = {"edges": rows(), "few": rows()[:5] + rows()[180:184], "empty": [], "one": rows()[:1]}[case]
    assert query(spark, monkeypatch, vector_codes, op11_vector_codes, data, "vec_id", "code", "error", "label_error", "codebooks_sha256") == codes(data)
    assert query(spark, monkeypatch, vector_search, op12_top_k, data, "query_id", "rank", "vec_id", "score") == searched(data)
    assert query(spark, monkeypatch, centroids, op13_centroids, data, "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256") == clustered(data)


def test_queries(spark):
    data = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert answered(op11_vector_codes(spark, SF), "vec_id", "code", "error", "label_error", "codebooks_sha256") == codes(data)
    assert answered(op12_top_k(spark, SF), "query_id", "rank", "vec_id", "score") == searched(data)
    assert answered(op13_centroids(spark, SF), "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256") == clustered(data)


def test_bounds_spare_distances_and_net_moves_are_tighter_than_drifts():
    """Clustered parts: later rounds measure fewer distances than a full search and find the same; bounds of every age stay true."""
    draw = np.random.default_rng(5)
    centres = draw.integers(-400, 400, (64, 4))
    x = centres[draw.integers(0, 64, 3000)] + draw.integers(-20, 20, (3000, 4))
    history = [x[:64][None].copy()]
    code, _, lower = vector_codes.Books(history).searched(0, x)
    stamp, spent, drift, net = np.zeros(lower.shape, dtype=np.uint8), 0, 0.0, 0.0
    for t in range(1, 7):
        history.append(np.array([[x[code == j].sum(0) // max((code == j).sum(), 1) if (code == j).any() else history[-1][0, j] for j in range(64)]]))
        books = vector_codes.Books(history)
        code, best, lower, stamp, measured = books.renewed(0, x, code, lower.astype(np.float64), stamp)
        full = vectors.square_distances(x, history[-1][0])
        assert (code == full.argmin(1)).all() and (best == full.min(1)).all()
        other = full.astype(float)
        other[np.arange(len(x)), code] = np.inf
        assert (lower - books.net[stamp, 0, np.arange(4)[None, :]] <= np.sqrt(np.stack([other[:, g].min(1) for g in books.groups], 1))).all()
        spent += measured
        drift += np.sqrt(((history[-1] - history[-2]) ** 2).sum(2)).sum()
        net = np.sqrt(((history[-1] - history[0]) ** 2).sum(2)).sum()
        assert net <= drift + 1e-9
    assert spent < 6 * full.size / 2 and len(np.unique(stamp)) > 2


def test_search_replicates_only_shells_that_can_matter(spark):
    """Far clusters: groups of few queries in small pieces; results equal a full search, and most of the data goes to no other cluster's queries."""
    draw = np.random.default_rng(9)
    centres = draw.normal(0, 1, (12, 16))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    data = [(i, (centres[i % 12] * 8 + draw.normal(0, 0.02, 16)).astype(np.float32).tolist(), 0) for i in range(1500)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int").repartition(3)
    found = vector_search.top_k(df, every=25, queries=8, piece=64, pivots=30)
    assert answered(found, "query_id", "rank", "id", "score") == searched(data, every=25)
    points = vector_search.lifted(np.floor(centres * 8 * 1024).astype(np.int64), np.zeros(12), 0)
    bounds = vector_search.shells(points, {0: (4, 50.0)}, [(c, g) for c in range(12) for g in np.linspace(0, 60, 11)], 10)
    lo, hi = bounds[0]
    assert lo[0] <= 0 <= hi[0] and sum(lo <= 400) < 6


def test_planes_hold_what_vectors_hold():
    draw = np.random.default_rng(2)
    x = np.concatenate((draw.integers(-700, 700, (50, 64)), draw.integers(-(1 << 26), 1 << 26, (5, 64)), np.zeros((1, 64), int), -np.ones((1, 64), int))).astype(np.int32)
    words, need = centroids.pack(x)
    assert (centroids.unpack(words) == x).all()
    column = vectors.binaries(words[np.arange(words.shape[1])[None, :] < need[:, None]], need * 8)
    planes = centroids.read_planes(column)
    assert (centroids.plane_products(planes, words[51]) == x.astype(np.int64) @ x[51].astype(np.int64)).all()
    count, total = centroids.sums(planes, np.arange(len(x)) % 3, 3)
    assert count.tolist() == [19, 19, 19] and (total[1] == x[1::3].astype(np.int64).sum(0)).all()
