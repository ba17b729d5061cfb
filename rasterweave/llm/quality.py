"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting fits shallow trees on one binned feature at a time, then on pairs of them; what they add up to is a lookup table per
feature and per pair, so a score is a sum of vectorised bin lookups.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.llm.common import fold, saved, table, text_bytes

FOLDS = 5
THRESHOLD = 0.3
#: Most labelled rows that the model is fitted on, the least by hash of the id; 17 numbers each.
FIT_ROWS = 20_000
FEATURES = ("log_bytes", "log_words", "word_length", "distinct_words", "top_word", "symbols", "digits", "upper", "lines", "repeated_lines", "sentences", "non_ascii", "bars", "odd_ends", "entropy", "squeeze", "long_words")

_CLASS = np.zeros(256, dtype=np.int64)  # 1 lower, 2 upper, 3 digit, 4 space, 5 sentence marks, 6 other ASCII, 7 beyond
_CLASS[33:128] = 6
_CLASS[128:] = 7
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[ord(c) for c in ".,;:!?'\""]] = 5
_ODD = frozenset(b"#$%&*|=~^<>{}[]@\\")


def features(text: bytes) -> tuple[float, ...]:
    """Of one whole text; label, language, source and id have no part in it."""
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    kinds = np.bincount(_CLASS, weights=counts, minlength=8)
    words = text.split()
    n, w = max(1, len(text)), max(1, len(words))
    lines = text.split(b"\n")
    own = Counter(words)
    p = counts[counts > 0] / n
    return (
        float(np.log1p(len(text))), float(np.log1p(len(words))), (n - kinds[4]) / w, len(own) / w, max(own.values(), default=0) / w, kinds[6] / n, kinds[3] / n, kinds[2] / n,
        len(lines) / w, 1 - len(set(lines)) / len(lines), (counts[46] + counts[33] + counts[63]) / w, kinds[7] / n, counts[124] / w, sum(x[-1] in _ODD for x in words) / w,
        float(-(p * np.log2(p)).sum()) if len(text) else 0.0, len(zlib.compress(text, 1)) / (n + 12), sum(len(x) > 24 for x in words) / w,
    )


def featurise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and x, the features as an array; null is an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([features(t) for t in text_bytes(batch.column(1))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), x], names=["doc_id", "x"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, x array<double>")


@dataclass
class Additive:
    """score(x) = sigmoid(base + sum of table lookups)."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    coarse: int = 4  # bins of a single feature that make one of a pair

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        b, total = self.bins(x), np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            total += t[b[j]]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            total += t[b[i] // self.coarse, b[j] // self.coarse]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def cut_tree(grad: np.ndarray, hess: np.ndarray, leaves: int, penalty: float) -> np.ndarray:
    """Leaf values, per bin, of the tree with up to leaves leaves that best first splits give."""
    g, h = np.concatenate(([0], np.cumsum(grad))), np.concatenate(([0], np.cumsum(hess)))
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + penalty)
    parts = [(0, len(grad))]
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for a, b in parts:
            if b - a > 1:
                at = np.arange(a + 1, b)
                won = gain(a, at) + gain(at, b) - gain(a, b)
                k = int(np.argmax(won))
                if won[k] > best[0]:
                    best = (float(won[k]), (a, b), int(at[k]))
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + penalty)
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 60, rate: float = 0.15, n_bins: int = 32, n_pairs: int = 6, penalty: float = 2.0) -> Additive:
    """Cyclic boosting: each round visits every feature in turn, then the pairs that the residuals favour most.

    Without rows the model says 0.5 to everything; with labels of one kind it says nearly that kind.
    """
    n, d = x.shape
    model = Additive(float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))))
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, n_bins + 1)[1:-1])) if n else np.empty(0) for j in range(d)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if not n:
        return model
    b, total = model.bins(x), np.full(n, model.base)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(d):
            g, h = residual()
            step = rate * cut_tree(np.bincount(b[j], g, len(model.tables[j])), np.bincount(b[j], h, len(model.tables[j])), 4, penalty)
            model.tables[j] += step
            total += step[b[j]]
    c = [k // model.coarse for k in b]
    width = [len(e) // model.coarse + 1 for e in model.edges]
    cells = lambda i, j: c[i] * width[j] + c[j]
    g, h = residual()

    def gain(pair: tuple[int, int]) -> float:
        size = width[pair[0]] * width[pair[1]]
        return float((np.bincount(cells(*pair), g, size) ** 2 / (np.bincount(cells(*pair), h, size) + penalty)).sum()) / np.sqrt(size)

    model.pairs = sorted(((i, j) for i in range(d) for j in range(i)), key=gain, reverse=True)[:n_pairs]
    model.pair_tables = [np.zeros((width[i], width[j])) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(model.pairs):
            g, h = residual()
            at = cells(i, j)
            grid_g, grid_h = (np.bincount(at, v, width[i] * width[j]).reshape(width[i], width[j]) for v in (g, h))
            # a tree of depth two: the rows in two parts, each of which splits its columns
            first = cut_tree(grid_g.sum(1), grid_h.sum(1), 2, penalty)
            step = np.zeros_like(grid_g)
            for value in np.unique(first):
                rows = first == value
                step[rows] = cut_tree(grid_g[rows].sum(0), grid_h[rows].sum(0), 2, penalty)
            model.pair_tables[k] += rate * step
            total += rate * step.ravel()[at]
    return model


def train(featured: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = FOLDS, most_rows: int = FIT_ROWS) -> Additive:
    """A model from the labelled rows outside fold 0; null labels and ids don't count.

    It is fitted on at most most_rows rows, those with the least hash of the id: a uniform sample that reruns repeat.
    """
    known = labels.where(F.col(label_col).isNotNull() & (fold(F.col("doc_id"), folds) != 0)).select("doc_id", F.col(label_col).cast("double").alias("y"))
    joined, place = featured.join(known, "doc_id"), F.xxhash64("doc_id")
    n = joined.count()
    # all rows up to a hash that about a fifth more than most_rows have, so that tasks don't each send most_rows of their own to the driver
    share = 1.2 * most_rows / max(n, 1)
    near = joined.where(place <= int((share - 0.5) * (1 << 64))) if share < 1 else joined
    rows = near.orderBy(place, "doc_id", "y", "x").limit(most_rows).toPandas()
    if len(rows) < min(most_rows, n):  # many rows of one id can leave too few others below that hash
        rows = joined.orderBy(place, "doc_id", "y", "x").limit(most_rows).toPandas()
    x = np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), len(FEATURES))
    return fit(x, rows["y"].to_numpy(float))


def scored(featured: DataFrame, model: Additive) -> DataFrame:
    """featured with score in place of x, a row for each row; null ids and repeated rows are scored like others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), dtype=float).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x), pa.float64())], names=["doc_id", "score"])

    return featured.select("doc_id", "x").mapInArrow(run, "doc_id bigint, score double")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    featured = saved(featurise(table(spark, sf_dir, "documents")), "features")
    out = scored(featured, train(featured, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Additive, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least threshold, unchanged; features and scores are made where the text is.

    A null text is scored as an empty one and stays null where it is kept; repeated rows fare alike and all stay; no documents, none out. Null ids
    and other columns are not looked at.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t) for t in text_bytes(batch.column(names.index("text")))], dtype=float).reshape(batch.num_rows, len(FEATURES))
            yield batch.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
