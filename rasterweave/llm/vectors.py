"""Vectors as whole numbers, as the operators on embeddings share them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Components beyond this, either way, count as this, so that sums of squares fit a long.
LIMIT = 1 << 26


def whole(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows hold a vector of finite components, and of these the lengths and, end to end, floor(scale * x) of every component."""
    there = np.flatnonzero(np.asarray(column.is_valid()))
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    length = np.asarray(pc.list_value_length(column).drop_null(), dtype=np.int64)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    end = np.cumsum(length)
    good = bad[end] == bad[end - length]
    values = np.clip(np.floor(flat[np.repeat(good, length)] * scale), -LIMIT, LIMIT).astype(np.int32)
    return there[good], length[good], values


def binaries(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive pieces of values, of so many bytes each, as a binary column."""
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    if offsets[-1] >= 1 << 31:
        raise ValueError("a batch of more than 2 GB of vectors: lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of whole vectors, each with zeros behind up to width."""
    out = np.zeros((len(column), width), dtype=np.int32)
    for i, x in enumerate(column.to_pylist()) if pa.types.is_large_binary(column.type) else ():
        out[i, : len(x) // 4] = np.frombuffer(x, np.int32)
    if len(column) and not pa.types.is_large_binary(column.type):
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) // 4
        flat = np.frombuffer(column.buffers()[2] or b"", np.int32)[offsets[0] : offsets[-1]]
        length = np.diff(offsets)
        out[np.arange(width)[None, :] < length[:, None]] = flat
    return out


def whole_vectors(df: DataFrame, scale: int, carried: list[str], vector_col: str = "embedding", length: int | None = None) -> DataFrame:
    """carried, v (binary: 32-bit whole numbers floor(scale * x)) and sq (the sum of their squares) of the rows whose vector is not null and holds neither null nor non-finite components; of that length only, if one is given.

    No rows make no rows; repeated rows stay; columns other than those named are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lengths, values = whole(batch.column(len(carried)), scale)
            if length is not None:
                fits = lengths == length
                rows, values, lengths = rows[fits], values[np.repeat(fits, lengths)], lengths[fits]
            total = np.concatenate(([0], np.cumsum(values.astype(np.int64) ** 2)))
            end = np.cumsum(lengths)
            kept = batch.select(carried).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*kept.columns, binaries(values, lengths * 4), pa.array(total[end] - total[end - lengths], pa.int64())], names=[*carried, "v", "sq"])

    schema = df.select(*carried, F.lit(b"").alias("v"), F.lit(0).cast("bigint").alias("sq")).schema
    return df.select(*carried, vector_col).mapInArrow(run, schema)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of a with those of b: by floating point as long as that can tell every sum, else by whole numbers."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 1 << 53:
        return a.astype(np.float64) @ b.T.astype(np.float64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


def square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of a from those of b, as 64-bit whole numbers."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    return (a * a).sum(1)[:, None] - 2 * products(a, b).astype(np.int64) + (b * b).sum(1)[None, :]
