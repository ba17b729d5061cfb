"""Substring deduplication over words: super-k-mers go to buckets by minimiser, where sorting counts windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.llm.common import hash_words, rolling_fixed, steps, table, text_bytes, word_spans
from rasterweave.llm.superkmers import Windows, merged, repeats

WINDOW = 35
#: Words of a minimiser, and of the longer ones that take a hot one's place.
GRAMS = (8, 16, 28)


def counted(size: int):
    """Judges windows of size words: sorts their hashes, compares the texts of neighbours that agree, and adds up counts."""

    def judge(strings: list[bytes], counts: np.ndarray, minimisers: np.ndarray) -> list[np.ndarray | None]:
        hashes, owner, begin, end, base = [], [], [], [], 0
        for i, j in steps([len(s) for s in strings]):
            buffer = np.frombuffer(b"\n".join(strings[i:j]), dtype=np.uint8)
            first, last = word_spans(buffer)
            bounds = np.searchsorted(first, np.cumsum([0, *(len(s) + 1 for s in strings[i:j])]))
            n = np.diff(bounds) - size + 1
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - bounds[:-1], n)
            offset = np.cumsum([0, *(len(s) + 1 for s in strings[i:j])])[:-1]
            own = np.repeat(np.arange(j - i), n)
            hashes.append(rolling_fixed(hash_words(buffer, first, last), size)[at])
            owner.append(own + i)
            begin.append((first[at] - offset[own]).astype(np.int32))
            end.append((last[at + size - 1] - offset[own]).astype(np.int32))
            base += j - i
        if not hashes:
            return []
        value, own, begin, end = (np.concatenate(x) for x in (hashes, owner, begin, end))
        order = np.argsort(value, kind="stable")
        new = np.concatenate(([True], value[order][1:] != value[order][:-1]))
        group = np.cumsum(new) - 1
        total = np.bincount(group, weights=counts[own[order]])
        again = total[group] > 1
        text = lambda k: strings[own[k]][begin[k] : end[k]]
        for k in np.flatnonzero(again & ~new).tolist():  # equal hashes of unequal texts would part here
            if text(order[k]) != text(order[k - 1]):
                members = order[group == group[k]].tolist()
                times: dict[bytes, int] = {}
                for m in members:
                    times[text(m)] = times.get(text(m), 0) + int(counts[own[m]])
                again[group == group[k]] = [times[text(m)] > 1 for m in members]
        flags = np.empty(len(value), dtype=bool)
        flags[order] = again
        return np.split(flags, np.flatnonzero(np.diff(own)) + 1)

    return judge


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, removed (spans of words: start, end), kept (the other words joined by a space), one row per document.

    A word goes if a window of that many words covers it whose words also start anywhere else, the same document included; windows are judged on the
    input. Null is a text without words; texts shorter than a window keep all; repeated rows repeat each other. Other columns are not looked at.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("h"))
    found = repeats(rows, Windows(True, window, tuple(g for g in GRAMS if g < window) or (1,)), counted(window))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, doc_id, spans in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = text.split()
                gone, kept, at = merged(spans), [], 0
                for a, b in gone:
                    kept += words[at:a]
                    at = b
                rows.append({"doc_id": doc_id, "n_words": len(words), "removed": [{"start": a, "end": b} for a, b in gone], "kept": b" ".join(kept + words[at:])})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return found.select("text", "doc_id", "spans").mapInArrow(run, "doc_id bigint, n_words bigint, removed array<struct<start:int,end:int>>, kept binary")


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s.end - s.start)
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
