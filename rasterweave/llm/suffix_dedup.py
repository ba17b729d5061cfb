"""Suffix-array deduplication of bytes.

Super-k-mers bring all places of a 400-byte string's content together. In a bucket, a suffix array of the strings that
are not plainly unique or plainly equal, built by linear grouping, puts suffixes that agree for long next to each other.
Its symbols are words with the separator that ends them, ranked as bytes, so its order is that of the bytes from word starts; a
window that starts l bytes before a word start occurs again if another suffix agrees for the other 400 - l bytes and has the same l
bytes before it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.llm.common import byte_values, mix, rolling, table, text_bytes
from rasterweave.llm.suffix_array import suffix_array
from rasterweave.llm.superkmers import Windows, merged, repeats

WINDOW = 400
#: Bytes of a minimiser, and of the longer ones that take a hot one's place.
GRAMS = (16, 64, 256)
#: A group with a longer word is worked on byte by byte.
LONGEST_WORD = 64
BATCH_SYMBOLS = 60_000
WORD = re.compile(rb"[^ \n\t]*[ \n\t]|[^ \n\t]+")


def may_repeat_itself(text: bytes, window: int) -> bool:
    """Whether a string of up to 2 * window - 16 bytes can hold one window twice: all such pairs cover its middle, so what stands there recurs."""
    middle = len(text) - window - 1
    if middle < 0:
        return False
    if len(text) > 2 * window - 14:
        return True
    core = text[middle : middle + 16]
    return text.find(core, middle + 1) >= 0 or text.rfind(core, 0, middle + 15) >= 0


def symbols_of(strings: list[bytes], single: bool) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Symbols of the strings, 1 after each and 0 at the end, their lengths in bytes, and the words by symbol."""
    words = [[bytes((c,)) for c in s] if single else WORD.findall(s) for s in strings]
    names = sorted({w for own in words for w in own})
    rank = {w: i + 2 for i, w in enumerate(names)}
    symbols = np.array([r for own in words for r in (*map(rank.__getitem__, own), 1)] + [0], dtype=np.int64)
    length = np.array([1, 1, *map(len, names)], dtype=np.int64)[symbols]
    return symbols, length, [b"", b"", *names]


def agreement(order: np.ndarray, symbols: np.ndarray, length: np.ndarray, names: list[bytes], window: int, least: int) -> np.ndarray:
    """Bytes, up to window, that each suffix and the one before it in order begin with in common; exact where they are least or more."""
    n = len(order)
    out = np.zeros(n, dtype=np.int64)
    row = np.arange(1, n)
    a, b = order[:-1].copy(), order[1:].copy()
    while len(row):
        equal = (symbols[a] == symbols[b]) & (symbols[a] > 1)
        near = ~equal & (symbols[a] > 1) & (symbols[b] > 1) & (out[row] + np.minimum(length[a], length[b]) >= least)
        for i, x, y in zip(*(v[near].tolist() for v in (row, symbols[a], symbols[b])), strict=True):
            out[i] += len(commonprefix((names[x], names[y])))
        out[row[equal]] += length[a[equal]]
        go = equal & (out[row] < window)
        row, a, b = row[go], a[go] + 1, b[go] + 1
    return np.minimum(out, window)


def again_in(strings: list[bytes], window: int, single: bool) -> list[np.ndarray]:
    """For each string which of its windows occur more than once among the strings."""
    symbols, length, names = symbols_of(strings, single)
    order = suffix_array(symbols)
    reach = max(map(len, names))
    common = agreement(order, symbols, length, names, window, window - reach)
    raw = b"\x00".join(strings) + b"\x00"
    begins = np.cumsum(length) - length
    flags = np.zeros(len(raw) + 1, dtype=bool)
    following = np.append(common[1:], 0)
    kept = np.flatnonzero(np.maximum(common, following) >= window - reach)
    if len(kept):
        suffix = order[kept]
        joint = np.where(np.concatenate(([False], np.diff(kept) == 1)), common[kept], 0)
        place = begins[suffix]
        before = np.where((suffix > 0) & (symbols[suffix - 1] > 1), length[suffix - 1], 0)
        values = byte_values(np.frombuffer(raw, dtype=np.uint8))
        for back in range(reach + 1):
            linked = joint >= window - back
            some = linked | np.append(linked[1:], False)
            if back:
                some &= before >= back  # a string's first word may be the end of a word elsewhere, so its start counts here too
            if not some.any():
                continue
            cluster = np.cumsum(~linked)[some]
            at = place[some] - back
            if back:
                key = mix(cluster.astype(np.uint64)) ^ rolling(values, at, at + back)
                _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
                at = at[counts[inverse] > 1]
            flags[at] = True
    edges = np.cumsum([0, *(len(s) + 1 for s in strings)])
    return [flags[a : b - window] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def by_suffixes(window: int):
    long_word = re.compile(rb"[^\x20\x09-\x0d]{%d}" % (min(LONGEST_WORD, window // 2) + 1))

    def judge(strings: list[bytes], counts: np.ndarray, minimisers: np.ndarray) -> list[np.ndarray | None]:
        out: list[np.ndarray | None] = [np.ones(len(s) - window + 1, dtype=bool) if c > 1 else None for s, c in zip(strings, counts.tolist(), strict=True)]
        if not strings:
            return out
        order = np.argsort(minimisers, kind="stable")
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(minimisers[order]) != 0, [True])))
        batches: dict[bool, list[int]] = {False: [], True: []}
        size = {False: 0, True: 0}

        def settle(single: bool) -> None:
            own = batches[single]
            if own:
                for i, again in zip(own, again_in([strings[i] for i in own], window, single), strict=True):
                    if out[i] is None and again.any():
                        out[i] = again
            batches[single], size[single] = [], 0

        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            group = order[a:b].tolist()
            if b - a == 1 and (counts[group[0]] > 1 or not may_repeat_itself(strings[group[0]], window)):
                continue
            single = any(long_word.search(strings[i]) for i in group)
            batches[single] += group
            size[single] += sum(len(strings[i]) if single else strings[i].count(b" ") + 2 for i in group)
            if size[single] > BATCH_SYMBOLS:
                settle(single)
        settle(False)
        settle(True)
        return out

    return judge


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, removed (spans of bytes: start, end; maximal runs), kept (the other bytes), one row per document.

    A byte goes if a string of window bytes covers it that also starts anywhere else, the same document included; strings are judged on the input
    and never cross documents. Null is an empty text; texts shorter than a window keep all; repeated rows repeat each other. Other columns are
    not looked at.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("h"))
    found = repeats(rows, Windows(False, window, tuple(g for g in GRAMS if g <= window) or (1,)), by_suffixes(window))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, doc_id, spans in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                gone, kept, at = merged(spans), [], 0
                for a, b in gone:
                    kept.append(text[at:a])
                    at = b
                rows.append({"doc_id": doc_id, "n_bytes": len(text), "removed": [{"start": a, "end": b} for a, b in gone], "kept": b"".join([*kept, text[at:]])})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return found.select("text", "doc_id", "spans").mapInArrow(run, "doc_id bigint, n_bytes bigint, removed array<struct<start:int,end:int>>, kept binary")


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s.end - s.start)
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
