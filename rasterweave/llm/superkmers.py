"""Super-k-mers: runs of consecutive windows that share a minimiser, each as one packed string, dealt to buckets by minimiser.

Equal windows have equal minimisers, so all places of a window's content meet in one bucket. A bucket tells which windows of its
strings occur more than once; the strings' digests lead back to the documents that have them.

A minimiser with many different strings would be one large group. Bytes of different strings per minimiser are estimated first; the windows of hot ones take a longer
minimiser in its place, so their runs are cut where that changes and go to buckets of their own, and those of hot longer ones a longer one again. Which minimiser a window has still follows
from its content alone. Strings that are hot at every length are counted whole; the windows of those that occur once are told apart by their digests, each window a group of its own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterweave.llm.common import buckets_for, byte_values, hash_words, mix, rolling_fixed, saved, sliding_min, steps, text_bytes, word_spans

BLOCK_BYTES = 24 << 20
#: A run of more windows is cut, into strings of the same bucket.
MOST_WINDOWS = 4096
#: Minimisers with more bytes of different strings than this are hot. That is estimated from every SAMPLED-th text by hash and from all texts longer than LONG_TEXT; it decides where windows meet and changes no result.
HOT_BYTES, SAMPLED, LONG_TEXT = 2 << 20, 8, 1 << 20
#: Most counters of minimisers; their bitmap of hot ones, of 16 MB at most, is what the driver and the tasks get to know.
MOST_SLOTS = 1 << 27
FLUSH = 300_000
#: Different strings, hot at every length, that one task looks at together.
PART_STRINGS = 500


@dataclass(frozen=True)
class Windows:
    """What a window is: size units, words or bytes; its minimiser is the least hash among its runs of gram units, of the first length or, where that is hot, of a later one."""

    words: bool
    size: int
    grams: tuple[int, ...]


@dataclass
class Runs:
    """The super-k-mers of some texts: document (a number), first unit there, windows, minimiser, how many of its lengths were hot, packed string."""

    doc: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    minimiser: np.ndarray
    level: np.ndarray
    packed: list[bytes]


@dataclass(frozen=True)
class Hot:
    """The hot minimisers of each length, by counter, as bitmaps: minimisers that share a counter with a hot one count as hot too, which changes no result."""

    slots: int
    maps: tuple[np.ndarray, ...] = ()

    def slot_of(self, minimisers: np.ndarray) -> np.ndarray:
        return (mix(minimisers ^ np.uint64(1 << 62)) % np.uint64(self.slots)).astype(np.int64)

    def has(self, level: int, minimisers: np.ndarray) -> np.ndarray:
        slot = self.slot_of(minimisers)
        return (self.maps[level][slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0


def cooled(units: np.ndarray, kind: Windows, least: np.ndarray, heat: np.ndarray, hot: Hot) -> tuple[np.ndarray, np.ndarray]:
    """Each window's minimiser with longer ones in place of hot ones, and how many of its lengths were hot. heat: the windows whose first one is; only their stretches of text are looked at again."""
    least, level = least.copy(), heat.astype(np.int8)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], heat.view(np.int8), [0])))).tolist()
    for a, b in zip(edges[::2], edges[1::2], strict=True):
        stretch, at = units[a : b + kind.size - 1], np.arange(a, b)
        for k, gram in enumerate(kind.grams[1:], 1):
            longer = mix(sliding_min(rolling_fixed(stretch, gram), kind.size - gram + 1)[at - a] ^ np.uint64(k))
            least[at] = longer
            if k == len(hot.maps):
                break
            at = at[hot.has(k, longer)]
            if not len(at):
                break
            level[at] = k + 1
    return least, level


def super_kmers(texts: list[bytes], kind: Windows, hot: Hot | None = None) -> Iterator[Runs]:
    for begin, end in steps([len(t) for t in texts]):
        own = [b" ".join(t.split()) for t in texts[begin:end]] if kind.words else texts[begin:end]
        raw = b"\n".join(own)
        buffer = np.frombuffer(raw, dtype=np.uint8)
        edges = np.cumsum([0, *(len(t) + 1 for t in own)])
        if kind.words:
            first, last = word_spans(buffer)
            units = hash_words(buffer, first, last)
            bounds = np.searchsorted(first, edges)
            ends = bounds[1:]
        else:
            first = np.arange(len(buffer))
            last, units, bounds, ends = first + 1, byte_values(buffer), edges, edges[1:] - 1
        least = sliding_min(rolling_fixed(units, kind.grams[0]), kind.size - kind.grams[0] + 1) if len(units) >= kind.size else units[:0]
        if not len(least):
            continue
        change = np.zeros(len(least) + 1, dtype=np.int32)  # windows inside one document
        inside = ends - bounds[:-1] >= kind.size
        np.add.at(change, bounds[:-1][inside], 1)
        np.add.at(change, ends[inside] - kind.size + 1, -1)
        valid = np.cumsum(change[:-1]) > 0
        same = np.zeros(len(least), dtype=bool)
        same[1:] = (least[1:] == least[:-1]) & valid[:-1]
        same[bounds[:-1][inside]] = False
        starts, level = np.flatnonzero(valid & ~same), None
        if hot and hot.maps and (heated := hot.has(0, least[starts])).any():
            heat = np.zeros(len(least), dtype=bool)
            heat[valid] = heated[np.cumsum(valid & ~same)[valid] - 1]
            least, level = cooled(units, kind, least, heat, hot)
            same[1:] &= (least[1:] == least[:-1]) & (level[1:] == level[:-1])
            starts = np.flatnonzero(valid & ~same)
        at = np.flatnonzero(valid)
        count = np.diff(np.searchsorted(at, np.append(starts, len(least) + 1)))
        if len(count) and count.max() > MOST_WINDOWS:
            pieces = -(-count // MOST_WINDOWS)
            step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            starts, count = np.repeat(starts, pieces) + step * MOST_WINDOWS, np.minimum(np.repeat(count, pieces) - step * MOST_WINDOWS, MOST_WINDOWS)
        doc = np.searchsorted(bounds, starts, side="right") - 1
        a, b = first[starts].tolist(), last[starts + count + kind.size - 2].tolist()
        yield Runs(doc + begin, starts - bounds[doc], count, least[starts], np.zeros(len(starts), dtype=np.int8) if level is None else level[starts], [raw[i:j] for i, j in zip(a, b, strict=True)])


def hot_minimisers(docs: DataFrame, kind: Windows, n_buckets: int) -> Hot:
    """Length by length, as long as some are hot: a string counts once, however many tasks have it, times the share of its text's sample. What comes to the driver is a bitmap, 4 KB for each 32,768 counters that have a hot one."""
    hot, long_ = Hot(min(MOST_SLOTS, max(1 << 16, 64 * n_buckets))), F.octet_length("text") > LONG_TEXT
    some = docs.where(long_ | (F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0)).select("text", F.when(long_, 1).otherwise(SAMPLED).alias("times"))
    for level in range(len(kind.grams)):

        def run(batches: Iterator[pa.RecordBatch], level: int = level, hot: Hot = hot) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in batches:
                times = batch.column(1).to_pylist()
                for runs in super_kmers(text_bytes(batch.column(0)), kind, hot):
                    slots, names, sizes = [], [], []
                    for i in np.flatnonzero(runs.level == level).tolist():
                        name = xxhash.xxh3_64_intdigest(runs.packed[i])
                        if name not in seen:
                            seen.add(name)
                            slots.append(i)
                            names.append(name - (1 << 63))
                            sizes.append((len(runs.packed[i]) + 60) * times[int(runs.doc[i])])
                    yield pa.RecordBatch.from_arrays([pa.array(hot.slot_of(runs.minimiser[slots])), pa.array(names, pa.int64()), pa.array(sizes, pa.int64())], names=["slot", "name", "bytes"])
                    if len(seen) > FLUSH:
                        seen.clear()

        once = some.mapInArrow(run, "slot bigint, name bigint, bytes bigint").groupBy("slot", "name").agg(F.max("bytes").alias("bytes"))
        heavy = once.groupBy("slot").agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") > HOT_BYTES)
        maps = heavy.groupBy((F.floor(F.col("slot") / 32768)).alias("part")).agg(F.bitmap_construct_agg(F.col("slot") % 32768).alias("bits")).collect()
        if not maps:
            break
        bits = np.zeros(-(-hot.slots // 32768) * 4096, dtype=np.uint8)
        for r in maps:
            bits[r.part * 4096 : r.part * 4096 + 4096] = np.frombuffer(r.bits, dtype=np.uint8)
        hot = Hot(hot.slots, (*hot.maps, bits))
    return hot


def windows_of(packed: bytes, kind: Windows) -> list[bytes]:
    if not kind.words:
        return [packed[i : i + kind.size] for i in range(len(packed) - kind.size + 1)]
    ends = [*np.flatnonzero(np.frombuffer(packed, dtype=np.uint8) == 32).tolist(), len(packed)]
    begins = [0, *(e + 1 for e in ends[:-1])]
    return [packed[a:b] for a, b in zip(begins, ends[kind.size - 1 :], strict=False)]


def hot_repeats(texts: DataFrame, kind: Windows, hot: Hot) -> DataFrame:
    """digest and runs, like judged(), of the strings that are hot at every length. All windows of a string that occurs again do. Those of the others are told apart by 128-bit digest; a part of the strings tells a window once, whatever number of them have it."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[int]] = {}
        size = 0

        def pack() -> pa.RecordBatch:
            columns = [pa.array([xxhash.xxh3_128_digest(s) for s in held], pa.binary()), pa.array(list(held), pa.binary()), *(pa.array([v[k] for v in held.values()], pa.int64()) for k in (0, 1))]
            return pa.RecordBatch.from_arrays(columns, names=["digest", "packed", "n", "c"])

        for batch in batches:
            for runs in super_kmers(text_bytes(batch.column(0)), kind, hot):
                for i in np.flatnonzero(runs.level == len(kind.grams)).tolist():
                    if have := held.get(runs.packed[i]):
                        have[1] += 1
                    else:
                        held[runs.packed[i]] = [int(runs.windows[i]), 1]
                        size += len(runs.packed[i]) + 60
                if size > BLOCK_BYTES:
                    yield pack()
                    held.clear()
                    size = 0
        if held:
            yield pack()

    def count(rows: pa.Table) -> pa.Table:
        counts: Counter[bytes] = Counter()
        once: set[bytes] = set()
        for packed, c in zip(rows.column("packed").to_pylist(), rows.column("c").to_pylist(), strict=True):
            own = [xxhash.xxh3_128_digest(w) for w in windows_of(packed, kind)]
            if c == 1:
                once.update(own)
            for w in own:
                counts[w] += c
        columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64()), pa.array([w in once for w in counts], pa.bool_())]
        return pa.table([pa.repeat(rows.column("part")[0], len(counts)), *columns], names=["part", "window", "c", "once"])

    def flagged(rows: pa.Table, windows: pa.Table) -> pa.Table:
        known = set(windows.column("window").to_pylist())
        flags = [np.array([xxhash.xxh3_128_digest(w) in known for w in windows_of(p, kind)]) for p in rows.column("packed").to_pylist()] if known else []
        keep = [i for i, f in enumerate(flags) if f.any()]
        return pa.table([rows.column("digest").take(pa.array(keep, pa.int64())), pa.array([runs_of(flags[i]) for i in keep], pa.list_(pa.int32()))], names=["digest", "runs"])

    whole = saved(texts.mapInArrow(strings, "digest binary, packed binary, n bigint, c bigint").groupBy("digest").agg(F.first("packed").alias("packed"), F.first("n").alias("n"), F.sum("c").alias("c")), "hot")
    parts = whole.withColumn("part", F.pmod(F.xxhash64("digest"), F.lit(-(-whole.count() // PART_STRINGS) or 1)))
    counts = saved(parts.groupBy("part").applyInArrow(count, "part bigint, window binary, c bigint, once boolean"), "windows")
    again = counts.groupBy("window").agg(F.sum("c").alias("c")).where("c > 1").select("window")
    known = counts.where("once").select("part", "window").join(again, "window")
    schema = "digest binary, runs array<int>"
    once = parts.where("c = 1").groupBy("part").cogroup(known.groupBy("part")).applyInArrow(flagged, schema)
    return whole.where("c > 1").select("digest", F.array(F.lit(0), F.col("n").cast("int")).alias("runs")).unionByName(once)


def blocks(docs: DataFrame, kind: Windows, n_buckets: int, hot: Hot) -> DataFrame:
    """bucket and a compressed block of strings with their minimisers and counts; a task tells equal strings once a block. What is hot at every length is left to hot_repeats()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            strings = list(held)
            value = np.array([v[0] for v in held.values()], dtype=np.uint64)
            counts = np.array([v[1] for v in held.values()], dtype=np.int64)
            bucket = mix(value) % np.uint64(n_buckets)
            order = np.lexsort((value, bucket))
            cuts = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order].astype(np.int64)) != 0, [True])))
            out, sizes = [], []
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                own = order[i:j]
                part = [strings[k] for k in own.tolist()]
                plain = np.array([len(part)], np.int64).tobytes() + value[own].tobytes() + counts[own].tobytes() + np.array([len(s) for s in part], np.int64).tobytes() + b"".join(part)
                sizes.append(len(plain))
                out.append(pa.compress(plain, codec="zstd", asbytes=True))
            return pa.RecordBatch.from_arrays([pa.array(bucket[order][cuts[:-1]].astype(np.int64)), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())], names=["bucket", "size", "block"])

        for batch in batches:
            for runs in super_kmers(text_bytes(batch.column(0)), kind, hot):
                for value, packed, apart in zip(runs.minimiser.tolist(), runs.packed, (runs.level == len(kind.grams)).tolist(), strict=True):
                    if apart:
                        continue
                    if have := held.get(packed):
                        have[1] += 1
                    else:
                        held[packed] = [value, 1]
                        size += len(packed) + 60
                if size > BLOCK_BYTES:
                    yield flush()
                    held.clear()
                    size = 0
        if held:
            yield flush()

    return docs.mapInArrow(run, "bucket bigint, size bigint, block binary")


#: strings, their counts, their minimisers -> for each string which windows occur more than once; None for none
Judge = Callable[[list[bytes], np.ndarray, np.ndarray], list[np.ndarray | None]]


def runs_of(flags: np.ndarray) -> list[int]:
    """Starts and ends, in turn, of the runs of True."""
    return np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))).tolist()


def judged(judge: Judge) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        found: dict[bytes, list] = {}
        for size, block in zip(rows.column("size").to_pylist(), rows.column("block"), strict=True):
            plain = pa.decompress(block.as_buffer(), decompressed_size=size, codec="zstd", asbytes=True)
            n = int(np.frombuffer(plain, np.int64, 1)[0])
            value, counts, lengths = (np.frombuffer(plain, kind, n, 8 + 8 * n * k).tolist() for k, kind in enumerate((np.uint64, np.int64, np.int64)))
            at = 8 + 24 * n
            for v, c, m in zip(value, counts, lengths, strict=True):
                packed = plain[at : at + m]
                at += m
                if have := found.get(packed):
                    have[1] += c
                else:
                    found[packed] = [v, c]
        strings = list(found)
        flags = judge(strings, np.array([v[1] for v in found.values()], dtype=np.int64), np.array([v[0] for v in found.values()], dtype=np.uint64))
        keep = [(xxhash.xxh3_128_digest(s), runs_of(f)) for s, f in zip(strings, flags, strict=True) if f is not None and f.any()]
        return pa.table([pa.array([k[0] for k in keep], pa.binary()), pa.array([k[1] for k in keep], pa.list_(pa.int32()))], names=["digest", "runs"])

    return run


def addresses(docs: DataFrame, kind: Windows, hot: Hot) -> DataFrame:
    """doc_id, h, digest, start of every super-k-mer of docs (text, doc_id, h)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column(1), batch.column(2)
            for runs in super_kmers(text_bytes(batch.column(0)), kind, hot):
                at = pa.array(runs.doc)
                yield pa.RecordBatch.from_arrays([ids.take(at), hashes.take(at), pa.array([xxhash.xxh3_128_digest(s) for s in runs.packed], pa.binary()), pa.array(runs.start.astype(np.int32))], names=["doc_id", "h", "digest", "start"])

    return docs.mapInArrow(run, "doc_id bigint, h bigint, digest binary, start int")


def repeats(rows: DataFrame, kind: Windows, judge: Judge) -> DataFrame:
    """rows (text, doc_id, h) with spans: pairs of units (start, end) that repeated windows cover; they may touch and overlap. Null where there are none.

    h is a hash of the text; rows that agree on doc_id and h are copies, each of which counts as an occurrence.
    """
    n = buckets_for(rows)
    hot = hot_minimisers(rows.select("text"), kind, n)
    again = saved(blocks(rows.select("text"), kind, n, hot).groupBy("bucket").applyInArrow(judged(judge), "digest binary, runs array<int>"), "repeats")
    run = lambda i: F.struct((F.col("start") + F.get("runs", i * 2)).alias("start"), (F.col("start") + F.get("runs", i * 2 + 1) + kind.size - 1).alias("end"))
    where = F.transform(F.expr("sequence(0, cast(size(runs) div 2 as int) - 1)"), run)
    if len(hot.maps) == len(kind.grams):
        again = again.unionByName(hot_repeats(rows.select("text"), kind, hot))
    found = addresses(rows, kind, hot).join(again, "digest").select("doc_id", "h", F.explode(where).alias("span"))
    spans = found.groupBy("doc_id", "h").agg(F.sort_array(F.collect_set("span")).alias("spans"))
    spans = saved(spans, "spans")
    return rows.join(spans, rows["doc_id"].eqNullSafe(spans["doc_id"]) & (rows["h"] == spans["h"]), "left").select(rows["*"], "spans")


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted spans as maximal runs."""
    out: list[tuple[int, int]] = []
    for s in spans or ():
        if out and s["start"] <= out[-1][1]:
            if s["end"] > out[-1][1]:
                out[-1] = (out[-1][0], s["end"])
        else:
            out.append((s["start"], s["end"]))
    return out
