"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct 5-word shingles, as 64-bit hashes. Two sets of sizes a <= b with Jaccard of 3/4 or more differ in
at most (a + b) / 7 elements. A sketch deals the elements to parts by hash and XORs the hashes within each part into 64 parity bits; an
element that only one set has changes one part, so the number of parts in which two sketches differ never exceeds the symmetric difference.
By the pigeonhole principle, similar sets agree on all but D of their parts, and so, whatever the order in which parts are
taken, on at least 1 + slack of the first D + 1 + slack. Those go to buckets, by size band; sets that meet there are
candidates. A second sketch with one bit flip per element, whose Hamming distance bounds the difference as well, rules most of the others out, and an exact
comparison of the shingle hashes verifies the rest.

Equal sets are one node from the start. Where more than HEAVY nodes share a part's sketch, they are first verified
against two of them only. A node with at most slack such crowded parts shares an uncrowded part with all that are similar to it. The others
meet once more by their rarest shingles: a crowd around one shingle meets one of its nodes at a time, in a few rounds, and nodes that
are in different components even then are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterweave.llm.common import buckets_for, hash_words, mix, removed, rolling, saved, steps, table, text_bytes, word_spans
from rasterweave.llm.components import components

SHINGLE = 5
#: Similar: PART * intersection >= OF * union.
PART, OF = 100, 75
HEAVY = 6
CROWD = 32
LANES = 32
#: Rounds in which crowds meet one of their nodes, before what is left apart is compared pair by pair.
HUB_ROUNDS = 4
FIRST_WORDS = 32
BLOCK_BYTES = 16 << 20
FILTER_BITS = 1 << 23
SLACK_FROM = 64


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text. Fewer words than a shingle's are one shingle; no words, none."""
    for begin, end in steps([len(t) for t in texts]):
        own = [t.lower() for t in texts[begin:end]]  # bytes.lower() touches A-Z alone
        buffer = np.frombuffer(b"\n".join(own), dtype=np.uint8)
        first, last = word_spans(buffer)
        words = hash_words(buffer, first, last)
        bounds = np.searchsorted(first, np.cumsum([0, *(len(t) + 1 for t in own)]))
        grams = rolling(words, np.arange(len(words) - size + 1), np.arange(size, len(words) + 1)) if len(words) >= size else words[:0]
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= size:
                yield np.unique(grams[a : b - size + 1])
            else:
                yield rolling(words[a:b], np.array([0]), np.array([b - a])) if b > a else words[:0]


def node_of(shingles: np.ndarray) -> int:
    """A 64-bit name of a set, equal for equal sets."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def parts_of(shingles: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Parity words of the parts that have elements, in the grid of a band, and how many elements each has."""
    parts = (1 << band) * 85 // 100 + 10
    at = ((shingles >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # monotone: a part's elements are neighbours
    begins = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    counts = np.diff(np.concatenate((begins, [len(shingles)])))
    return mix(np.bitwise_xor.reduceat(mix(shingles), begins) ^ mix(at[begins] + np.uint64(band << 40))), counts


def with_empty(words: np.ndarray, band: int, first: int) -> np.ndarray:
    """Empty parts come last; where fewer others are there than the principle needs, a common name stands for them."""
    return np.concatenate((words, mix(np.array([band + (1 << 50)], dtype=np.uint64)))) if len(words) < first else words


def sketch(shingles: np.ndarray, band: int, first: int, slack: int) -> np.ndarray:
    """The parity words of the first parts of a set.

    Parts of more elements come before others, since sets that are not similar seldom agree on them; then order is by hash. Both
    follow from the part's content (equal parity words are taken to be equal parts), so it is one order for all sets.
    """
    words, counts = parts_of(shingles, band)
    if len(words) > first + slack:
        words = words[np.lexsort((words, -counts))[: first + slack]]
    return with_empty(words, band, first)


def bands_of(n: int) -> list[tuple[int, int]]:
    """The bands in which a set of n meets others, and by how many parts it has to be known there."""
    band = n.bit_length() - 1
    own = [(band, n // 3 + 1)]  # a partner of up to 4/3 n
    return [*own, (band - 1, (n + (1 << band) - 1) // 7 + 1)] if band and n * OF <= PART * ((1 << band) - 1) else own  # a smaller one in the band below, of up to 2**band - 1


def signatures(shingles: np.ndarray) -> np.ndarray:
    return np.concatenate([sketch(shingles, band, first, slack_of(len(shingles))) for band, first in bands_of(len(shingles))])


def slack_of(n: int) -> int:
    return 0 if n < SLACK_FROM else 3 + n // 32


def parity(shingles: np.ndarray) -> bytes:
    """One bit per element flips: a power of two of bits, four to eight times the elements. The Hamming distance of two, folded to one length, never exceeds the symmetric difference."""
    bits = 1 << (max(len(shingles) - 1, 15).bit_length() + 2)
    flips = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()


def distance(x: bytes, y: bytes) -> int:
    """Hamming distance of two parity sketches; the longer is folded onto the shorter."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) != len(b):
        least = min(len(a), len(b))
        a, b = (np.bitwise_xor.reduce(v.reshape(-1, least), axis=0) for v in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, h, node, n, sketch: the hash of each document's text, and its set by name, size and parity sketch."""
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(node_of(s), len(s), parity(s) if len(s) else b"") for s in shingle_sets(text_bytes(batch.column(2)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([s[i] for s in sets], schema.field(i + 2).type) for i in range(3))], schema=schema)

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, h bigint, node bigint, n bigint, sketch binary")


def near_enough(pairs: DataFrame, described: DataFrame) -> DataFrame:
    """The pairs whose sketches do not rule them out: similar sets of a and b elements differ in (a + b) / 7 at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y, total = (c.to_pylist() for c in batch.columns)
            keep = [(PART + OF) * distance(p, q) <= (PART - OF) * n for p, q, n in zip(x, y, total, strict=True)]
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    own = described.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    left, right = (own.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "sketch_a", "sketch_b", F.col("n_a") + F.col("n_b"))
    return both.mapInArrow(run, "a bigint, b bigint")


def packed(words: np.ndarray, owner: np.ndarray, nodes: np.ndarray, sizes: np.ndarray) -> bytes:
    """A block: its nodes with their sizes once, then per signature six bytes and the node's place."""
    own, place = np.unique(owner, return_inverse=True)
    head = np.array([len(own), len(words)], dtype=np.int64).tobytes()
    plain = head + nodes[own].tobytes() + sizes[own].tobytes() + np.diff(place, prepend=0).astype(np.int32).tobytes()
    return np.array([len(plain), len(words)], dtype=np.int64).tobytes() + words.view(np.uint8).reshape(-1, 8)[:, :6].tobytes() + pa.compress(plain, codec="zstd", asbytes=True)


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures, nodes and sizes, row by row."""
    size, n = int.from_bytes(block[:8], "little"), int.from_bytes(block[8:16], "little")
    plain = pa.decompress(block[16 + 6 * n :], decompressed_size=size, codec="zstd", asbytes=True)
    count, rows = np.frombuffer(plain, np.int64, 2).tolist()
    nodes, sizes = np.frombuffer(plain, np.int64, count, 16), np.frombuffer(plain, np.int64, count, 16 + 8 * count)
    place = np.cumsum(np.frombuffer(plain, np.int32, rows, 16 + 16 * count))
    words = np.zeros((rows, 8), dtype=np.uint8)
    words[:, :6] = np.frombuffer(block, np.uint8, 6 * rows, 16).reshape(rows, 6)
    return words.view(np.uint64).ravel(), nodes[place], sizes[place]


def signature_blocks(docs: DataFrame, n_buckets: int, text_col: str) -> DataFrame:
    """bucket and blocks of signatures with their nodes; equal sets of a task are told once.

    A signature's remainder by the number of buckets is its bucket; 48 bits of its quotient go along.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        nodes: list[tuple[int, int]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            words = np.concatenate(held)
            owner = np.repeat(np.arange(len(held)), [len(h) for h in held])
            names, sizes = np.array([n[0] for n in nodes], np.int64), np.array([n[1] for n in nodes], np.int64)
            bucket, rest = words % np.uint64(n_buckets), words // np.uint64(n_buckets)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
            blocks = [packed(rest[order[a:b]], owner[order[a:b]], names, sizes) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]].astype(np.int64)), pa.array(blocks, pa.binary())], names=["bucket", "block"])

        for batch in batches:
            for shingles in shingle_sets(text_bytes(batch.column(0))):
                if not len(shingles) or (node := node_of(shingles)) in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(node)
                held.append(signatures(shingles))
                nodes.append((node, len(shingles)))
                size += held[-1].nbytes
                if size > BLOCK_BYTES:
                    yield flush()
                    held, nodes, size = [], [], 0
        if held:
            yield flush()

    return docs.select(text_col).mapInArrow(run, "bucket bigint, block binary")


def meet(blocks: pa.Table) -> pa.Table:
    """What a bucket's nodes have in common. kind 0: a and b are candidates. kind 1: a is among the crowd at signature b; n its size."""
    word, node, n = (np.concatenate(x) for x in zip(*(unpacked(b.as_py()) for b in blocks.column("block")), strict=True))
    order = np.lexsort((node, word))
    word, node, n = word[order], node[order], n[order]
    new = np.concatenate(([True], (word[1:] != word[:-1]) | (node[1:] != node[:-1])))
    word, node, n = word[new], node[new], n[new]
    cuts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1], [True])))
    width = np.diff(cuts)
    pairs: list[np.ndarray] = []
    near = lambda i, j: np.minimum(n[i], n[j]) * PART >= np.maximum(n[i], n[j]) * OF
    for size in np.unique(width[(width > 1) & (width <= HEAVY)]).tolist():
        begins = cuts[:-1][width == size]
        i, j = np.triu_indices(size, 1)
        left, right = (begins[:, None] + i).ravel(), (begins[:, None] + j).ravel()
        ok = near(left, right)
        pairs.append(np.stack((node[left[ok]], node[right[ok]])))
    crowd = np.flatnonzero(np.repeat(width > HEAVY, width))
    if len(crowd):
        lead, length = np.repeat(cuts[:-1], width)[crowd], np.repeat(width, width)[crowd]
        for hub in (lead, lead + length - 1):
            ok = (hub != crowd) & near(hub, crowd)
            a, b = node[hub[ok]], node[crowd[ok]]
            pairs.append(np.stack((np.minimum(a, b), np.maximum(a, b))))
    found = np.unique(np.concatenate(pairs, axis=1), axis=1) if pairs else np.empty((2, 0), dtype=np.int64)
    # a signature's quotient and its bucket together name it
    bucket = np.full(len(crowd), blocks.column("bucket")[0].as_py(), dtype=np.uint64)
    columns = [np.concatenate((found[0], node[crowd])), np.concatenate((found[1], mix(word[crowd] ^ (bucket << np.uint64(44))).view(np.int64))), np.concatenate((np.zeros(found.shape[1], dtype=np.int64), n[crowd]))]
    return pa.table([pa.array(c) for c in columns], names=["a", "b", "n"])


def of_nodes(docs: DataFrame, nodes: DataFrame, text_col: str, schema: str, each: Callable[[int, np.ndarray], list[tuple]]) -> DataFrame:
    """Rows that each makes of a node and its shingles, for the given nodes: those that a Bloom filter of fixed size lets through, then exactly them.

    A node can come from several tasks.
    """
    word = F.shiftright(F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS)), 5)
    bit = F.lit(1).cast("bigint") * F.pow(F.lit(2.0), F.pmod(F.xxhash64("node"), F.lit(32))).cast("bigint")
    filled = nodes.groupBy(word.alias("w")).agg(F.bit_or(bit).alias("bits")).toPandas()  # at most FILTER_BITS / 32 rows
    have = np.zeros(FILTER_BITS >> 5, dtype=np.int64)
    have[filled["w"].to_numpy(np.int64)] = filled["bits"].to_numpy(np.int64)
    sent = docs.sparkSession.sparkContext.broadcast(have.astype(np.uint32))
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.binary() if c.endswith("binary") else pa.list_(pa.int64()) if "array" in c else pa.int64() for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed, seen = sent.value, set()
        for batch in batches:
            rows: list[tuple] = []
            for shingles in shingle_sets(text_bytes(batch.column(0))):
                if not len(shingles):
                    continue
                node = node_of(shingles)
                at = spark_hash(node) % FILTER_BITS
                if node not in seen and int(passed[at >> 5]) >> (at & 31) & 1:
                    if len(seen) < 1_000_000:
                        seen.add(node)
                    rows += each(node, shingles)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return docs.select(text_col).mapInArrow(run, schema).join(nodes, "node", "left_semi")


def sets_of(docs: DataFrame, nodes: DataFrame, text_col: str) -> DataFrame:
    """node and its shingle hashes."""
    return of_nodes(docs, nodes, text_col, "node bigint, hashes binary", lambda node, s: [(node, s.tobytes())])


def shingles_of(docs: DataFrame, nodes: DataFrame, text_col: str) -> DataFrame:
    """node, n, shingles, lanes: the parity sketch in LANES words of 64 bits."""

    def each(node: int, s: np.ndarray) -> list[tuple]:
        flips = np.bincount((s % np.uint64(64 * LANES)).astype(np.int64), minlength=64 * LANES) & 1
        return [(node, len(s), s.view(np.int64).tolist(), np.packbits(flips.astype(np.uint8)).view(np.int64).tolist())]

    found = of_nodes(docs, nodes, text_col, "node bigint, n bigint, shingles array<bigint>, lanes array<bigint>", each)
    return found.dropDuplicates(["node"])


def spark_hash(value: int) -> int:
    """xxhash64 of a bigint, as Spark's function has it."""
    return xxhash.xxh64_intdigest((value & (2**64 - 1)).to_bytes(8, "little"), seed=42)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar indeed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(PART * both >= OF * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def checked(pairs: DataFrame, described: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """The links among candidate pairs: by sketch, then by the shingles of those that are left."""
    left = saved(near_enough(pairs, described), "left")
    nodes = left.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = saved(sets_of(docs, nodes, text_col).groupBy("node").agg(F.first("hashes").alias("hashes")), "sets")
    links = saved(verified(left, sets), "links")
    removed(left, sets)
    return links


def verified_among(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes of rows (node, shingles) whose sets are similar indeed."""
    left, right = (rows.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_shingles")) for c in "ab")
    both = F.size(F.array_intersect("a_shingles", "b_shingles"))
    either = F.size("a_shingles") + F.size("b_shingles") - both
    return pairs.join(left, "a").join(right, "b").where(both * PART >= either * OF).select("a", "b")


def similar_nodes(docs: DataFrame, described: DataFrame, text_col: str = "text") -> DataFrame:
    """Links (a, b) between nodes that make the same components as all links do."""
    n = buckets_for(docs)
    met = saved(signature_blocks(docs, n, text_col).groupBy("bucket").applyInArrow(meet, "a bigint, b bigint, n bigint"), "met")
    pairs = saved(met.where("n = 0").select("a", "b").distinct(), "pairs")
    links = checked(pairs, described, docs, text_col)
    crowds = met.where("n > 0")
    if crowds.isEmpty():
        return links
    # nodes of crowds that no uncrowded part is sure to join to what is similar to them
    least = F.floor(F.col("n") * OF / PART)  # the smallest partner, and with it the slack that both of a pair have
    slack = F.when(least < SLACK_FROM, 0).otherwise(3 + F.floor(least / 32))
    exposed = saved(crowds.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("crowded"), F.max("n").alias("n")).where(F.col("crowded") > slack).select("node"), "exposed")
    rows = saved(shingles_of(docs, exposed, text_col), "exposed-sets")
    rare = saved(rarest(rows), "rare")
    label = components(links)
    for turn in range(HUB_ROUNDS):
        new = saved(verified_among(hub_pairs(rare, rows, label, turn), rows), "hub-links")
        if new.isEmpty():
            break
        links = links.union(new)
        label = components(links)
    more = saved(rare_pairs(rare, rows, label).join(pairs, ["a", "b"], "left_anti"), "more")
    links = links.union(saved(verified_among(more, rows), "more-links"))
    removed(met, pairs, exposed, rows, rare, more)
    return links


def rarest(rows: DataFrame) -> DataFrame:
    """word, times, node, n, r: of each node (node, n, shingles) those of its first n - ceil(3/4 n) + 1 shingles, from the rarest up, that another node has too.

    times: how many of the nodes have the word. r: how many of the node's shingles are uncrowded. Similar sets share one of these words at least.
    """
    part = rows.select("node", "n", F.explode("shingles").alias("word"))
    # a written table, so that Spark may split a word that very many nodes have
    times = saved(part.groupBy("word").agg(F.count("*").alias("times")).where("times > 1"), "times")
    own = Window.partitionBy("node")
    counted = part.join(times.hint("merge"), "word", "left").withColumn("times", F.coalesce("times", F.lit(1)))
    ranked = counted.withColumns({"rank": F.row_number().over(own.orderBy("times", "word")), "r": F.sum((F.col("times") <= CROWD).cast("bigint")).over(own)})
    return ranked.where((F.col("rank") <= F.col("n") - F.ceil(F.col("n") * OF / PART) + 1) & (F.col("times") > 1)).select("word", "times", "node", "n", "r")


def labelled_words(rare: DataFrame, label: DataFrame) -> DataFrame:
    return rare.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))


def alike_in_size(a: str, b: str) -> Column:
    return F.least(a, b) * PART >= F.greatest(a, b) * OF


def alike_in_bits(a: str, b: str, n: Column) -> Column:
    """Whether two parity sketches of LANES words differ in no more bits than similar sets of n elements together may."""
    bits = reduce(Column.__add__, [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(LANES)])
    return (PART + OF) * bits <= (PART - OF) * n


def hub_pairs(rare: DataFrame, rows: DataFrame, label: DataFrame, turn: int) -> DataFrame:
    """Candidate pairs (a, b) of one node, the hub, of each crowded word with all nodes of other labels that have the word: as many as the crowd has nodes, not their square.

    The first hub is the node with the fewest uncrowded shingles, which stands in the middle of a group of near copies; later ones are drawn among
    the nodes outside the word's commonest label.
    """
    crowded = saved(labelled_words(rare.where(F.col("times") > CROWD), label), "crowded")
    first = F.struct("r", "node") if not turn else F.struct(F.xxhash64("node", F.lit(turn)).alias("r"), "node")
    by_label = crowded.groupBy("word", "label").agg(F.count("*").alias("k"), F.min_by(F.struct("node", "n", "label"), first).alias("best"), F.min(first).alias("first"))
    common = by_label.groupBy("word").agg(F.max_by("label", F.struct("k", "label")).alias("common"), F.count("*").alias("labels")).where("labels > 1")
    of_word = by_label.join(common, "word")
    of_word = of_word.where("label <> common") if turn else of_word
    hubs = saved(of_word.groupBy("word").agg(F.min_by("best", "first").alias("hub")).select("word", F.col("hub.node").alias("hub"), F.col("hub.n").alias("m"), F.col("hub.label").alias("hub_label")), "hubs")
    met = crowded.join(hubs.hint("merge"), "word").where((F.col("label") != F.col("hub_label")) & alike_in_size("n", "m"))
    pairs = met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"), (F.col("n") + F.col("m")).alias("total")).distinct()
    left, right = (rows.select(F.col("node").alias(c), F.col("lanes").alias(f"{c}_lanes")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").where(alike_in_bits("a_lanes", "b_lanes", F.col("total"))).select("a", "b")


def rare_pairs(rare: DataFrame, rows: DataFrame, label: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) among nodes of different labels that share a word of rare; no similar pair is left out.

    Where all that two nodes share there is crowded, each has all its uncrowded shingles there, and the other has none
    of them: with rx and ry uncrowded ones they differ in rx + ry at least, which has to stay within (nx + ny) / 7. So documents
    that have little but a passage in common make no pairs, nor do those whose sketches differ in too many bits. Of a word's nodes, those of its commonest label are not compared with each other.
    A pair is told at its first common word among the first FIRST_WORDS of both, or at each where there is none.
    """
    c = F.col
    named = saved(labelled_words(rare, label), "labelled")
    by_label = named.groupBy("word", "label").agg(F.count("*").alias("k"), F.min("r").alias("r")).groupBy("word").agg(F.max_by("label", F.struct("k", "label")).alias("common"), F.count("*").alias("labels"), F.min("r").alias("least_r"))
    words = saved(by_label.where("labels > 1").drop("labels"), "words")
    # 7 / 3 n is the most that a node of n and its partner have together
    may_have_a_partner = (c("times") <= CROWD) | ((PART + OF) * OF * (c("r") + c("least_r")) <= (PART - OF) * (PART + OF) * c("n"))
    first = rare.groupBy("node").agg(F.transform(F.slice(F.array_sort(F.collect_list(F.struct("times", "word"))), 1, FIRST_WORDS), lambda w: w["word"]).alias("first"))
    apart = named.join(words.hint("merge"), "word").where(may_have_a_partner).join(rows.select("node", "lanes"), "node").join(first, "node")
    apart = saved(apart, "apart")
    x = apart.where("label <> common").select("word", "times", *[c(k).alias(f"x_{k}") for k in ("node", "n", "r", "label", "lanes", "first")])
    y = apart.select("word", *[c(k).alias(f"y_{k}") for k in ("node", "n", "r", "label", "lanes", "first")], (c("label") == c("common")).alias("in_common"))
    apart_enough = (c("times") <= CROWD) | ((PART + OF) * (c("x_r") + c("y_r")) <= (PART - OF) * (c("x_n") + c("y_n")))
    shared = F.array_intersect("x_first", "y_first")
    told_here = (F.size(shared) == 0) | (F.get(shared, F.lit(0)) == c("word"))
    one_way = (c("x_label") != c("y_label")) & (c("in_common") | (c("x_node") < c("y_node")))
    met = x.join(y, "word").where(one_way & alike_in_size("x_n", "y_n") & apart_enough & alike_in_bits("x_lanes", "y_lanes", c("x_n") + c("y_n")) & told_here)
    return met.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def labelled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, h, node, n and label, the name of the component, of each document."""
    described = saved(describe(docs, id_col, text_col), "described")
    label = components(similar_nodes(docs, described, text_col))
    return described.drop("sketch").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the least id that links lead to), one row per document.

    Nulls and texts without words have no shingles, no links, and their own id. Repeated rows and equal texts are one node. A null id is left out
    of the minimum unless nothing else is there. Other columns are not looked at.
    """
    rows = saved(labelled(docs, id_col, text_col), "labelled")
    # a written table, so that Spark may split a group that holds very many documents
    least = saved(rows.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("component_id")), "least")
    out = rows.join(least, "label", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group: of its least id (null after all others) and, where texts share that, the least hash of the text; of repeated rows, one.

    Texts that links don't join all stay, whatever their ids; texts without words, nulls included, are groups of their own.
    """
    rows = saved(labelled(docs), "labelled")
    first = rows.where("n > 0").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "h")).alias("first"))
    first = saved(first.select("label", F.col("first.h").alias("first_h"), F.col("first.doc_id").alias("first_id")), "first")
    chosen = rows.join(first, "label", "left").where((F.col("n") == 0) | (F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("h") == F.col("first_h"))))
    kept = saved(chosen.groupBy(F.col("doc_id").alias("kept_id"), F.col("h").alias("kept_h")).agg((F.max("n") > 0).alias("has_words"), F.count("*").alias("times")), "kept")
    alike = docs["doc_id"].eqNullSafe(kept["kept_id"]) & (F.xxhash64(docs["text"]) == kept["kept_h"])
    single, repeated = (F.col("times") == 1) | ~F.col("has_words"), (F.col("times") > 1) & F.col("has_words")
    out = docs.join(kept.where(single).hint("merge"), alike, "left_semi")
    # of repeated rows, one: they are combined before the shuffle
    return out.unionByName(docs.join(kept.where(repeated), alike, "left_semi").dropDuplicates(["doc_id", "text"]))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"))
