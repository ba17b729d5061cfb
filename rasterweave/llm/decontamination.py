"""Benchmark decontamination with a generalised suffix automaton.

The items' words form one automaton; a document's words stream through it and the length of the longest match
that ends at each word is tracked. Where it reaches a window's length, the window's words are hit.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.llm.common import saved, table, text_bytes

#: Bytes to bytes: A-Z to a-z; everything that is not a letter, a digit or beyond ASCII to a space.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SPANS = "array<struct<start:int,end:int>>"
#: Text of a block of items. Its automaton takes some hundred times that in a worker.
MOST_BYTES = 2 << 20


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class Automaton:
    """Generalised suffix automaton over word numbers.

    items: (name, words). A state stands for a set of word sequences that end at the same places; link leads to the
    longest of its suffixes that ends at more places. found[state] lists the items of the window that is the
    state's suffix of window words, short[state] the (length, name) of whole short items among its suffixes.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.numbers = window, {}
        self.step, self.link, self.size = [{}], [-1], [0]
        rows = [(name, [self.numbers.setdefault(w, len(self.numbers)) for w in words]) for name, words in items if words]
        for _, row in rows:
            state = 0
            for symbol in row:
                state = self._extend(state, symbol)
        self.found: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for name, row in rows:
            state = 0
            for i, symbol in enumerate(row):
                state = self.step[state][symbol]
                if i + 1 >= window:
                    state = self.up_to(state, window)
                    self.found.setdefault(state, set()).add(name)
            if len(row) < window:
                self.short.setdefault(self.up_to(state, len(row)), []).append((len(row), name))
        self.least = min([window, *(n for own in self.short.values() for n, _ in own)])
        if self.short:
            for state in sorted(range(len(self.size)), key=self.size.__getitem__)[1:]:
                if above := self.short.get(self.link[state]):
                    self.short[state] = self.short.get(state, []) + above

    def _add(self, step: dict, link: int, size: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _split(self, parent: int, symbol: int) -> int:
        """The state that parent followed by symbol is the longest sequence of."""
        target = self.step[parent][symbol]
        if self.size[target] == self.size[parent] + 1:
            return target
        twin = self._add(dict(self.step[target]), self.link[target], self.size[parent] + 1)
        self.link[target] = twin
        while parent >= 0 and self.step[parent].get(symbol) == target:
            self.step[parent][symbol] = twin
            parent = self.link[parent]
        return twin

    def _extend(self, last: int, symbol: int) -> int:
        if symbol in self.step[last]:
            return self._split(last, symbol)
        new, at = self._add({}, 0, self.size[last] + 1), last
        while at >= 0 and symbol not in self.step[at]:
            self.step[at][symbol] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, symbol)
        return new

    def up_to(self, state: int, size: int) -> int:
        """The state of the suffix of size words."""
        while self.size[self.link[state]] >= size:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal runs of hit words, as (start, end), and the items whose windows occur."""
        numbers = np.fromiter(map(self.numbers.get, words, [-1] * len(words)), dtype=np.int64, count=len(words))
        edge = np.diff(np.concatenate(([False], numbers >= 0, [False])).astype(np.int8))
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        step, link, size, window = self.step, self.link, self.size, self.window
        for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
            if end - begin < self.least:
                continue
            state = length = 0
            for at, symbol in enumerate(numbers[begin:end].tolist(), begin + 1):
                while state and symbol not in step[state]:
                    state = link[state]
                    length = size[state]
                if symbol in step[state]:
                    state = step[state][symbol]
                    length += 1
                hit = 0
                if length >= window:
                    hit = window
                    items |= self.found[self.up_to(state, window)]
                for n, name in self.short.get(state, ()):
                    if n <= length:
                        hit = max(hit, n)
                        items.add(name)
                if hit:
                    first = at - hit
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append((first, at))
        return spans, items


_kept: dict[str, Automaton] = {}


def automaton_of(name: str, sent: Broadcast, window: int) -> Automaton:
    """A block's automaton, built in the task that needs it and kept for the worker's next task."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = Automaton([(i, words_of(t)) for i, t in sent.value], window)
    return _kept[name]


def item_blocks(items: DataFrame, id_col: str, text_col: str, most_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of about most_bytes, one at a time. An item is not split. Without items there is one empty block."""
    total = items.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = -(-total // most_bytes) or 1
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("i"), F.col(text_col).alias("t"))
    for k in range(n):
        yield [(r.i, (r.t or "").encode()) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect()]


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the words that spans cover."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def marked(docs: DataFrame, items: DataFrame, window: int, item_id_col: str, item_text_col: str, most_bytes: int) -> DataFrame:
    """docs (text, row: a struct) with n_words, spans and found. Every block of items meets every document in a pass of its own, which adds to what the passes before have found; a pass is written before the next."""
    spark, schema = docs.sparkSession, docs.select("text", "row", F.lit(0).cast("bigint").alias("n_words"), F.expr(f"cast(array() as {SPANS})").alias("spans"), F.expr("cast(array() as array<string>)").alias("found")).schema
    out = docs.select("text", "row", F.lit(0).cast("bigint").alias("n_words"), F.expr(f"cast(array() as {SPANS})").alias("spans"), F.expr("cast(array() as array<string>)").alias("found"))
    for turn, block in enumerate(item_blocks(items, item_id_col, item_text_col, most_bytes)):
        out = saved(out, "marked") if turn else out

        def run(batches: Iterator[pa.RecordBatch], name=uuid.uuid4().hex, sent=spark.sparkContext.broadcast(block)) -> Iterator[pa.RecordBatch]:
            automaton = automaton_of(name, sent, window)
            for batch in batches:
                counts, spans, found = [], [], []
                for text, before, names in zip(text_bytes(batch.column(0)), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                    own, items = automaton.scan(words := words_of(text))
                    counts.append(len(words))
                    spans.append([{"start": a, "end": b} for a, b in joined_spans([*((s["start"], s["end"]) for s in before), *own])])
                    found.append(sorted({*names, *items}))
                columns = [pa.array(x, batch.schema.field(k).type) for k, x in ((2, counts), (3, spans), (4, found))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=batch.schema.names)

        out = out.mapInArrow(run, schema)
    return out


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", most_bytes: int = MOST_BYTES) -> DataFrame:
    """doc_id, n_words, spans of hit words (start, end), items whose windows occur, one row per document.

    window: words of a window; an item of fewer words is one window as a whole. Nulls and texts without words hit
    nothing; an item with null id is named "null"; repeated documents each get their row; items of one id count as
    one. Without items or documents the result has no hits or no rows. Other columns are not looked at.
    The items are the stated query set: they meet the documents in blocks of most_bytes.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.struct(F.col(id_col).cast("bigint").alias("doc_id")).alias("row"))
    found = marked(rows, items, window, item_id_col, item_text_col, most_bytes)
    return found.select("row.doc_id", "n_words", "spans", F.col("found").alias("items"))


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans."""
    places = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, text[at:]])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, most_covered: float = 0.5, most_bytes: int = MOST_BYTES) -> DataFrame:
    """docs without the item passages: hit spans are cut out of the text, and documents of which they cover more than most_covered go.

    Clean documents, null texts included, pass unchanged. n_chars, where there is one, follows the text.
    """
    rest = [c for c in docs.columns if c != "text"]
    found = marked(docs.select("text", F.struct(*rest).alias("row")), items, window, "item_id", "text", most_bytes)

    @F.pandas_udf("string")
    def without(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or not len(s) else cut(t.encode(), [(x["start"], x["end"]) for x in s]).decode() for t, s in zip(texts, spans, strict=True)], dtype=object)

    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s.end - s.start)
    left = found.where(hit <= F.col("n_words") * most_covered).withColumn("kept", without("text", "spans"))
    own = {c: F.col("row").getField(c) for c in rest} | {"text": F.col("kept")}
    if "n_chars" in own:
        own["n_chars"] = F.when(F.col("kept").isNull(), own["n_chars"]).otherwise(F.length("kept").cast(docs.schema["n_chars"].dataType))
    return left.select(*[own[c].alias(c) for c in docs.columns])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s.end - s.start)
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )
