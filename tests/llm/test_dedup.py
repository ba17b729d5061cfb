"""Substring, suffix-array and n-gram deduplication against plain versions."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import SF, documents, frame, groups, repeated, sha
from pyspark.sql.classic.dataframe import DataFrame

from rasterweave.llm import components, ngram_join, substring_dedup, suffix_dedup, superkmers
from rasterweave.llm.suffix_array import suffix_array
from rasterweave.llm.superkmers import Windows, super_kmers


def test_words_of_edge_cases(spark):
    docs = documents()
    units = [(t or "").encode().split() for _, t in docs]
    expected = Counter()
    for (doc_id, _), u, gone in zip(docs, units, repeated(units, 35), strict=True):
        expected[doc_id, len(u), sum(gone), b" ".join(w for w, g in zip(u, gone, strict=True) if not g)] += 1
    got = Counter((r.doc_id, r.n_words, sum(s.end - s.start for s in r.removed), bytes(r.kept)) for r in substring_dedup.remove_repeats(frame(spark)).collect())
    assert got == expected
    assert substring_dedup.remove_repeats(frame(spark, True)).count() == 0


def test_bytes_of_edge_cases(spark):
    docs = [(d, t if t is None or len(t) < 20_000 else t[:9000]) for d, t in documents()]
    units = [(t or "").encode() for _, t in docs]
    expected = Counter()
    for (doc_id, _), u, gone in zip(docs, units, repeated(units, 400), strict=True):
        expected[doc_id, len(u), sum(gone), bytes(gone).count(b"\0\1") + gone[:1].count(1), bytes(b for b, g in zip(u, gone, strict=True) if not g)] += 1
    rows = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = Counter((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.removed), len(r.removed), bytes(r.kept)) for r in suffix_dedup.remove_repeats(rows).collect())
    assert got == expected
    assert suffix_dedup.remove_repeats(frame(spark, True)).count() == 0


def test_groups_of_edge_cases(spark):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.groups(frame(spark)).collect())
    assert got == Counter(groups(documents()))
    assert ngram_join.groups(frame(spark, True)).count() == 0


def test_keep_one_of_each_group(spark):
    kept = [(r.doc_id, r.text) for r in ngram_join.keep_one(frame(spark)).collect()]
    expected = {d for d, _, c in groups(documents()) if d == c}
    assert {d for d, _ in kept if d is not None} == {d for d in expected if d is not None}
    assert len([d for d, _ in kept if d is not None]) == len({d for d, _ in kept if d is not None})
    assert (None, None) in kept and not any(d is None and t for d, t in kept)  # the text of a null id has copies with ids


def test_keep_one_where_ids_are_shared(spark):
    docs = [(5, "a text of its own that nothing is like"), (5, "quite another one with other words in it"), (None, "no id here but some words to tell"), (None, "no id there but others words to tell now"), (6, None), (6, None), (None, None)]
    docs += [(5, "a text of its own that nothing is like")] * 3 + [(9, "quite another one with other words in it")]
    kept = Counter(tuple(r) for r in ngram_join.keep_one(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)).collect())
    assert kept == Counter([*docs[:6], docs[6]])


def test_crowded_passages_and_many_near_copies(spark):
    """More documents share a passage, or are near copies, than a bucket compares pair by pair."""
    draw = random.Random(3)
    word = lambda: f"w{draw.randrange(5000)}"
    passage, base = [word() for _ in range(60)], [word() for _ in range(150)]
    docs = [(i, " ".join([word() for _ in range(draw.randint(20, 90))] + passage + [word() for _ in range(draw.randint(0, 30))])) for i in range(60)]
    for i in range(60, 130):
        own = list(base)
        for _ in range(draw.randint(0, 4)):
            own[draw.randrange(150)] = word()
        docs.append((i, " ".join(own)))
    rows = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.groups(rows).collect()) == Counter(groups(docs))


def test_query_groups(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.op5_ngram_jaccard(spark, SF).collect()) == Counter(groups(docs))


def test_query_words(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    units = [(t or "").encode().split() for _, t in docs]
    expected = Counter((d, len(u), sum(g), sha(b" ".join(w for w, x in zip(u, g, strict=True) if not x))) for (d, _), u, g in zip(docs, units, repeated(units, 35), strict=True))
    assert Counter(map(tuple, substring_dedup.op4_substring(spark, SF).collect())) == expected


def test_query_bytes(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    units = [(t or "").encode() for _, t in docs]
    expected = Counter((d, len(u), sum(g), bytes(g).count(b"\0\1") + g[:1].count(1), sha(bytes(b for b, x in zip(u, g, strict=True) if not x))) for (d, _), u, g in zip(docs, units, repeated(units, 400), strict=True))
    assert Counter(map(tuple, suffix_dedup.op8_suffix_array(spark, SF).collect())) == expected


@pytest.mark.parametrize("size", [399, 400, 401])
def test_passages_of_over_50_words_go_from_400_bytes_on(spark, size):
    """A passage of 60 words in two documents: bytes go from a window of 400 on, words in any case; n_bytes is the length of the input, whatever goes."""
    words = [f"w{i:04}" for i in range(60)]
    passage = " ".join(words[:-1]) + " " + "x" * (size - 6 * 59)
    docs = [(1, f"one\n{passage}\nend"), (2, f"two {passage} fin"), (3, "a clean one " * 2)]
    rows = spark.createDataFrame(docs, "doc_id bigint, text string")
    gone = {1: [(4, 4 + size)], 2: [(4, 4 + size)], 3: []} if size >= 400 else {1: [], 2: [], 3: []}
    found = suffix_dedup.remove_repeats(rows).collect()
    assert {r.doc_id: [tuple(s) for s in r.removed] for r in found} == gone
    assert {r.doc_id: r.n_bytes for r in found} == {d: len(t.encode()) for d, t in docs}
    assert {r.doc_id: [tuple(s) for s in r.removed] for r in substring_dedup.remove_repeats(rows).collect()} == {1: [(1, 61)], 2: [(1, 61)], 3: []}


@pytest.mark.parametrize("window", [1, 20, 250, 400])
def test_planted_passages_go_by_their_bytes(spark, window):
    """Passages of 51 to 90 words, each planted in two documents: with a window of 250 bytes all go, with the query's 400 those that have as many; clean documents keep all."""
    draw = random.Random(8)
    words = lambda n: " ".join("".join(draw.choices("etaoins", k=draw.randint(2, 9))) for _ in range(n))
    passages = [words(n) for n in range(51, 91)]
    docs = [(2 * i + j, f"{words(30)} <{i}{j}>{p}<{j}{i}> {words(30)}") for i, p in enumerate(passages) for j in range(2)] + [(100 + i, words(90)) for i in range(10)]
    found = {r.doc_id: r.removed for r in suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string"), window).collect()}
    units = [t.encode() for _, t in docs]
    assert {d: sum(s.end - s.start for s in r) for d, r in found.items()} == {d: sum(g) for (d, _), g in zip(docs, repeated(units, window), strict=True)}
    if window >= 250:
        assert {d for d, r in found.items() if r} == {2 * i + j for i, p in enumerate(passages) for j in range(2) if len(p) + 2 >= window}  # > and < beside it recur too


@pytest.mark.parametrize("letters", [1, 2, 3, 26])
def test_suffix_array_is_the_sorted_order(letters):
    draw = random.Random(letters)
    for _ in range(300):
        s = [draw.randint(1, letters) for _ in range(draw.randint(0, 50))] + [0]
        assert suffix_array(np.array(s)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("kind,judge", [(Windows(False, 40, (16, 24, 32)), suffix_dedup.by_suffixes(40)), (Windows(True, 6, (2, 4)), substring_dedup.counted(6))])
def test_judges_on_random_texts(kind, judge):
    draw = random.Random(11)
    for _ in range(200):
        base = [b"".join(draw.choice([b"a", b"b", b" ", b"c", b"  ", b"\n"]) for _ in range(draw.randint(1, 160))) for _ in range(3)]
        texts = []
        for _ in range(draw.randint(1, 6)):
            x = draw.choice(base)
            i = draw.randint(0, len(x))
            texts.append(draw.choice([x, x[i:], x[:i] + b"x" + x[i:], x + x, b"ab" * draw.randint(0, 60), b"", b"q" * draw.randint(0, 90)]))
        held, places = {}, []
        for runs in super_kmers(texts, kind):
            for d, s, m, p in zip(runs.doc.tolist(), runs.start.tolist(), runs.minimiser.tolist(), runs.packed, strict=True):
                held.setdefault(p, [m, 0])[1] += 1
                places.append((d, s, p))
        flags = dict(zip(held, judge(list(held), np.array([v[1] for v in held.values()]), np.array([v[0] for v in held.values()], dtype=np.uint64)), strict=True))
        got = {(d, s + i) for d, s, p in places if flags[p] is not None for i in np.flatnonzero(flags[p]).tolist()}
        units = [t.split() if kind.words else t for t in texts]
        counts = Counter(tuple(u[i : i + kind.size]) for u in units for i in range(len(u) - kind.size + 1))
        assert got == {(d, i) for d, u in enumerate(units) for i in range(len(u) - kind.size + 1) if counts[tuple(u[i : i + kind.size])] > 1}


@pytest.mark.parametrize("kind,judge", [(Windows(False, 40, (16, 24, 32)), suffix_dedup.by_suffixes(40)), (Windows(True, 12, (4, 8, 11)), substring_dedup.counted(12))])
def test_common_phrases_make_no_large_group(spark, monkeypatch, kind, judge):
    """A phrase shorter than a window, with different text around it, and whole windows that repeat."""
    monkeypatch.setattr(superkmers, "HOT_BYTES", 2500)
    monkeypatch.setattr(superkmers, "SAMPLED", 1)
    draw = random.Random(9)
    word = lambda: f"v{draw.randrange(5000)}"
    phrase, passage = " ".join(word() for _ in range(6)), " ".join(word() for _ in range(20))
    docs = [" ".join([*(word() for _ in range(draw.randint(5, 20))), phrase, *(word() for _ in range(draw.randint(5, 20)))]) for _ in range(200)]
    docs += [f"{word()} {phrase} {passage} {phrase} {word()}" for _ in range(20)] + docs[:5] + ["", "a  b"]

    def bounded(strings, counts, minimisers):
        size = Counter()
        for s, m in zip(strings, minimisers.tolist(), strict=True):
            size[m] += len(s)
        assert not size or max(size.values()) <= 2500
        return judge(strings, counts, minimisers)

    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").repartition(3).selectExpr("text", "doc_id", "xxhash64(text) h")
    units = [t.encode().split() if kind.words else t.encode() for t in docs]
    got = {r.doc_id: superkmers.merged(r.spans) for r in superkmers.repeats(rows, kind, bounded).collect()}
    assert {d: [any(a <= i < b for a, b in got[d]) for i in range(len(u))] for d, u in enumerate(units)} == {d: list(map(bool, g)) for d, g in enumerate(repeated(units, kind.size))}


@pytest.mark.parametrize("limit,levels", [(-1, 3), (400, 1), (2000, 1), (1 << 40, 0)])
@pytest.mark.parametrize("kind,judge", [(Windows(False, 40, (16, 24, 32)), suffix_dedup.by_suffixes(40)), (Windows(True, 12, (4, 8, 11)), substring_dedup.counted(12))])
def test_heat_changes_where_windows_meet_and_nothing_else(spark, monkeypatch, kind, judge, limit, levels):
    """Every counter hot at every length, some hot at some, none: the same spans; and hot windows still go to buckets as long as a longer minimiser tells them apart."""
    monkeypatch.setattr(superkmers, "HOT_BYTES", limit)
    monkeypatch.setattr(superkmers, "SAMPLED", 1)
    draw = random.Random(21)
    word = lambda: f"w{draw.randrange(300)}"
    phrase, passage = " ".join(word() for _ in range(5)), " ".join(word() for _ in range(30))
    docs = [f"{' '.join(word() for _ in range(draw.randint(3, 30)))} {phrase} {' '.join(word() for _ in range(draw.randint(3, 30)))} {passage if i % 9 == 0 else ''}" for i in range(90)]
    rows = spark.createDataFrame(list(enumerate([*docs, docs[3], "", "a"])), "doc_id bigint, text string").repartition(3).selectExpr("text", "doc_id", "xxhash64(text) h")
    hot = superkmers.hot_minimisers(rows.select("text"), kind, 8)
    assert len(hot.maps) >= levels if levels else not hot.maps
    for runs in superkmers.super_kmers([t.encode() for t in docs], kind, hot):
        for level in set(runs.level.tolist()) - {len(kind.grams)}:
            assert level <= len(hot.maps) and not (level < len(hot.maps) and hot.has(level, runs.minimiser[runs.level == level]).any())
    units = [(t or "").encode().split() if kind.words else t.encode() for t in [*docs, docs[3], "", "a"]]
    got = {r.doc_id: superkmers.merged(r.spans) for r in superkmers.repeats(rows, kind, judge).collect()}
    assert {d: [any(a <= i < b for a, b in got[d]) for i in range(len(u))] for d, u in enumerate(units)} == {d: list(map(bool, g)) for d, g in enumerate(repeated(units, kind.size))}


def test_hot_windows_meet_once_a_part(spark, monkeypatch):
    """Copies, and one passage inside many different texts: windows are hashed for different strings alone, and what meets doesn't grow with the crowd."""
    monkeypatch.setattr(superkmers, "HOT_BYTES", -1)
    monkeypatch.setattr(superkmers, "SAMPLED", 1)
    draw = random.Random(4)
    word = lambda: f"w{draw.randrange(9000)}"
    copied, passage = " ".join(word() for _ in range(80)), " ".join(word() for _ in range(20))
    docs = [copied] * 60 + [f"{word()} {word()} {passage} {word()} {word()}" for _ in range(60)]
    kind, judge, plain = Windows(False, 40, (16, 24, 32)), suffix_dedup.by_suffixes(40), superkmers.windows_of
    hashed, joins, join = spark.sparkContext.accumulator(0), [], DataFrame.join

    def told(packed, kind):
        hashed.add(len(packed) - kind.size + 1)
        return plain(packed, kind)

    def joined(self, other, on=None, how=None):
        out = join(self, other, on, how)
        if isinstance(on, str) and on == "window":
            joins.append(out)
        return out

    monkeypatch.setattr(superkmers, "windows_of", told)
    monkeypatch.setattr(DataFrame, "join", joined)
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").repartition(3).selectExpr("text", "doc_id", "xxhash64(text) h")
    units = [t.encode() for t in docs]
    got = {r.doc_id: superkmers.merged(r.spans) for r in superkmers.repeats(rows, kind, judge).collect()}
    assert {d: [any(a <= i < b for a, b in got[d]) for i in range(len(u))] for d, u in enumerate(units)} == {d: list(map(bool, g)) for d, g in enumerate(repeated(units, 40))}
    windows = {u[i : i + 40] for u in units for i in range(len(u) - 39)}
    assert hashed.value <= 2.5 * (len(windows) + 60 * len(passage))  # before: copies as well
    assert sum(j.count() for j in joins) < 60 * len(passage) / 2


def test_parity_distance_never_exceeds_the_difference():
    draw = np.random.default_rng(5)
    for n in (5, 40, 700):
        a = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[: n // 2], draw.integers(0, 1 << 63, 2 * n, dtype=np.uint64))))
        assert 0 < ngram_join.distance(ngram_join.parity(a), ngram_join.parity(b)) <= len(np.setxor1d(a, b))


def test_parts_suffice_for_every_similar_pair():
    for n in range(1, 3000):
        known = dict(ngram_join.bands_of(n))
        for m in range(-(-3 * n // 4), n + 1):
            band = m.bit_length() - 1
            assert min(known[band], dict(ngram_join.bands_of(m))[band]) > (n + m) // 7


def test_components_of_a_long_chain(spark):
    links = spark.range(300).selectExpr("id * 7 % 301 a", "(id + 1) * 7 % 301 b")
    assert {r.label for r in components.components(links).collect()} == {0}
    assert components.components(links.limit(0)).count() == 0
