"""Fingerprints, language-model scores, quality and mixing."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
from llm_cases import SF, documents, frame, sha
from pyspark.sql import functions as F

from rasterweave.llm import fingerprint, lm_scoring, mixing, quality


def test_fingerprints_of_edge_cases(spark):
    rows = fingerprint.fingerprints(frame(spark)).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((d, t or "") for d, t in documents())
    assert len({r.text for r in rows}) == len({r.fingerprint for r in rows}) == len({(r.text, r.fingerprint) for r in rows})
    assert fingerprint.fingerprints(frame(spark, True)).count() == 0


def test_next_goes_round_in_descending_order(spark):
    for ids in ([5], [3, 1, 2], [10, -4, 1 << 60, 7, None, 8], [None, 1, 2, 7], [-(1 << 63), (1 << 63) - 1]):
        rows = spark.createDataFrame([(i, f"t{i}", i, i, i, i) for i in ids], "doc_id bigint, text string, key bigint, half bigint, row bigint, following bigint")
        order = sorted(ids, key=lambda i: (i is None, 0 if i is None else -i))
        got = {r.doc_id: (r.key, r.half, r.row, r.following.text) for r in fingerprint.with_next(rows, "doc_id", ["text"]).collect()}
        assert got == {d: (d, d, d, f"t{order[(k + 1) % len(order)]}") for k, d in enumerate(order)}
    many = spark.range(0, 60_000, 3).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    wrong = fingerprint.with_next(many, "doc_id", ["text"]).where("following.text <> cast(if(doc_id = 0, 59997, doc_id - 3) as string)")
    assert wrong.isEmpty()


def test_next_among_clustered_and_repeated_ids(spark, monkeypatch):
    """A third of the rows have one id, and others are close together or far apart: no bucket takes many rows."""
    monkeypatch.setattr(fingerprint, "ROWS_IN_BUCKET", 64)
    ids = [None] * 1500 + [7] * 1500 + list(range(1000, 2500)) + [k << 40 for k in range(1, 400)]
    docs = [(d, f"{k}") for k, d in enumerate(ids)]
    rows = fingerprint.with_next(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4), "doc_id", ["text"])
    out = [(r.doc_id, r.text, r.following.text) for r in rows.collect()]
    after, id_of = {t: n for _, t, n in out}, {t: d for d, t, _ in out}
    assert sorted(after) == sorted(t for _, t in docs) == sorted(after.values())  # one round through all rows
    low = lambda d: -(1 << 63) if d is None else d
    assert sum(low(id_of[t]) < low(id_of[n]) for t, n in after.items()) == 1
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    rows = fingerprint.with_next(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4), "doc_id", ["text"])
    assert rows.rdd.mapPartitions(lambda x: [sum(1 for _ in x)]).max() < 1000
    for k, v in before.items():
        spark.conf.set(k, v)


def leaf_lengths(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", fingerprint.paragraphs(F.col("text")).alias("p"))
    return {r.i: r.p for r in rows.collect()}


def test_paragraphs_make_up_the_text(spark):
    draw = np.random.default_rng(3)
    texts = ["".join(draw.choice(list("ab. \n!漢"), n)) for n in (1, 30, 300, 3000)] + ["漢" * 8000, "word " * 900, "x" * 1000 + " y. " * 9, "", "a.\nb", "".join(f"w{i} " for i in range(3000)), "😀" * 700]
    got = leaf_lengths(spark, texts)
    for i, t in enumerate(texts):
        assert "".join(got[i]) == t and all(0 < len(p) <= fingerprint.LONG for p in got[i])
    before, after = (leaf_lengths(spark, [t])[0] for t in (texts[9], "in front of " + texts[9]))
    assert len(set(before) & set(after)) > 0.9 * len(before)  # cuts of long paragraphs move along
    unspaced = "".join(chr(0x4E00 + int(x)) for x in draw.integers(0, 3000, 4000))
    before, front, inside = leaf_lengths(spark, [unspaced, "了" + unspaced, unspaced[:2000] + "了" + unspaced[2000:]]).values()
    assert "".join(before) == unspaced and min(len(set(before) & set(x)) for x in (front, inside)) > 0.9 * len(before)
    assert all(len(leaf_lengths(spark, [x * 8000])[0]) == 63 for x in "漢x")


def test_likeness_and_edits_against_plain_versions(spark):
    draw = np.random.default_rng(5)
    pairs = []
    for n in (0, 1, 5, 40, 400):
        a = [f"s{draw.integers(0, 60)} and so." for _ in range(n)]
        for _ in range(6):
            b, i, j = list(a), *sorted(draw.integers(0, n + 1, 2).tolist())
            b[i:j] = [f"new {draw.integers(0, 9)}!" for _ in range(draw.integers(0, 4))]
            pairs.append((" ".join(a), " ".join(b)))
    pairs += [("line\n" * 1000, "line\n" * 500 + "x" * 2500), ("line\n" * 1000, "line\n"), ("", "a"), ("", "")]
    c, told = F.col, lambda x: fingerprint.told_apart(fingerprint.paragraphs_of(F.col(f"s{x}")))
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    rows = rows.select("i", *[fingerprint.paragraphs(c(x)).alias(f"l{x}") for x in "ab"], *[fingerprint.fingerprint(fingerprint.section_strings(c(x))).alias(f"p{x}") for x in "ab"])
    rows = rows.withColumns({f"s{x}": fingerprint.sections_of(c(f"p{x}")) for x in "ab"})
    rows = rows.withColumns({f"t{x}": told(x) for x in "ab"}).withColumn("edit", fingerprint.edit(c("sa"), c("sb")))
    for r in rows.select("*", fingerprint.likeness(c("pa"), c("pb"), c("ta"), c("tb")).alias("near"), "edit.start", "edit.end").collect():
        a, b = pairs[r.i]
        both = Counter(r.la) & Counter(r.lb)
        assert abs(r.near - (1.0 if a == b else sum(len(p) * k for p, k in both.items()) / max(len(a), len(b), 1))) < 1e-12
        assert (r.pa == r.pb) == (a == b)
        first = next((k for k, (x, y) in enumerate(zip(r.la, r.lb, strict=False)) if x != y), min(len(r.la), len(r.lb)))
        assert r.start == sum(map(len, r.lb[:first])) and r.start <= r.end <= len(b)
        assert a[: r.start] == b[: r.start] and a[len(a) - (len(b) - r.end) :] == b[r.end :]


def test_query_fingerprints(spark):
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()), reverse=True)
    rows = {r.doc_id: r for r in fingerprint.op1_fingerprint(spark, SF).collect()}
    assert len(rows) == len(docs)
    leaves = leaf_lengths(spark, [t for _, t in docs])
    for i, (doc_id, text) in enumerate(docs):
        half, following, r = len(text) // 2, (i + 1) % len(docs), rows[doc_id]
        edited = text[: len(text) - half] + docs[following][1][:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha(edited))
        near = sum(len(p) * k for p, k in (Counter(leaves[i]) & Counter(leaves[following])).items()) / max(len(text), len(docs[following][1]), 1)
        assert abs(r.near_next - (1 if text == docs[following][1] else near)) < 1e-12 and 0 <= r.near_edited <= 1
        assert len(text) - half - fingerprint.LONG <= r.edit_start <= r.edit_end <= len(edited) and text[: r.edit_start] == edited[: r.edit_start]
        if len(text) > 4000:
            assert 0.4 < r.near_edited
    assert len({t for _, t in docs}) == len({r.fingerprint for r in rows.values()})


def lm_truth(docs):
    tokens = [((t or "").encode().lower().split() + [b""]) for _, t in docs]
    held = [d is None or zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs]
    counts = Counter(w for own, h in zip(tokens, held, strict=True) if not h for w in own)
    n, v = sum(counts.values()), len(counts)
    return [(d, h, len(own), sum(counts[w] > 0 for w in own), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), 6)) for (d, _), own, h in zip(docs, tokens, held, strict=True)]


def test_lm_base_of_edge_cases(spark):
    got = lm_scoring.score(frame(spark)).collect()
    assert Counter((*r[:5], round(r.base_score, 6)) for r in got) == Counter(lm_truth(documents()))
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lm_scoring.score(frame(spark, True)).count() == 0


def test_lm_without_training_rows(spark):
    rows = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id bigint, text string")
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9)) for r in lm_scoring.score(rows).collect()) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]


def test_lm_training_learns_from_every_position_once(spark, monkeypatch):
    seen, saved = [], lm_scoring.saved

    def kept(rows, name):
        out = saved(rows, name)
        seen.extend([out] if name == "parameters" else [])
        return out

    monkeypatch.setattr(lm_scoring, "saved", kept)
    texts = spark.createDataFrame([("a b c " * n,) for n in (1, 0, 30, 90, 400, 7)], "text string").repartition(2)
    vocab = lm_scoring.vocabulary(lm_scoring.token_counts(texts))
    lm_scoring.trained(texts, vocab)
    assert sum(r.weight for rows in seen for r in rows.collect()) == vocab.tokens == 3 * 528 + 6


def test_lm_own_classes_grow_with_the_vocabulary(spark):
    counts = spark.range(640_000).select(F.col("id").cast("string").cast("binary").alias("word"), (F.col("id") + 1).alias("c"))
    assert lm_scoring.vocabulary(counts).own == 1600
    assert lm_scoring.vocabulary(counts.limit(2000)).own == lm_scoring.OWN_LEAST


def test_the_most_frequent_tokens(spark):
    counts = spark.createDataFrame([(f"w{i}".encode(), 1 + 5000 // (i + 1)) for i in range(3000)], "word binary, c bigint").repartition(3)
    for most in (40, 700, 5000):
        top = [(r.c, bytes(r.word)) for r in lm_scoring.most_frequent(counts, most)]
        rest = sorted(((r.c, bytes(r.word)) for r in counts.collect()), key=lambda x: (-x[0], x[1]))
        assert 0.5 * min(most, 3000) < len(top) <= most and top == rest[: len(top)]
    assert len(lm_scoring.most_frequent(counts.withColumn("c", F.lit(1)), 10)) == 10


def test_lm_beats_its_base_on_held_out_texts(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = lm_scoring.op2_lm_scoring(spark, SF).collect()
    assert Counter((*r[:5], round(r.base_score, 6)) for r in rows) == Counter(lm_truth(docs))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_summed_rows_and_stable_order():
    draw = np.random.default_rng(2)
    rows, scale = draw.standard_normal((40, 3)), draw.standard_normal((lm_scoring.CONTEXT, 3))
    assert np.allclose(lm_scoring.summed(rows, scale), np.einsum("njw,jw->nw", lm_scoring.windows(rows), scale))
    for most in (50, 1 << 16, 1 << 40):
        numbers = draw.integers(0, most, 500) // 7 * 7
        assert (lm_scoring.by_number(numbers) == np.argsort(numbers, kind="stable")).all()


def test_class_probabilities_add_up():
    frequency = np.arange(20, 0, -1) / 210
    bounds = lm_scoring.grouped(frequency)
    parameters = [10 * x for x in lm_scoring.initial(frequency, bounds)]
    size = lm_scoring.CONTEXT
    context = np.arange(size)
    total = sum(10 ** lm_scoring.class_logs(parameters, bounds, np.append(context, k), np.array([size]))[0] for k in range(20))
    assert len(bounds) == 5 and abs(total - 1) < 1e-5
    parameters[5][0] = 1e4  # scores beyond the numbers
    assert abs(sum(10 ** lm_scoring.class_logs(parameters, bounds, np.append(context, k), np.array([size]))[0] for k in range(20)) - 1) < 1e-5


def test_within_a_shape_tokens_and_the_unknown_add_up(spark):
    texts = spark.createDataFrame([("a b c zz yy xx zz 1 2 é",), ("a a q,",)], "text string")
    vocab = lm_scoring.vocabulary(lm_scoring.token_counts(texts), own=3)
    counts = {bytes(r.word): r.c for r in lm_scoring.token_counts(texts).collect()}
    assert vocab.own == 3
    for k in vocab.shapes.tolist():
        own = [c for w, c in counts.items() if vocab.look_up([w])[1][0] == k]
        assert abs(vocab.mass[k] - (sum(own) + 0.1 * (len(own) + 1))) < 1e-9


def test_scores_against_plain_sums(spark):
    """Every text's score, token by token and class by class, from the trained parameters."""
    docs = [(i, " ".join(f"w{(i * k * k) % 41}" for k in range(i % 23)) + (" Odd%d" % i) * (i % 3)) for i in range(120)]
    rows = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    learning = rows.where("crc32(cast(doc_id as string)) % 10 <> 0").select("text")
    counts = {bytes(r.word): r.c for r in lm_scoring.token_counts(learning).collect()}
    vocab = lm_scoring.vocabulary(lm_scoring.token_counts(learning))
    e, c, q, b, u, a = (x.astype(float) for x in lm_scoring.trained(learning, vocab))
    got = {r.doc_id: r.score for r in lm_scoring.score(rows).collect()}
    for doc_id, text in docs:
        words = [*text.encode().lower().split(), b""]
        size = lm_scoring.CONTEXT
        classes = [len(vocab.frequency)] * size + vocab.look_up(words)[1].tolist()
        total = 0.0
        for i, w in enumerate(words, size):
            h = sum(e[classes[i - j - 1]] * c[j] for j in range(size))
            k = classes[i]
            g = max(x for x in range(len(vocab.bounds) - 1) if vocab.bounds[x] <= k)
            low, high = vocab.bounds[g], vocab.bounds[g + 1]
            total += math.log10(math.exp(h @ u[g] + a[g]) / np.exp(u @ h + a).sum() * math.exp(h @ q[k] + b[k]) / np.exp(q[low:high] @ h + b[low:high]).sum())
            if k in vocab.shapes:
                total += math.log10((counts.get(w, 0) + 0.1) / vocab.mass[k])
        assert abs(got[doc_id] - total) < 1e-3 * max(1, -total)


def test_quality_of_edge_cases(spark):
    docs = frame(spark)
    labels = spark.createDataFrame([(i, 1 if i % 2 else 0, None) for i in range(20)] + [(None, 1, 0), (5, None, 1)], "doc_id bigint, quality int, toxic int")
    featured = quality.featurise(docs)
    rows = quality.scored(featured, quality.train(featured, labels)).collect()
    assert len(rows) == len(documents()) and all(0 <= r.score <= 1 for r in rows)
    empty = quality.featurise(frame(spark, True))
    assert quality.scored(empty, quality.train(empty, labels)).count() == 0
    model = quality.train(featured, labels.limit(0))
    assert {r.score for r in quality.scored(featured, model).collect()} == {0.5}
    assert quality.keep_good(docs, model, 0.4).count() == len(documents()) and quality.keep_good(docs, model, 0.6).count() == 0


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    scored = quality.op7_quality(spark, sf).where("held_out")
    joined = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in joined) / len(joined) > 0.95


def test_quality_is_fitted_on_the_rows_of_least_hash(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append((x[:, 0].tolist(), y.tolist())))
    ids = [*range(1, 900), *[7] * 300]
    featured = spark.createDataFrame([(i, [float(k)] * len(quality.FEATURES)) for k, i in enumerate(ids)], "doc_id bigint, x array<double>").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 900)], "doc_id bigint, quality int")
    for most in (5, 60, 400, 5000):
        quality.train(featured, labels, most_rows=most)
        x, y = seen.pop()
        held = featured.where("crc32(cast(doc_id as string)) % 5 <> 0").selectExpr("xxhash64(doc_id) h", "doc_id", "x[0] x").collect()
        expected = sorted((r.h, r.doc_id, float(r.doc_id % 2), r.x) for r in held)[:most]
        assert x == [e[3] for e in expected] and y == [e[2] for e in expected]


def test_quality_scores_against_plain_lookups(spark):
    """Every score of the query, bin by bin, from the tables that training gives."""
    featured = quality.featurise(spark.read.parquet(f"{SF}/documents.parquet"))
    model = quality.train(featured, spark.read.parquet(f"{SF}/labels.parquet"))
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = quality.op7_quality(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        x = quality.features(texts[r.doc_id])
        bins = [sum(v >= e for e in edges) for v, edges in zip(x, model.edges, strict=True)]
        total = model.base + sum(t[b] for t, b in zip(model.tables, bins, strict=True)) + sum(t[bins[i] // 4][bins[j] // 4] for (i, j), t in zip(model.pairs, model.pair_tables, strict=True))
        assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-9 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def water_fill(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def check_mix(rows, sources):
    sizes = Counter()
    for (_, s), r in zip(sources, rows, strict=True):
        sizes[s] += r.size
    expected = water_fill(dict(sizes))
    taken = Counter()
    for (_, s), r in zip(sources, rows, strict=True):
        assert r.source_size == sizes[s] and abs(r.target - expected[s]) < 1e-6 * max(1, expected[s])
        assert 0 <= r.copies <= 3 and (r.size or not r.copies)
        taken[s] += r.size * r.copies
    return expected, taken


def test_mix_of_edge_cases(spark):
    out = mixing.mix(mixing.sizes(frame(spark))).collect()
    assert Counter((r.doc_id, r.size) for r in out) == Counter((d, len((t or "").encode().split())) for d, t in documents())
    check_mix(out, [(r.doc_id, r.source) for r in out])
    assert mixing.mix(mixing.sizes(frame(spark, True))).count() == 0
    zero = spark.createDataFrame([(1, None, ""), (2, "a", None)], "doc_id bigint, source string, text string")
    assert [r.copies for r in mixing.mix(mixing.sizes(zero)).collect()] == [0, 0]


def test_long_ids_beside_null_ones_stay_as_they_are(spark):
    rows = [(None, "a", "w w")] + [((1 << 53) + 1 + 2 * i, "a" if i % 2 else "b", "w " * (1 + i % 5)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    sized = mixing.sizes(docs).withColumn("row", F.when(F.col("doc_id").isNotNull(), F.col("doc_id") + 2))
    out = mixing.mix(sized, row_col="row").collect()
    assert Counter((r.doc_id, r.row) for r in out) == Counter((d, d and d + 2) for d, _, _ in rows)
    expected, taken = check_mix(out, [(r.doc_id, r.source) for r in out])
    assert all(abs(taken[s] - t) <= 2 for s, t in expected.items())


def test_mix_reaches_its_targets_and_repeats(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first, second = (sorted(mixing.mix(mixing.sizes(d)).collect()) for d in (docs, docs.repartition(7)))
    assert first == second
    expected, taken = check_mix(first, [(r.doc_id, r.source) for r in first])
    assert all(abs(taken[s] - t) <= 0.01 * t for s, t in expected.items())


def test_repeated_rows_are_dealt_to_blocks(spark, monkeypatch):
    seen, saved = {}, mixing.saved

    def kept(rows, name):
        seen[name] = saved(rows, name)
        return seen[name]

    monkeypatch.setattr(mixing, "saved", kept)
    rows = spark.range(12_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("a").alias("source"), F.lit("w w w").alias("text")).union(spark.range(4000).select("id", F.lit("b"), F.lit("x y")))
    out = mixing.mix(mixing.sizes(rows)).collect()
    expected, taken = check_mix(out, [(r.doc_id, r.source) for r in out])
    assert len(out) == 16_000 and all(abs(taken[s] - t) <= 6 for s, t in expected.items())
    assert max(r["count"] for r in seen["dealt"].groupBy("source", "block").count().collect()) < 1.5 * mixing.BLOCK


def test_flight_keeps_sums():
    draw = np.random.default_rng(2)
    pi, x = draw.random(500), draw.integers(1, 900, 500).astype(float)
    out = mixing.flight(pi, x, "seed")
    open_ = (out > 0) & (out < 1)
    assert open_.sum() <= 2 and abs(out.sum() - pi.sum()) < 1e-5 and abs(out @ x - pi @ x) < 1e-2
