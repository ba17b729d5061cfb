"""Personal data, decontamination, WARC and the pipeline."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re
from collections import Counter

import corpus_pipeline
from llm_cases import SF, base_spans, documents, frame, groups, hits, sha
from pyspark.sql import functions as F

from rasterweave.llm import decontamination, pii, quality, warc


def test_pii_of_edge_cases(spark):
    rows = pii.find_pii(frame(spark)).collect()
    expected = Counter((d, tuple(base_spans(t or ""))) for d, t in documents())
    assert Counter((r.doc_id, tuple((s.start, s.end, s.kind) for s in r.spans if s.kind in pii.BASE)) for r in rows) == expected
    assert pii.find_pii(frame(spark, True)).count() == 0


def test_base_spans_on_random_texts():
    draw = random.Random(1)
    for _ in range(20_000):
        text = "".join(draw.choice("00123.5.-- +@a.b()(é") for _ in range(draw.randint(0, 60)))
        assert [s for s in pii.parse(text) if s[2] in pii.BASE] == base_spans(text), text


def test_kinds_beyond_the_base():
    text = "See https://example.org/a?b=1, IBAN GB82 WEST 1234 5698 7654 32 and account no. 1234-5678."
    assert [(text[a:b], k) for a, b, k in pii.parse(text)] == [("https://example.org/a?b=1", "url"), ("GB82 WEST 1234 5698 7654 32", "iban"), ("1234-5678", "account")]
    assert pii.parse("IBAN GB82 WEST 1234 5698 7654 33 and account manager") == []


def test_very_long_numbers():
    assert pii.parse("0" * 5000 + ".1.1.1") == [(0, 5006, "ip")]
    assert pii.parse("1" * 5000 + ".1.1.1") == [] and pii.parse("7" * 100_000) == []
    assert pii.parse("+" + "1" * 9000 + " a@" + "b" * 9000 + ".c") == [(9002, 18006, "email")]


def test_query_pii(spark):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = Counter()
    for d, t in docs:
        spans = base_spans(t)
        kinds = Counter(s[2] for s in spans)
        expected[d, *(kinds[k] for k in pii.BASE), sha(",".join(f"{k}:{a}:{b}" for a, b, k in spans))] += 1
    assert Counter(tuple(r)[:6] for r in pii.op3_pii(spark, SF).collect()) == expected


def test_mask(spark):
    rows = spark.createDataFrame([(1, "write to a@b.co now", 19), (2, None, None), (3, "clean", 5)], "doc_id bigint, text string, n_chars bigint")
    assert sorted(map(tuple, pii.mask(rows).collect())) == [(1, "write to [EMAIL] now", 20), (2, None, None), (3, "clean", 5)]


ITEMS = [(1, "a b c d e f g h i j k l"), (2, "one"), (3, "two words"), (None, "x y z"), (4, None), (5, "..."), (1, "A B C D E F G H I J K L"), (6, "q " * 12)]


def test_decontamination_of_edge_cases(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    extra = [(900, "zz B c D e f g h i j k zz"), (901, "x  y\nZ one"), (902, "q q q q q q q q q q q")]
    docs = frame(spark).unionByName(spark.createDataFrame(extra, "doc_id bigint, text string"), allowMissingColumns=True)
    expected = Counter()
    for d, t in documents() + extra:
        n, hit, found = hits(t, ITEMS)
        expected[d, n, hit, tuple(sorted(found))] += 1
    for most in (64 << 20, 12):  # in one block, and in several
        rows = decontamination.contamination(docs, items, most_bytes=most).collect()
        assert Counter((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), tuple(r["items"])) for r in rows) == expected
    assert decontamination.contamination(frame(spark, True), items).count() == 0
    assert decontamination.contamination(docs, items.limit(0)).where(F.size("spans") > 0).isEmpty()


def test_automaton_on_random_words():
    draw = random.Random(4)
    for _ in range(300):
        items = [(i, " ".join(draw.choice("abc") for _ in range(draw.randint(0, 14)))) for i in range(draw.randint(0, 4))]
        text = " ".join(draw.choice("abcd") for _ in range(draw.randint(0, 80)))
        spans, found = decontamination.Automaton([(str(i), decontamination.words_of(t.encode())) for i, t in items], 10).scan(decontamination.words_of(text.encode()))
        n, hit, names = hits(text, items)
        assert (sum(b - a for a, b in spans), found) == (hit, names)
        assert all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_query_decontamination(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    expected = Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        n, hit, found = hits(r.text, items)
        expected[r.doc_id, n, hit, len(found), sha(",".join(sorted(found))), hit > 0] += 1
    assert Counter(map(tuple, decontamination.op10_decontamination(spark, SF).collect())) == expected


def test_passages_are_cut_and_covered_documents_go(spark):
    item = "a b c d e f g h i j k l"
    docs = spark.createDataFrame([(1, f"before it. {item}, after it, and so on to the end of the text here", 0), (2, item, 0), (3, "clean", 5), (4, None, None)], "doc_id bigint, text string, n_chars bigint")
    out = {r.doc_id: r.text for r in decontamination.decontaminate(docs, spark.createDataFrame([(1, item)], "item_id bigint, text string")).collect()}
    assert out == {1: "before it. , after it, and so on to the end of the text here", 3: "clean", 4: None}


PAGES = [(1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (3, None, None), (4, "u\r\nv", ""), (5, "http://é/", "é" * 5000), (None, "n", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (6, "z", "WARC/1.1\r\n\r\n" * 3)]


def archived(spark, path):
    warc.register(spark)
    warc.write_pages(spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("sha1", F.lit("clash")).repartition(3), path)
    return spark.read.format("warc").option("splitBytes", "700").load(path)


def test_warc_round_trip(spark, tmp_path):
    rows = archived(spark, f"file://{tmp_path}/w").collect()
    assert len(rows) == len(PAGES)
    digest = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    got = Counter((r.record_id, r.record_type, r.refers_to, r.payload_digest, bytes(r.payload)) for r in rows)
    expected = Counter()
    for page_id, _, html in PAGES:
        body = (html or "").encode()
        last = max((p[0] for p in PAGES if (p[2] or "").encode() == body and p[0] is not None), default=None)
        first = page_id == last
        urn = lambda i: None if i is None else f"urn:page:{i}"
        expected[urn(page_id), "response" if first else "revisit", None if first else urn(last), digest(body), body if first else b""] += 1
    assert got == expected


def test_warc_pushes_predicates_down(spark, tmp_path):
    rows = archived(spark, f"file://{tmp_path}/w")
    wanted = rows.where("record_type = 'revisit' and record_id in ('urn:page:1', 'urn:page:5')")
    assert [r.record_id for r in wanted.collect()] == ["urn:page:1"]
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"\bFilter\b", plan)  # none is left to Spark
    light = spark.read.format("warc").option("payload", "false").load(f"file://{tmp_path}/w")
    assert light.where("payload is not null").isEmpty() and light.count() == len(PAGES)


def test_warc_reads_foreign_files(spark, tmp_path):
    records = [warc.record_bytes({"record_id": f"r{i}", "record_type": "response" if i % 2 else "request"}, b"body %d" % i * i) for i in range(9)]
    (tmp_path / "plain.warc").write_bytes(b"".join(records))
    (tmp_path / "members.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    rows = warc.register(spark).read.format("warc").load(f"file://{tmp_path}")
    assert Counter((r.record_id, bytes(r.payload)) for r in rows.where("record_type = 'response'").collect()) == Counter({(f"r{i}", b"body %d" % i * i): 2 for i in range(1, 9, 2)})


def test_warc_of_no_pages(spark, tmp_path):
    warc.register(spark)
    warc.write_pages(spark.createDataFrame([], "page_id bigint, url string, html string"), f"file://{tmp_path}/none")
    assert spark.read.format("warc").load(f"file://{tmp_path}/none").count() == 0


def test_query_warc(spark):
    pages = [(r.page_id, (r.html or "").encode()) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    last = {}
    for i, b in pages:
        last[b] = max(i, last.get(b, i))
    expected = Counter((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if last[b] == i else "revisit", None if last[b] == i else last[b]) for i, b in pages)
    assert Counter(map(tuple, warc.op6_warc(spark, SF).collect())) == expected


def test_pipeline_against_plain_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    kept = [tuple(r) for r in corpus_pipeline.quality_stage(spark, docs, SF).collect()]
    model = quality.train(quality.featurise(docs), spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in quality.scored(quality.featurise(docs), model).where(f"score >= {quality.THRESHOLD}").collect()}
    assert {r[0] for r in kept} == good
    alone = {d for d, _, c in groups([(r[0], r[1]) for r in kept]) if d == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    counted = {r[0]: hits(r[1], items) for r in kept if r[0] in alone}
    expected = {d for d, (n, hit, _) in counted.items() if hit <= n / 2}
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*names, "copies"]
    rows = out.collect()
    assert {r.doc_id for r in rows} <= expected and len(rows) == len({r.doc_id for r in rows})
    before = {r[0]: r[1] for r in kept}
    for r in rows:
        assert r.n_chars == len(r.text) and 1 <= r.copies <= 3 and hits(r.text, items)[1] == 0 and not base_spans(r.text)
        if not counted[r.doc_id][1] and not pii.parse(before[r.doc_id]):
            assert r.text == before[r.doc_id]


def test_stages_bear_edge_cases(spark):
    for empty in (False, True):
        docs = frame(spark, empty)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns or name == "mixing sources"
            docs = spark.createDataFrame(out.collect(), out.schema)


def test_mixing_stage_takes_its_target_where_ids_are_null(spark):
    docs = spark.createDataFrame([(None if i % 2 else i % 7, "w " * (20 + i % 30), "en", f"s{i % 3}", None, i) for i in range(400)], "doc_id bigint, text string, lang string, source string, n_chars bigint, copies int")
    out = corpus_pipeline.mixing_stage(spark, docs, SF)
    assert out.columns == docs.columns
    size = lambda rows, times: sum(len(r.text.split()) * times(r) for r in rows)
    total = size(docs.collect(), lambda r: 1)
    assert abs(size(out.collect(), lambda r: r.copies) - total) < 0.02 * total
