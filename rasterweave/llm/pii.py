"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors: at-signs, schemes, identifier cues and the digit pairs that every number has.
Deterministic parsers expand each anchor to its boundaries and validate what they find.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.llm.common import table

#: Kinds in the order in which spans of one start are listed; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "url", "iban", "account")
BASE = KINDS[:4]
CUES = ("account", "acct", "a/c", "customer id", "ssn", "social security", "passport", "tax id", "member id", "employee id", "licence", "license no")
SPAN = "struct<kind:string,start:int,end:int>"

DIGITS = "0123456789"
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
URL = re.compile(r"[A-Za-z0-9.-]+(:[0-9]{1,5})?(/[^\s<>\"'|]*)?")
IBAN = re.compile(r"[\x20:#]{0,3}([A-Z]{2}[0-9]{2}([\x20]?[A-Z0-9]){11,30})")
ACCOUNT = re.compile(r"(?:[\x20]?(?:number|no\.?|nr\.?|id|#))?[\x20:#=-]{1,3}([A-Z0-9](?:[-]?[A-Z0-9]){4,19})(?![A-Za-z0-9])", re.IGNORECASE)


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    words: dict[str, list[str]] = {"@": ["email"], "://": ["url"], "www.": ["url"]}
    for a in DIGITS:
        words["+" + a] = ["phone"]
        for b in DIGITS:
            words[f"{a}.{b}"] = ["ip"]
            for between in ("", " ", "-"):
                words[a + between + b] = ["card"]
    for cue in CUES:
        for form in (cue, cue.upper(), cue.capitalize(), cue.title()):
            words[form] = ["account"]
    for cue in ("iban", "IBAN", "Iban"):
        words[cue] = ["iban"]
    for word, kinds in words.items():
        out.add_word(word, (kinds[0], len(word)))
    out.make_automaton()
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def run_start(text: str, at: int, least: int, kind: frozenset | str) -> int:
    """Start, not before least, of the run of characters of kind that ends before at."""
    while at > least and text[at - 1] in kind:
        at -= 1
    return at


def valid_iban(value: str) -> bool:
    value = value.replace(" ", "")
    return 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def parse(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans, sorted by start, then in the order of KINDS. Each kind is searched by itself, leftmost first and without overlaps."""
    past = dict.fromkeys(KINDS, 0)  # where the search of each kind goes on
    out: list[tuple[int, int, int]] = []

    def put(kind: str, a: int, b: int) -> None:
        out.append((a, KINDS.index(kind), b))

    for last, (kind, n) in anchors().iter(text):
        at, least = last - n + 1, past[kind]
        if at < least:
            continue
        if kind == "email":
            a = run_start(text, at, least, LOCAL)
            if a < at and (m := DOMAIN.match(text, at + 1)):
                put(kind, a, m.end())
                past[kind] = m.end()
        elif kind == "ip":
            a = run_start(text, at, least, DIGITS)
            if m := IP.match(text, a):
                past[kind] = m.end()
                if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
                    put(kind, a, m.end())
        elif kind == "card":
            m = CARD.match(text, at)  # the first anchor of a number stands at its start: what is before is no digit, nor a digit and one separator
            past[kind] = m.end()
            digits = re.sub("[ -]", "", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                put(kind, at, m.end())
        elif kind == "phone":
            if m := PHONE.match(text, at):
                past[kind] = m.end()
                if 9 <= sum(c in DIGITS for c in m.group()) <= 15:
                    put(kind, at, m.end())
        elif kind == "url":
            scheme = text[at : last + 1] == "://"
            a = run_start(text, at, least, LOCAL) if scheme else at
            if (m := URL.match(text, last + 1)) and (a < at or not scheme) and "." in m.group().split("/")[0].strip("."):
                end = m.end()
                while text[end - 1] in ".,;:!?)":
                    end -= 1
                put(kind, a, end)
                past[kind] = m.end()
        elif kind == "iban":
            if m := IBAN.match(text, last + 1):
                value = m.group(1)
                while len(value) > 15 and not valid_iban(value):
                    value = value[:-1].rstrip(" ")
                if valid_iban(value):
                    put(kind, m.start(1), m.start(1) + len(value))
                    past[kind] = m.start(1) + len(value)
        elif (m := ACCOUNT.match(text, last + 1)) and sum(c in DIGITS for c in m.group(1)) >= 4:
            put(kind, m.start(1), m.end(1))
            past[kind] = m.end(1)
    return [(a, b, KINDS[k]) for a, k, b in sorted(out)]


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (kind, start, end; code points, end exclusive), one row per document.

    Null and empty texts have no spans; digits may go on for as long as they like; repeated rows each get theirs; no document needs another. Other columns are not looked at.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": k, "start": a, "end": b} for a, b, k in parse(text or "")] for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, schema.field("spans").type)], schema=schema)

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id bigint, spans array<{SPAN}>")


def mask(docs: DataFrame) -> DataFrame:
    """docs with each span of the text replaced by its kind in brackets; of overlapping spans the first and longest counts.

    Documents without spans, null texts included, pass unchanged. n_chars, where there is one, follows the text.
    """
    names = docs.columns

    def masked(text: str) -> str:
        out, at = [], 0
        for a, b, kind in sorted(parse(text), key=lambda s: (s[0], -s[1])):
            if a >= at:
                out += [text[at:a], f"[{kind.upper()}]"]
                at = b
            elif b > at:  # the rest of a span that begins inside another
                at = b
        return "".join([*out, text[at:]]) if out else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(names, batch.columns, strict=True))
            texts = [t and masked(t) for t in columns["text"].to_pylist()]
            columns["text"] = pa.array(texts, columns["text"].type)
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([n if t is None else len(t) for t, n in zip(texts, columns["n_chars"].to_pylist(), strict=True)], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return docs.mapInArrow(run, docs.schema)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s.kind.isin(*BASE))
    of = lambda kind: F.filter("spans", lambda s: s.kind == kind)
    counts = [F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE]
    found = find_pii(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
