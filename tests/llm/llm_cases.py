"""Documents with everything that an operator has to bear, and plain versions of the operators' contracts."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

SF = "/root/testdata/sf0.001"
#: Columns that clash with names that operators use inside.
EXTRA = "node bigint, n bigint, h bigint, spans string, bucket string, key string, score double, word string, label string, size string, copies string, begin string, following string"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {EXTRA}"


def rows() -> list[tuple]:
    draw = random.Random(7)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 9))) for _ in range(400)]
    words = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    base, passage = words(120), words(60)
    near = [*base[:50], "changed", *base[51:]]
    texts = [
        " ".join(base), " ".join(base), " ".join(near), " ".join(base).upper(), None, "", "   \n\t ", "one", "two words", "é ünï 漢字   x",
        " ".join(words(40) + passage + words(40)), " ".join(words(30) + passage + words(55)), " ".join(passage), " ".join(words(20_000)), "x" * 3000, "ab" * 900, "a b " * 300, ("row of words here " * 60).strip(),
        "mail a.b@example.org, call +1 (482) 555-7163; 10.0.0.255 and 4111 1111 1111 1111.", "A. B! C? " * 40, "line\n\nline\n" * 30, " ".join(words(500)) + ".", "#$% " * 200,
    ]
    out = [(i, t, "en" if i % 3 else None, None if i % 7 == 0 else f"s{i % 3}", None if i % 5 == 0 else len(t or "")) for i, t in enumerate(texts)]
    out += [(3, texts[3], "en", "s0", 5), (3, texts[3], "en", "s0", 5), (None, texts[0], None, None, None), (None, None, None, None, None), (-9, texts[21], "fr", "s1", 1), (1 << 60, "two words", "en", "s2", 9)]
    return [(*r, 1, 2, 3, "spans", "bucket", "key", 0.5, "word", "label", "size", "copies", "begin", "following") for r in out]


def frame(spark, empty: bool = False):
    return spark.createDataFrame([] if empty else rows(), SCHEMA).repartition(3)


def documents() -> list[tuple]:
    """doc_id, text of the edge cases, as many times as they stand there."""
    return [(r[0], r[1]) for r in rows()]


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def repeated(units: list, window: int) -> list[bytearray]:
    """For each document which of its units a window covers that starts anywhere else too."""
    counts = Counter(tuple(u[i : i + window]) for u in units for i in range(len(u) - window + 1))
    out = []
    for u in units:
        gone = bytearray(len(u))
        for i in range(len(u) - window + 1):
            if counts[tuple(u[i : i + window])] > 1:
                gone[i : i + window] = b"\1" * window
        out.append(gone)
    return out


def groups(docs: list[tuple]) -> list[tuple]:
    """doc_id, number of shingles, component of each document, comparing all pairs."""
    sets = []
    for _, text in docs:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(docs)))

    def find(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(docs)):
        members[find(i)].append(i)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        ids = [docs[j][0] for j in members[find(i)] if docs[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids and sets[i] else doc_id))
    return out


def hits(text: str | None, items: list[tuple]) -> tuple[int, int, set]:
    """n_words, n_hit and the items whose windows occur."""
    split = lambda t: [w.encode() for w in re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))]
    words, found = split(text), set()
    gone = bytearray(len(words))
    for name, item in items:
        own = split(item)
        size = min(10, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1) if windows else ():
            if tuple(words[i : i + size]) in windows:
                gone[i : i + size] = b"\1" * size
                found.add("null" if name is None else str(name))
    return len(words), sum(gone), found


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The base kinds of personal data by plain regular expressions."""
    kinds, out = ("email", "ip", "card", "phone"), []
    digits = lambda s: [int(c) for c in s if c in "0123456789"]
    luhn = lambda d: sum(sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(reversed(d))) % 10 == 0
    rules = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True), (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))), (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    )
    for k, (pattern, good) in enumerate(rules):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if good(m.group())]
    return [(a, b, kinds[k]) for a, k, b in sorted(out)]
