"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

OP4 = f"""with w as (select doc_id, {_WORDS.format("coalesce(text, '')")} ws from documents),
windows as (select doc_id, i, array_to_string(list_slice(ws, i, i + 34), ' ') win from (select doc_id, ws, unnest(range(1, len(ws) - 33)) i from w)),
twice as (select win from windows group by 1 having count(*) > 1),
gone as (select distinct doc_id, unnest(range(i, i + 35)) i from windows where win in (select win from twice)),
places as (select doc_id, unnest(ws) word, generate_subscripts(ws, 1) i from w),
kept as (select doc_id, string_agg(word, ' ' order by i) t, count(*) n from places anti join gone using (doc_id, i) group by 1)
select doc_id, cast(len(ws) as bigint) n_words, cast(len(ws) - coalesce(n, 0) as bigint) n_removed, sha256(coalesce(t, '')) kept_sha256 from w left join kept using (doc_id)"""

OP5 = f"""with recursive w as (select doc_id, {_WORDS.format(_LOWERED)} ws from documents),
s as (select doc_id, list_distinct(case when len(ws) >= 5 then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(list_slice(ws, i, i + 4), ' ')) when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) g from w),
e as (select doc_id, len(g) n, unnest(g) x from s),
links as (select a.doc_id a, b.doc_id b from e a join e b on a.x = b.x and a.doc_id <> b.doc_id group by 1, 2, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach as (select doc_id a, doc_id b from s union select r.a, l.b from reach r join links l on l.a = r.b)
select s.doc_id, cast(len(any_value(g)) as bigint) n_shingles, min(b) component_id from s join reach on a = s.doc_id group by 1"""

_BIT = "list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((cast(concat('0x', substr(concat(d, '0'), cast(i * 5 // 4 as int) + 1, 2)) as int) >> (3 - i * 5 % 4)) & 31 as int) + 1, 1))"
OP6 = f"""with p as (select page_id, coalesce(html, '') body, sha1(coalesce(html, '')) d from pages), f as (select body, max(page_id) first from p group by 1)
select page_id, cast(strlen(body) as bigint) payload_bytes, array_to_string({_BIT}, '') payload_digest, case when page_id = first then 'response' else 'revisit' end record_type, case when page_id <> first then first end refers_to from p join f using (body)"""

_PLAIN = r"regexp_extract_all(" + _LOWERED + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP10 = f"""with w as (select doc_id, {_PLAIN} ws from documents), items as (select item_id, {_PLAIN} ws from benchmark),
iw as (select distinct item_id, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') win from (select item_id, ws, least(10, len(ws)) k, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) i from items where len(ws) > 0)),
dw as (select doc_id, i, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') win from (select doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) i from w, (select distinct k from iw))),
hits as (select doc_id, i, dw.k, item_id from dw join iw on dw.k = iw.k and dw.win = iw.win),
n as (select doc_id, count(distinct j) n_hit from (select doc_id, unnest(range(i, i + k)) j from hits) group by 1),
m as (select doc_id, count(*) n_items, string_agg(x, ',' order by x) names from (select distinct doc_id, coalesce(cast(item_id as varchar), 'null') x from hits) group by 1)
select w.doc_id, cast(len(ws) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(n_items, 0) as bigint) n_items, sha256(coalesce(names, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from w left join n using (doc_id) left join m using (doc_id)"""

_FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"
_PMOD_FLOOR = "cast((s - ((s % n) + n) % n) // n as bigint)"


def _whole(scale: int) -> str:
    return f"list_transform(embedding, lambda x: cast(greatest(least(floor({scale} * cast(x as double)), 67108864), -67108864) as bigint))"


def _op11() -> str:
    """Every round in full: parts against all entries, then floors of means."""
    ctes = [
        f"kept as materialized (select vec_id, label, {_whole(256)} v from embeddings where {_FINITE})",
        "w as materialized (select cast(ceil(max(len(v)) / 16) as bigint) w from kept)",
        "x as materialized (select vec_id, p, list_transform(range(0, w), lambda i: coalesce(v[p * w + i + 1], 0)) u from kept, w, (select unnest(range(0, 16)) p))",
        "b0 as materialized (select p, k, u from x join (select vec_id, row_number() over (order by vec_id) - 1 k from kept order by vec_id limit 64) using (vec_id))",
    ]
    for t in range(3):
        distance = "cast(list_sum(list_transform(range(1, len(x.u) + 1), lambda i: (x.u[i] - b.u[i]) * (x.u[i] - b.u[i]))) as bigint)"
        ctes.append(f"a{t} as materialized (select vec_id, p, min(d) d, arg_min(k, d * 64 + k) k from (select x.vec_id, x.p, b.k, {distance} d from x join b{t} b on x.p = b.p) group by 1, 2)")
        if t < 2:
            ctes.append(f"m{t} as (select p, k, list(c order by i) u from (select p, k, i, {_PMOD_FLOOR} c from (select p, k, i, cast(sum(u[i]) as bigint) s, count(*) n from a{t} join x using (vec_id, p), (select unnest(range(1, w + 1)) i from w) group by 1, 2, 3)) group by 1, 2)")
            ctes.append(f"b{t + 1} as materialized (select b.p, b.k, coalesce(m.u, b.u) u from b{t} b left join m{t} m on m.p = b.p and m.k = b.k)")
    ctes.append("r as (select vec_id, string_agg(printf('%02x', k), '' order by p) code, cast(sum(d) as bigint) error from a2 group by 1)")
    return f"with {', '.join(ctes)} select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) label_error, (select sha256(string_agg(array_to_string(u, ','), ',' order by p, k)) from b2) codebooks_sha256 from r join kept using (vec_id)"


OP11 = _op11()

OP12 = f"""with kept as materialized (select vec_id, {_whole(1024)} v from embeddings where {_FINITE}),
scored as (select q.vec_id query_id, c.vec_id, cast(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])) as bigint) score from kept q join kept c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) rank, vec_id, score from scored qualify rank <= 10"""


def _op13() -> str:
    """Every round in full."""
    ctes = [
        f"kept as materialized (select vec_id, {_whole(1024)} v from embeddings where {_FINITE} and len(embedding) = 64)",
        "c0 as materialized (select row_number() over (order by sha256(concat('3:', vec_id))) - 1 k, v from kept order by sha256(concat('3:', vec_id)) limit 8)",
    ]
    for t in range(11):
        distance = "cast(list_sum(list_transform(range(1, 65), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i]))) as bigint)"
        ctes.append(f"a{t} as materialized (select vec_id, min(d) d, arg_min(k, d * 8 + k) k from (select x.vec_id, c.k, {distance} d from kept x, c{t} c) group by 1)")
        if t < 10:
            ctes.append(f"m{t} as (select k, list(y order by i) v from (select k, i, {_PMOD_FLOOR} y from (select k, i, cast(sum(v[i]) as bigint) s, count(*) n from a{t} join kept using (vec_id), (select unnest(range(1, 65)) i) group by 1, 2)) group by 1)")
            ctes.append(f"c{t + 1} as materialized (select c.k, coalesce(m.v, c.v) v from c{t} c left join m{t} m using (k))")
    ctes.append("named as (select k, sha256(array_to_string(v, ',')) centroid_sha256 from c10)")
    return f"with {', '.join(ctes)} select vec_id, cast(k as int) as cluster, d as distance, cast(sum(d) over (partition by k) as bigint) cluster_inertia, cast(sum(d) over () as bigint) inertia, centroid_sha256 from a10 join named using (k)"


OP13 = _op13()

ORACLE = {"op4_substring": OP4, "op5_ngram_jaccard": OP5, "op6_warc": OP6, "op10_decontamination": OP10, "op11_vector_codes": OP11, "op12_top_k": OP12, "op13_centroids": OP13}
