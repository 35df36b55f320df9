"""DuckDB SQL of the queries of this package that SQL can state."""

from __future__ import annotations

_ASSIGN = ("((?i:password|passwd|secret|token|api_?key))[\"'']?\\x20*[:=]\\x20*[\"'']?"
           "([A-Za-z0-9+/_.=-]+)")

_MATCHES = "\n union all ".join(
    f"select rid, doc_id, '{kind}' kind, {order} ord, {least} least,"
    f" regexp_extract_all(t, '{p}', 0) hits, regexp_extract_all(t, '{p}', {group}) checked,"
    f" string_split_regex(t, '{p}') gaps from d where regexp_matches(t, '{p}')"
    for order, (kind, p, group, least) in enumerate((
        ("assign", _ASSIGN, 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16),
        ("hex", "[0-9a-f]{32,}", 0, 32))))

SECRETS = f"""
with d as (select row_number() over () rid, doc_id, coalesce(text, '') t from documents),
m as ({_MATCHES}),
e as (select rid, kind, ord, least, hits, checked, gaps, unnest(range(1, len(hits) + 1)) i
      from m),
s as (select rid, kind, ord, length(hits[i]) size,
             list_sum(list_transform(gaps[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) st
      from e where length(checked[i]) >= least),
f as (select rid, string_agg(kind || ':' || st::bigint || ':' || (st + size)::bigint, ','
                             order by st, ord) spans,
             count(*) filter (kind = 'assign') n_assign,
             count(*) filter (kind = 'access') n_access,
             count(*) filter (kind = 'hex') n_hex
      from s group by rid)
select doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access,
       coalesce(n_hex, 0) n_hex, sha256(coalesce(spans, '')) base_sha256,
       coalesce(spans, '') spans
from d left join f using (rid)
"""

LINES = """
with d as (select row_number() over () rid, doc_id, source, text,
                  string_split(text, chr(10)) lines from documents),
x as (select rid, source, unnest(list_distinct(list_filter(
        list_transform(lines, lambda l: trim(l, ' ' || chr(9) || chr(13))), lambda l: l <> ''))) line
      from d),
p as (select source, count(*) pages from documents group by source),
b as (select x.source, x.line from x join p on x.source is not distinct from p.source
      group by x.source, x.line, p.pages having count(*) >= 5 and count(*) > 0.05 * p.pages),
s as (select source, list(line) bad from b group by source),
k as (select rid, doc_id, d.source, text, lines,
             list_filter(lines, lambda l: not coalesce(list_contains(
               bad, trim(l, ' ' || chr(9) || chr(13))), false)) kept
      from d left join s on d.source is not distinct from s.source)
select doc_id, source, coalesce(len(lines), 0)::bigint n_lines,
       coalesce(len(lines) - len(kept), 0)::bigint n_dropped,
       length(array_to_string(kept, chr(10)))::bigint clean_chars,
       sha256(array_to_string(kept, chr(10))) clean_sha256
from k
"""

_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

WARC = f"""
with p as (select page_id, octet_length(encode(coalesce(html, ''))) size,
                  sha1(coalesce(html, '')) hex, coalesce(html, '') body from pages),
w as (select page_id, size, hex, max(page_id) over (partition by body) winner from p),
b as (select *, list_transform(range(0, 32), lambda i: list_reduce(list_transform(
        range(i * 5, i * 5 + 5), lambda k: (((instr('0123456789abcdef', hex[k // 4 + 1]) - 1)
          >> (3 - k % 4)::int) & 1)::bigint), lambda a, x: a * 2 + x)) digits from w)
select page_id, size::bigint payload_bytes,
       array_to_string(list_transform(digits, lambda d: '{_DIGITS}'[d + 1]), '') payload_digest,
       case when page_id = winner then 'response' else 'revisit' end record_type,
       case when page_id <> winner then winner end refers_to
from b
"""



def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd rounds as a chain of tables: b0, a0, b1, a1 ... for codebooks and assignments."""
    steps = [f"""
k as materialized (
  select row_number() over (order by vec_id, embedding) rid, vec_id, label,
         list_transform(embedding, lambda x: floor(x::double * 4096)::bigint) v
  from embeddings where embedding is not null and len(list_filter(
    embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
x as materialized (
  select rid, p part, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] v
  from k, range({parts}) t(p)),
b0 as materialized (select part, rid - 1 entry, v from x where rid <= {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} as materialized (
  select rid, x.part, any_value(x.v) v, min((list_sum(list_transform(
    list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint, entry)) best
  from x join b{i} b on x.part = b.part group by rid, x.part)""")
        if i < rounds:
            steps.append(f"""
b{i + 1} as materialized (
  select b.part, b.entry, coalesce(m.v, b.v) v from b{i} b left join (
    select part, entry, list(((s - ((s % n) + n) % n) // n)::bigint order by place) v from (
      select part, best[2] entry, place, sum(v[place])::bigint s, count(*) n
      from a{i}, unnest(range(1, len(v) + 1)) t(place) group by all) group by all) m
  on b.part = m.part and b.entry = m.entry)""")
    return f"""
with {",".join(steps)},
s as (select sha256(string_agg(array_to_string(v, ','), ',' order by part, entry)) sha
      from b{rounds}),
e as (select rid, string_agg(format('{{:02x}}', best[2]), '' order by part) code,
             sum(best[1])::bigint error from a{rounds} group by rid)
select vec_id, code, error, sum(error) over (partition by label)::bigint label_error,
       sha codebooks_sha256
from e join k using (rid), s
"""




def _crc32_table() -> list[int]:
    """The checksum of each byte value, from the reflected polynomial."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ 0xEDB88320 * (value & 1)
        table.append(value)
    return table


TRIE = f"""
with t as (select conv_id c, coalesce(role, '') r, coalesce(text, '') x,
                  row_number() over (partition by conv_id order by turn nulls first, sha256(
                    concat(strlen(coalesce(role, '')), ':', role, text))) place
           from conversations where conv_id is not null),
o as (select c, list((r, x) order by place) own,
             xor(4294967295::bigint, list_reduce(list_concat([4294967295::bigint],
               list_transform(string_split(c::varchar, ''), lambda s: ascii(s)::bigint)),
               lambda a, b: xor(a >> 8, {_crc32_table()}[1 + (xor(a, b) & 255)]::bigint))) % 6 h
      from t group by c),
p as (select o.c, list_concat(coalesce(b.own, [])[:o.h], o.own[o.h + 1:]) path
      from o left join o b on b.c = o.c - o.c % 100),
n as materialized (select path[:d] node, d, min(c) conv_id, count(*) n,
             string_agg(c, ',' order by c) filter (d = len(path)) ends,
             count(*) = count(*) filter (d = len(path)) leaf
      from p, unnest(range(len(path) + 1)) u(d) group by all),
s as (select node[:a] node, sum(leaf::int) leaves,
             sum(case when d > 0 then (n - 1) * length(node[d][2]) else 0 end) saved,
             count(*) filter (d = a + 1) children
      from n, unnest(range(d + 1)) u(a) group by node[:a])
select n.conv_id, n.d::bigint depth, above.conv_id parent_conv_id, n.n n_convs,
       children n_children, leaves::bigint n_leaves, saved::bigint saved_tokens,
       sha256(coalesce(n.ends, '')) ends_sha256
from n join s using (node) left join n above on n.d > 0 and above.node = n.node[:n.d - 1]
"""

ORACLES = {"op1_secret_scans": SECRETS, "op5_line_dedup": LINES, "op9_warc": WARC,
           "op12_conversation_trie": TRIE, "op13_vector_codes": _vector_codes()}
