"""SQL for the queries that SQL can express, in DuckDB's dialect, from the operators' contracts."""

from __future__ import annotations

from pitchlake.llm import secrets

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP2 = f"""
with recursive d as (
  select doc_id, coalesce(regexp_extract_all({_LOWER}, {_WORDS}), []) as w from documents),
sh as (
  select distinct doc_id, s from (
    select doc_id, w[p] || ' ' || w[p + 1] as s
    from (select doc_id, w, unnest(generate_series(1, len(w) - 1)) as p from d where len(w) > 1)
    union all select doc_id, w[1] from d where len(w) = 1)),
n as (select doc_id, count(*) as n from sh group by doc_id),
links as (
  select a.doc_id as a, b.doc_id as b from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id
  having 100 * count(*) >= 80 * (
    (select n from n where n.doc_id = a.doc_id) + (select n from n where n.doc_id = b.doc_id)
    - count(*))),
reach as (
  select doc_id as a, doc_id as b from d
  union
  select reach.a, links.b from reach join links on reach.b = links.a),
c as (select a, min(b) as component_id from reach group by a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from d left join n using (doc_id) join c on c.a = d.doc_id
"""

OP4 = f"""
with i as (
  select item_id, regexp_extract_all({_LOWER}, {_ALNUM}) as w from benchmark
  where item_id is not null),
iw as (
  select distinct item_id, s, array_to_string(w[p : p + s - 1], ' ') as k from (
    select item_id, w, least(13, len(w)) as s,
      unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) as p
    from i where len(w) > 0)),
d as (select doc_id, coalesce(regexp_extract_all({_LOWER}, {_ALNUM}), []) as w from documents),
dw as (
  select doc_id, s, p, array_to_string(w[p : p + s - 1], ' ') as k from (
    select doc_id, w, s, unnest(generate_series(1, len(w) - s + 1)) as p
    from d join (select distinct s from iw) on len(w) >= s)),
m as (select doc_id, dw.s, p, item_id from dw join iw on dw.s = iw.s and dw.k = iw.k),
h as (
  select doc_id, count(distinct q) as n_hit from (
    select doc_id, unnest(generate_series(p, p + s - 1)) as q
    from (select distinct doc_id, s, p from m))
  group by doc_id),
t as (
  select doc_id, count(*) as n_items,
    string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
  from (select distinct doc_id, item_id from m) group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join h using (doc_id) left join t using (doc_id)
"""


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _spans(kind: int, pattern: str) -> str:
    """Rows (doc_id, a, kind, b, m) of the matches of one pattern."""
    p = _literal(pattern)
    return f"""
  select doc_id, {kind} as kind, m[i] as m,
    coalesce(list_sum([length(x) for x in g[1 : i]]), 0)
      + coalesce(list_sum([length(x) for x in m[1 : i - 1]]), 0) as a
  from (select doc_id, g, m, unnest(generate_series(1, len(m))) as i from (
    select doc_id, regexp_extract_all(text, {p}) as m, regexp_split_to_array(text, {p}) as g
    from documents where text is not null) where len(m) > 0)"""


_ASSIGN = secrets.ASSIGN.replace("([Pp]", "(?:[Pp]", 1)
_ALLOWED = _literal("|".join(f"(?:{p})" for p in secrets.ALLOWED))

OP5 = f"""
with base as (
  select doc_id, kind, a, a + length(m) as b from (
    select * from ({_spans(0, _ASSIGN.replace("([A-Za-z0-9+/_.=-]+)", "[A-Za-z0-9+/_.=-]+"))})
    where length(regexp_extract(m, {_literal(_ASSIGN)}, 1)) >= {secrets.ASSIGN_VALUE}
    union all {_spans(1, secrets.ACCESS)}
    union all {_spans(2, "[0-9a-f]{24,}")})),
cand as (
  select doc_id, a, m from ({_spans(3, secrets.CANDIDATE)})
  where regexp_matches(m, '[0-9]') and not regexp_matches(m, {_ALLOWED})),
win as (
  select doc_id, a, a + p - 1 as s, substr(m, p, {secrets.WINDOW}) as w from (
    select doc_id, a, m, unnest(generate_series(1, length(m) - {secrets.WINDOW} + 1)) as p
    from cand)),
ent as (
  select doc_id, a, s, w, log2({secrets.WINDOW}) - sum(n * log2(n)) / {secrets.WINDOW} as bits from (
    select doc_id, a, s, w, c, count(*) as n
    from (select doc_id, a, s, w, unnest(string_split(w, '')) as c from win)
    group by all) group by all),
hot as (
  select doc_id, a, s, s + {secrets.WINDOW} as e from ent
  where regexp_matches(w, '[0-9]') and regexp_matches(w, '[^0-9]')
    and not regexp_matches(w, {_literal(secrets.PLACEHOLDER)})
    and bits >= case when not regexp_matches(w, '[^0-9a-f]') then {secrets.HEX_BITS}
      when regexp_matches(w, '[A-Z]') and regexp_matches(w, '[a-z]') then {secrets.MIXED_BITS}
      else {secrets.ALNUM_BITS} end - 1e-9),
isl as (
  select *, sum(fresh) over (partition by doc_id, a order by s) as g from (
    select *, case when s <= lag(e) over (partition by doc_id, a order by s) then 0 else 1 end
      as fresh from hot)),
island as (select doc_id, min(s) as a, max(e) as b from isl group by doc_id, isl.a, g),
place as (
  select doc_id, a, p, p - row_number() over (partition by doc_id, a order by p) as run from (
    select doc_id, a, unnest(generate_series(cast(a as bigint), cast(b as bigint) - 1)) as p
    from island) place_
  where not exists (
    select 1 from base where base.doc_id = place_.doc_id and base.a <= p and p < base.b)),
spans as (
  select * from base union all
  select doc_id, 3 as kind, min(p) as a, max(p) + 1 as b from place group by doc_id, place.a, run),
named as (
  select doc_id, kind, a, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':'
    || cast(a as bigint) || ':' || cast(b as bigint) as t from spans),
joined as (
  select doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access,
    count(*) filter (kind = 2) as n_hex,
    string_agg(t, ',' order by a, kind) filter (kind < 3) as base,
    string_agg(t, ',' order by a, kind) as spans
  from named group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
  coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
  coalesce(spans, '') as spans
from documents left join joined using (doc_id)
"""

OP6 = f"""
with d as (select doc_id, coalesce(regexp_extract_all(text, {_WORDS}), []) as w from documents),
win as (
  select doc_id, p, row_number() over (
      partition by array_to_string(w[p : p + 19], ' ') order by doc_id, p) as r
  from (select doc_id, w, unnest(generate_series(1, len(w) - 19)) as p from d where len(w) > 19)),
gone as (
  select distinct doc_id, q from (
    select doc_id, unnest(generate_series(p, p + 19)) as q from win where r > 1)),
words as (select doc_id, w[q] as x, q from (
  select doc_id, w, unnest(generate_series(1, len(w))) as q from d where len(w) > 0)),
kept as (
  select doc_id, string_agg(x, ' ' order by q) as t from words anti join gone using (doc_id, q)
  group by doc_id),
n as (select doc_id, count(*) as n from gone group by doc_id)
select doc_id, len(w) as n_words, coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id) left join n using (doc_id)
"""

OP9 = """
with v as (
  select vec_id, [cast(floor(1024 * cast(x as double)) as bigint) for x in embedding] as e
  from embeddings
  where embedding is not null and vec_id is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(
      [z[1] * z[2] for z in list_zip(q.e, c.e)]) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 100 = 0)
select query_id, cast(rank as integer) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
where rank <= 10
"""

_LETTERS = r"'[^\x00-\x40\x5B-\x60\x7B-\x7F]+'"

OP11 = f"""
with d as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    coalesce(regexp_extract_all({_LOWER}, {_LETTERS}), []) as w
  from documents),
t as (select row, lang, source, unnest(w) as term from d),
kept as (
  select lang, term, count(*) as n from t group by lang, term having count(distinct row) >= 30),
l as (select lang, count(*) as v, cast(sum(n) as hugeint) as total from kept group by lang),
g as (select distinct lang, source from d),
c as (select lang, source, term, count(*) as n from t group by lang, source, term),
gc as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n, k.n as lang_n
  from g join kept k on g.lang = k.lang
  left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
s as (
  select gc.*, v, l.total as lang_total,
    cast(sum(gc.n) over (partition by gc.lang, source) as hugeint) as total
  from gc join l on gc.lang = l.lang),
p as (
  select lang, source, term, n,
    1 + cast(1000000000 as hugeint) * (n + 5) // (total + 5 * v) as p,
    1 + cast(1000000000 as hugeint) * (lang_n + 5) // (lang_total + 5 * v) as q
  from s),
pair as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce((
      select sum(abs(x.p - y.p)) from p x join p y on x.lang = y.lang and x.term = y.term
      where x.lang = a.lang and x.source = a.source and y.source = b.source), 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source),
term as (
  select lang, source, 'term' as part, term as item, p - q as value from p where n > 0 and p > q)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from (
  select *, row_number() over (
    partition by lang, source, part order by value desc, item) as rank
  from (select * from pair union all select * from term))
where part = 'pair' or rank <= 50
"""

OP13 = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as e
  from embeddings
  where embedding is not null and vec_id is not null and label is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, cast(list_sum(
      [z[1] * z[2] for z in list_zip(a.e, c.e)]) as bigint) as score
  from v a join v c on a.vec_id <> c.vec_id and len(a.e) = len(c.e) where a.vec_id % 50 = 0),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from (
    select *, row_number() over (partition by anchor_id order by score desc, vec_id) as n
    from s where same)
  where n <= 5),
w as (
  select p.*, s.vec_id as negative_id, s.score as negative_score, row_number() over (
      partition by p.anchor_id, positive_id order by s.score desc, s.vec_id) as rank
  from p join s on p.anchor_id = s.anchor_id and not s.same
    and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score,
  negative_score
from w where rank <= 3
"""

SQL = {
    "op2_odd_sketches": OP2,
    "op4_decontaminate": OP4,
    "op5_secrets": OP5,
    "op6_substring_dedup": OP6,
    "op9_topk": OP9,
    "op11_cube_divergence": OP11,
    "op13_strassen_negatives": OP13,
}
