"""DuckDB SQL of the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from basketry.llm import licenses

OP9 = r"""
with t as (
  select doc_id, coalesce(text, '') as raw, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents
), g as (
  select doc_id, raw, norm, count(*) over (partition by norm) as group_size,
         first_value(doc_id) over (partition by norm order by length(raw) desc, doc_id) as keep_id
  from t
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from g
"""

OP3 = """
with v as (
  select vec_id, label, embedding::double[] as e from embeddings
), ok as (
  select * from v where label is not null and vec_id is not null and len(e) > 0
    and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0
), l as (
  select a.vec_id as a, b.vec_id as b from ok a join ok b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.93
), n as (
  select a, count(*) as n from l group by a
), r as (
  with recursive reach(a, b) as (select a, b from l union select reach.a, l.b from reach join l on reach.b = l.a)
  select a, least(a, min(b)) as root from reach group by a
)
select v.vec_id, coalesce(n.n, 0) as n_links, coalesce(r.root, v.vec_id) as component_id, coalesce(r.root, v.vec_id) = v.vec_id as kept
from v left join n on v.vec_id = n.a left join r on v.vec_id = r.a
"""

OP4 = """
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t, string_split(coalesce(text, ''), chr(10)) as l from documents
), w as (
  select r, doc_id, i, [l[i], l[i + 1], l[i + 2]] as k from d, unnest(range(1, len(l) - 1)) u(i)
), f as (
  select r, i, row_number() over (partition by k order by doc_id nulls last, r, i) as nth from w
), c as (
  select distinct r, i + x as line from f, (values (0), (1), (2)) s(x) where nth > 1
), g as (
  select r, list(line) as gone from c group by r
)
select d.doc_id, case when gone is null then t else coalesce(array_to_string(list_filter(l, lambda x, i: not list_contains(gone, i)), chr(10)), '') end as text,
       len(l) as n_lines, coalesce(len(gone), 0) as n_removed
from d left join g on d.r = g.r
"""

OP11 = """
with v as (
  select row_number() over () as r, vec_id, embedding::double[] as e from embeddings
), x as (
  select r, vec_id, list_transform(e, lambda y: floor(256 * y)) as e from v
  where vec_id is not null and e is not null and len(list_filter(e, lambda y: y is null or not isfinite(y))) = 0
), p as (
  select q.r, q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score, c.r as c
  from x q join x c on len(q.e) = len(c.e) and q.r <> c.r where q.vec_id % 50 = 0
)
select query_id, row_number() over (partition by r order by score desc, vec_id, c)::int as rank, vec_id, score
from p qualify rank <= 5
"""

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP12 = rf"""
with p as (
  select row_number() over () as r, lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws
  from (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}') as t from documents) d,
       unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) u(piece)
), g as (
  select lang, k, array_to_string(ws[i : i + k - 1], ' ') as phrase from p, unnest(range(1, len(ws) + 1)) u(i), (values (1), (2), (3), (4)) v(k)
  where i + k - 1 <= len(ws)
), f as materialized (
  select lang, k, phrase, count(*) as f from g group by all
), n as (
  select lang, sum(f)::bigint as n from f where k = 1 group by lang
), c as (
  select lang, k, phrase, string_split(phrase, ' ') as ws, f as a from f where k >= 2 and f >= 30
), parts as materialized (
  select lang, phrase, a, cut, array_to_string(ws[1 : cut], ' ') as head, array_to_string(ws[cut + 1 :], ' ') as tail
  from (select *, unnest(range(1, k)) as cut from c) x
), cuts as (
  select p.lang, p.phrase, p.a, p.cut, l.f as l, r.f as r, (2000000::hugeint * p.a) // (l.f::hugeint + r.f) as score
  from parts p join f l on l.lang = p.lang and l.phrase = p.head join f r on r.lang = p.lang and r.phrase = p.tail
), low as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1
), around as (
  select lang, array_to_string(ws[s : s + w - 1], ' ') as phrase, max(a) as longer
  from (select *, unnest(range(1, k - w + 2)) as s from c, (values (2), (3)) v(w) where w < k) x group by all
), kept as (
  select low.* from low left join around using (lang, phrase) where coalesce(longer, 0)::hugeint * 100 < a::hugeint * 80
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score::bigint as score
from kept join n using (lang) qualify rank <= 2000
"""


def _values(texts: dict[str, str]) -> str:
    return ", ".join(f"('{t}', '{label}')" for t, label in texts.items())


OP10 = f"""
with d as (
  select row_number() over () as r, doc_id, translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}') as t from documents
), w as (
  select r, doc_id, t, regexp_extract_all(t, '{WORDS}') as ws from d
), p as (
  select w.r, label, i - 1 as start
  from w, unnest(range(1, len(ws) + 1)) u(i), (select string_split(phrase, ' ') as ph, label from (values {_values(licenses.PHRASES)}) x(phrase, label)) q
  where ws[i : i + len(ph) - 1] = ph
), b as (
  select r, count(*) as n_base, min(start) as first_word, max(start) as last_word, list(distinct label) as base_labels from p group by r
), lines as (
  select r, list_distinct(regexp_extract_all(line, '{WORDS}')) as tokens from d, unnest(string_split(t, chr(10))) u(line)
), m as (
  select r, label, len(list_intersect(tokens, tt)) as shared, len(tt) as n
  from lines, (select list_distinct(string_split(template, ' ')) as tt, label from (values {_values(licenses.TEMPLATES)}) x(template, label)) q
), s as (
  select r, list(distinct label) as found, max(shared / n) as share from m where shared >= ceil(0.8 * n) group by r
)
select w.doc_id, len(ws) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base_labels), ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base_labels, []), coalesce(found, [])))), ','), '') as labels,
       case when n_base > 0 then 1.0 else coalesce(share, 0.0) end::double as score
from w left join b on w.r = b.r left join s on w.r = s.r
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_top_k": OP11, "op12_collocations": OP12, "op3_embedding_dedup": OP3, "op4_line_dedup": OP4, "op9_exact_dedup": OP9, "op10_licenses": OP10}
