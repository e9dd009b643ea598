"""SQL (DuckDB) for the queries' rows."""

#: Lower-cases A-Z only.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_JACCARD_JOIN = rf"""
with recursive words as (
    select doc_id, list_filter(string_split_regex({_LOWER}, '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
    from documents),
grams as (
    select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) end as g
    from words),
flat as (select doc_id, unnest(g) as gram from grams),
common as (
    select x.doc_id as a, y.doc_id as b, count(*) as n
    from flat x join flat y on x.gram = y.gram and x.doc_id < y.doc_id group by all),
links as (
    select a, b from common join grams ga on ga.doc_id = a join grams gb on gb.doc_id = b
    where 100 * n >= 85 * (len(ga.g) + len(gb.g) - n)),
edges as (select a, b from links union all select b, a from links),
reach(node, other) as (
    select doc_id, doc_id from documents union
    select r.node, e.b from reach r join edges e on e.a = r.other)
select g.doc_id, cast(len(g.g) as bigint) as n_shingles, min(other) as component_id
from grams g join reach on node = g.doc_id group by g.doc_id, len(g.g)
"""

_CONTROL = r"'([<\[])(\\*)(/?INST\]|</?SYS>>|/?s>|\|(?:role|text|end)\|>)', '\1\\\2\3', 'g'"

CHAT_FORMATTING = rf"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
shown as (
    select *, length(regexp_replace(text, {_CONTROL})) as n, length(regexp_replace(role, {_CONTROL})) as r from turns)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    cast(sum(n + case role when 'user' then 15 when 'assistant' then 4 when 'system' then 15 else r + 23 end) as bigint)
        as formatted_chars
from shown group by conv_id
"""

EMBEDDING_NEAR_DEDUP = """
with recursive units as (
    select vec_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) as u
    from (select vec_id, cast(embedding as double[]) as v from embeddings)
    where v is not null and len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
        and list_dot_product(v, v) > 0),
edges as (
    select x.vec_id as a, y.vec_id as b from units x join units y on x.vec_id <> y.vec_id and len(x.u) = len(y.u)
    where list_dot_product(x.u, y.u) >= 0.95),
reach(node, other) as (
    select vec_id, vec_id from embeddings union select r.node, e.b from reach r join edges e on e.a = r.other),
named as (select node as vec_id, min(other) as component_id from reach group by node)
select n.vec_id, (select count(*) from edges e where e.a = n.vec_id) as n_links, component_id,
    n.vec_id = component_id as kept
from named n
"""

EXACT_TOP_K_SEARCH = rf"""
with words as (
    select doc_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
tf as (select doc_id, term, count(*) as n from words group by all),
lengths as (select doc_id, sum(n) as len from tf group by doc_id),
corpus as (select (select count(*) from documents) as docs, (select sum(len) from lengths) as total),
idf as (
    select term, ln(1 + ((select docs from corpus) - count(*) + 0.5) / (count(*) + 0.5)) as idf from tf group by term),
scored as (
    select q.doc_id as query_id, d.doc_id, round(sum(q.n * idf * d.n * 2.2
        / (d.n + 1.2 * (0.25 + 0.75 * len / (select total / docs from corpus)))), 6) as score
    from tf q join tf d using (term) join idf using (term) join lengths on lengths.doc_id = d.doc_id
    where q.doc_id % 100 = 0 group by all)
select query_id, cast(row_number() over (partition by query_id order by score desc, doc_id) as integer) as rank, doc_id, score
from scored qualify rank <= 10
"""
