"""SQL for the queries of the numbered operators that SQL can state."""

#: Windows of 20 words are compared as text; the words of a text hold no space, so the join of two unlike windows differs.
OP2 = r"""
with d as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
win as (select doc_id, unnest(range(1, len(w) - 18)) as s, w from d where len(w) >= 20),
keyed as (select doc_id, s, md5(array_to_string(list_slice(w, s, s + 19), ' ')) as k from win),
firsts as (select k, min(doc_id) as f, arg_min(s, (doc_id, s)) as fs from keyed group by k having count(*) > 1),
again as (select x.doc_id, x.s from keyed x join firsts y on x.k = y.k where x.doc_id > y.f or x.s > y.fs),
gone as (select distinct doc_id, unnest(range(s, s + 20)) as p from again),
lists as (select doc_id, list(p) as ps, count(*) as n from gone group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed,
  sha256(case when n is null then array_to_string(w, ' ') else array_to_string(list_filter(w, lambda x, i: not list_contains(ps, i)), ' ') end) as kept_sha256
from d left join lists on d.doc_id = lists.doc_id
"""

#: Exact Jaccard similarities over shared shingles, then components by the least id that links reach.
OP3 = r"""
with recursive d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
grams as (
  select distinct doc_id, md5(array_to_string(list_slice(w, i, i + 4), ' ')) as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from d where len(w) > 0)),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as m from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as (select a, b from shared join sizes x on a = x.doc_id join sizes y on b = y.doc_id where 100 * m >= 75 * (x.n + y.n - m)),
ways as (select a, b from links union all select b, a from links),
reach(node, other) as (select a, b from ways union select reach.node, ways.b from reach join ways on reach.other = ways.a),
least as (select node, min(least(node, other)) as c from reach group by node)
select d.doc_id, coalesce(n, 0) as n_shingles, coalesce(c, d.doc_id) as component_id, coalesce(c, d.doc_id) = d.doc_id as kept
from d left join sizes on d.doc_id = sizes.doc_id left join least on d.doc_id = least.node
"""

#: The list follows the rule that the query states; each capture meets the entries for its URL that hold at its day.
OP9 = r"""
with cut as (
  select page_id, url, substr(url, strpos(url, '://') + 3) as rest from pages),
p as (
  select page_id, url, nullif(lower(case when auth like '[%' then string_split(auth, ']')[1] || ']' else rtrim(string_split(auth, ':')[1], '.') end), '') as host,
    list_filter(string_split(string_split(string_split(substr(rest, length(whole) + 1), '?')[1], '#')[1], '/'), lambda x: x <> '') as steps,
    cast(date '2024-01-01' + cast(('0x' || substr(md5(url), 1, 6))::bigint % 366 as integer) as date) as fetched_at
  from (select *, string_split(whole, '@')[-1] as auth from (select *, string_split(string_split(string_split(rest, '/')[1], '?')[1], '#')[1] as whole from cut))),
raw as (
  select distinct unnest([host, case when len(steps) > 0 then host || '/' || steps[1] else host || '/' end, array_to_string(string_split(host, '.')[2:], '.')]) as entry from p),
entries as (select entry, ('0x' || substr(md5(entry), 1, 6))::bigint as n from raw where entry is not null and entry <> '' and ('0x' || substr(md5(entry), 1, 6))::bigint % 2 = 0),
events as (
  select entry as entry, 'add' as action, cast(date '2024-01-01' + cast(n // 7 % 180 as integer) as date) as day from entries
  union select entry, 'remove', cast(date '2024-01-01' + cast(n // 7 % 180 + 60 as integer) as date) from entries where n % 3 < 2
  union select entry, 'add', cast(date '2024-01-01' + cast(n // 7 % 180 + 120 as integer) as date) from entries where n % 3 = 1),
changes as (select * from (select *, lag(action) over (partition by entry order by day, action desc) as before from events) where before is distinct from action),
spans as (select * from (select entry, action, day as valid_from, lead(day) over (partition by entry order by day, action desc) as valid_to from changes) where action = 'add' and (valid_to is null or valid_to > valid_from)),
parts as (
  select page_id, url, host, fetched_at, string_split(host, '.') as labels, steps from p where host is not null),
keyed as (
  select distinct page_id, fetched_at, unnest(list_concat(
    list_transform(range(1, len(labels) + 1), lambda i: array_to_string(list_slice(labels, i, len(labels)), '.')),
    list_transform(range(1, len(steps) + 1), lambda i: host || '/' || array_to_string(list_slice(steps, 1, i), '/')))) as entry
  from parts),
active as (
  select page_id, count(distinct k.entry) as n, arg_min(k.entry, (-length(k.entry), k.entry)) as entry
  from keyed k join spans s on k.entry = s.entry and fetched_at >= valid_from and (valid_to is null or fetched_at < valid_to) group by page_id)
select p.page_id, host, fetched_at, coalesce(n, 0) as n_active, entry, entry is not null as blocked from p left join active on p.page_id = active.page_id
"""

#: DuckDB has no CRC-32, so the SQL takes it bit by bit: 8 steps a byte, folded over the bytes of each distinct word.
OP13 = r"""
with recursive
d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
dw as (select doc_id, unnest(w) as word from d),
bw as (select unnest(w) as word from b),
step(i, v, n) as (
  select i, i, 0 from (select unnest(range(0, 256))::bigint as i)
  union all select i, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, n + 1 from step where n < 8),
tab as (select list(v order by i) as t from step where n = 8),
vocab as (select distinct word, hex(encode(word)) as h from (select word from dw union all select word from bw)),
placed as (
  select word, xor(4294967295, list_reduce(
      list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint),
      lambda acc, x: xor(t[(xor(acc, x) & 255) + 1], acc >> 8), 4294967295::bigint)) % 10000 as bucket
  from vocab, tab),
s as (select bucket, count(*) as c from dw join placed using (word) group by bucket),
t as (select bucket, count(*) as c from bw join placed using (word) group by bucket),
gain as (
  select bucket, cast(floor(1000 * ln((coalesce(t.c, 0) + 1)::double * ((select count(*) from dw) + 10000)::double / ((coalesce(s.c, 0) + 1)::double * ((select count(*) from bw) + 10000)::double))) as bigint) as g
  from (select unnest(range(0, 10000)) as bucket) left join s using (bucket) left join t using (bucket)),
sums as (select doc_id, sum(g)::bigint as g from dw join placed using (word) join gain using (bucket) group by doc_id),
scored as (
  select doc_id, len(w)::bigint as n_features,
    coalesce((g - ((g % len(w)) + len(w)) % len(w)) // len(w), 0)::bigint as weight,
    ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint as h
  from d left join sums using (doc_id)),
noisy as (select doc_id, n_features, weight, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))) as bigint) as score from scored),
ranked as (select doc_id, row_number() over (order by score desc, doc_id) as r from noisy where n_features >= 20)
select doc_id, n_features, weight, score, case when r <= 10 * (select count(*) from ranked) // 100 then r end as rank
from noisy left join ranked using (doc_id)
"""

#: Every group against every kept term of its language, in whole numbers of 128 bits.
OP11 = r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
teams as (select distinct lang, source from d),
words as (select r, lang, source, unnest(w) as term from d),
kept as (select lang, term from words group by lang, term having count(distinct r) >= 3),
v as (select lang, count(*) as v from kept group by lang),
c as (select lang, source, term, count(*) as c from words semi join kept using (lang, term) group by all),
grid as (select t.lang, t.source, k.term, coalesce(c.c, 0) as c from teams t join kept k using (lang) left join c on c.lang = t.lang and c.source = t.source and c.term = k.term),
n as (select lang, source, sum(c)::hugeint as n from grid group by lang, source),
p as (select lang, source, term, c, 1 + (1000000000::hugeint * (c + 1)) // (n + v) as p from grid join n using (lang, source) join v using (lang)),
whole as (select lang, sum(n)::hugeint as n from n group by lang),
q as (select lang, term, 1 + (1000000000::hugeint * (sum(c)::hugeint + 1)) // (any_value(n) + any_value(v)) as q from grid join whole using (lang) join v using (lang) group by lang, term),
sums as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value from teams a join teams b on a.lang = b.lang and a.source <> b.source left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // q)::bigint as value from p join q using (lang, term) where c > 0 and p > q),
ranked as (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from (select * from pairs union all select * from terms))
select * from ranked where part = 'pair' or rank <= 200
"""

#: Every query against every vector.
OP12 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * x::double) as bigint)) as x from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
q as (select vec_id as query_id, x as y from v where vec_id % 100 = 0),
s as (select query_id, vec_id, cast(list_sum(list_transform(list_zip(x, y), lambda p: p[1] * p[2])) as bigint) as score from q join v on query_id <> vec_id),
r as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s)
select * from r where rank <= 10
"""

ORACLE_SQL: dict[str, str] = {"op2_substring_dedup": OP2, "op3_near_dedup": OP3, "op9_url_filters": OP9, "op11_divergence_audit": OP11, "op12_cover_tree": OP12, "op13_importance_resampling": OP13}
