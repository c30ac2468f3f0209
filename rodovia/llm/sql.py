"""DuckDB SQL for the registered queries that SQL can express on whole tables."""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles(name: str, table: str, key: str) -> str:
    """CTEs ``name`` (key, shingle): the distinct five-word shingles of a table's texts."""
    return f"""
{name}_words as (
  select {key}, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as w from {table} where text is not null),
{name} as (
  select distinct {key}, unnest(case
    when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as shingle
  from {name}_words)"""


OP1 = f"""
with {_shingles("d", "documents", "doc_id")}, {_shingles("b", "benchmark", "item_id")},
n as (select item_id, count(*) as n_shingles from b group by item_id),
hits as (select doc_id, item_id, count(*) as n_common from d join b using (shingle) group by doc_id, item_id)
select doc_id, item_id, n_shingles, n_common from hits join n using (item_id) where 100 * n_common >= 75 * n_shingles
"""

OP2 = f"""
with recursive {_shingles("s", "documents", "doc_id")},
n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (
  select x.doc_id as a, y.doc_id as b, count(*) as common
  from s x join s y on x.shingle = y.shingle and x.doc_id <> y.doc_id group by x.doc_id, y.doc_id),
links as (
  select a, b from pairs join n p on p.doc_id = a join n q on q.doc_id = b
  where 100 * common >= 75 * (p.n + q.n - common)),
reach(a, b) as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a),
low as (select a as doc_id, min(b) as low from reach group by a)
select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(low, doc_id)) as component_id,
       least(doc_id, coalesce(low, doc_id)) = doc_id as kept
from documents left join n using (doc_id) left join low using (doc_id)
"""

OP3 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id),
ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

OP7 = """
with u as (
  select page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
rules(rule_host, rule_path, verdict) as (values
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
select page_id, any_value(host) as host, any_value(path) as path,
       arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
       coalesce(arg_max(verdict, length(rule_host || rule_path)), 'allow') as verdict
from u left join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
group by page_id
"""

OP10 = """
with d as (select row_number() over () as r, doc_id, source, text, string_split(text, chr(10)) as l from documents),
lines as (
  select distinct r, source, trim(x) as x
  from (select r, source, unnest(l) as x from d where source is not null) where trim(x) <> ''),
totals as (select source, count(*) as pages from documents group by source),
common as (
  select source, x from (select source, x, count(*) as n from lines group by source, x) join totals using (source)
  where n >= 3 and n > 0.05 * pages),
lost as (select r, list(x) as lost from lines join common using (source, x) group by r),
kept as (
  select doc_id, source, text, l,
         list_filter(l, lambda x: trim(x) = '' or not list_contains(coalesce(lost, []), trim(x))) as k
  from d left join lost using (r))
select doc_id, source, coalesce(len(l), 0) as n_lines, coalesce(len(l) - len(k), 0) as n_dropped,
       case when text is not null then md5(array_to_string(k, chr(10))) end as kept_md5
from kept
"""

OP11 = f"""
with recursive runs as (
  select doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) as run from documents where text is not null),
counted as (select doc_id, run, count(*) as k, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || run)) as x from runs group by doc_id, run),
hashed as (
  select run, k, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(0, len(x) // 2), lambda i: cast('0x' || substr(x, 2 * i + 1, 2) as bigint))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)), lambda y, j: xor(y >> 1, 3988292384 * (y & 1))))) as h
  from counted),
written as (
  select case when h % 199 = 0 then substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) else run end as word, k from hashed),
words as (select word, cast(sum(k) as bigint) as n from written where len(word) >= 6 group by word having sum(k) >= 5),
lacking as (select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as part from (select word, unnest(range(1, len(word) + 1)) as i from words)),
pairs as (
  select lacking.word, b.word as near from lacking join words b on part = b.word
  union select b.word, lacking.word from lacking join words b on part = b.word
  union select a.word, b.word from lacking a join lacking b on a.part = b.part and a.i = b.i and a.word <> b.word),
ranked as (
  select pairs.word, near, w.n as near_n, count(*) over (partition by pairs.word) as n_near,
         row_number() over (partition by pairs.word order by w.n desc, encode(near)) as r
  from pairs join words w on w.word = near),
forms as (
  select words.word, n, coalesce(n_near, 0) as n_near, case when near_n >= 5 * n then near end as form,
         case when near_n >= 5 * n then near_n end as form_n
  from words left join ranked on ranked.word = words.word and r = 1),
chain(word, last, step) as (
  select word, word, 0 from forms union all select chain.word, form, step + 1 from chain join forms on forms.word = last where form is not null)
select forms.word, form, root, n, n_near, form_n from forms join (select word, arg_max(last, step) as root from chain group by word) using (word)
"""

OP12 = """
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
windows as (
  select r, doc_id, i, array_to_string(w[i:i + 49], ' ') as s
  from (select r, doc_id, w, unnest(range(1, len(w) - 48)) as i from d where doc_id is not null)),
late as (
  select r, i from windows join (select s, min(doc_id) as low from windows group by s) using (s) where low < doc_id),
gone as (select distinct r, unnest(range(i, i + 50)) as p from late),
places as (select r, list(p) as p from gone group by r),
kept as (
  select doc_id, len(w) as n_words, coalesce(len(p), 0) as n_removed,
         case when p is null then w
              else list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: not list_contains(p, x[2])), lambda x: x[1])
         end as k
  from d left join places using (r))
select doc_id, n_words, n_removed, sha256(array_to_string(k, ' ')) as kept_sha256 from kept
"""

_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP13 = f"""
with d as (select row_number() over () as r, doc_id, {_TERMS} as t from documents where doc_id is not null and text is not null),
p as (select r, doc_id, len(t) as n, t from d where len(t) > 0),
total as (select count(*) as docs, cast(sum(n) as bigint) as terms from p),
tf as (select r, term, count(*) as tf from (select r, unnest(t) as term from p) group by r, term),
weight as (
  select term, cast(floor(1000 * ln(cast(2 * docs + 2 as double) / cast(2 * df + 1 as double))) as bigint) as w
  from (select term, count(*) as df from tf group by term), total),
asked as (select distinct item_id, unnest({_TERMS}) as term from benchmark where item_id is not null and text is not null),
scored as (
  select item_id, r, any_value(doc_id) as doc_id,
         cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) as bigint) as score
  from asked join weight using (term) join tf using (term) join p using (r), total group by item_id, r),
ranked as (
  select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank
  from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""

SQL: dict[str, str] = {
    "op1_benchmark_decontamination": OP1, "op2_minhash_near_dedup": OP2, "op3_exact_top_k": OP3,
    "op7_url_filter": OP7, "op10_line_dedup": OP10, "op11_spelling_variants": OP11, "op12_substring_dedup": OP12,
    "op13_ranked_lexical_search": OP13,
}
