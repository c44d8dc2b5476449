"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from gearyard.llm.sharding import SHARDS, lookup_table, table_size

ORACLE: dict[str, str] = {}

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

_STOPS = ", ".join(f"'{w}'" for w in sorted({form for word in (
    "the of and to in is that it for as with on be at by this are was "
    "der die und das ist nicht ein eine zu den mit von auf für sich im des dem "
    "le la les de des et en un une du que est dans pour qui sur pas au avec "
    "el los las y del por con para su al lo se una"
).split() for form in (word, word.capitalize(), word.upper())}))

ORACLE["op3_quality_rules"] = rf"""
with w as (
  select doc_id, coalesce(text, '') as text, {_WORDS} as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from documents
), windows as (
  select doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i : i + 2])) as win,
         unnest(range(1, len(w) - 1)) as i
  from w
), again as (
  select doc_id, i from (select *, count(*) over (partition by doc_id, win) as n from windows) where n > 1
), covered as (
  select doc_id, count(distinct i + k) as n from again, (select unnest([0, 1, 2]) as k) group by doc_id
), m as (
  select w.doc_id, len(w.w)::bigint as n_words, length(array_to_string(w.w, ''))::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         coalesce(c.n, 0)::bigint as n_repeat_words, len(lines) as n_lines,
         length(regexp_replace(text, '[^!?]+', '', 'g')) as n_exclaims,
         length(regexp_replace(text, '[^|]+', '', 'g')) as n_bars,
         length(regexp_replace(text, '\P{{Lu}}+', '', 'g')) as n_upper,
         len(list_filter(w.w, lambda x: x in ({_STOPS}))) as n_stops
  from w left join covered c on c.doc_id = w.doc_id
), b as (
  select *, n_words < 50 or n_repeat_words * 100 > n_words * 50 as base_failed from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and word_chars between 2 * n_words and 12 * n_words and n_symbols <= 0.1 * n_words
       and n_exclaims <= 0.5 * n_words and n_upper <= 0.5 * word_chars and n_stops >= 0.02 * n_words
       and n_dup_lines <= 0.5 * n_lines and n_bars <= 0.1 * n_words as kept
from b
"""

_SLOTS = table_size(SHARDS)
ORACLE["op5_sharding"] = f"""
select doc_id, {lookup_table([f"shard-{i}" for i in range(SHARDS)], _SLOTS)}[
  (('0x' || substr(md5(coalesce(doc_id::varchar, md5(coalesce(text, '')))), 1, 15))::bigint % {_SLOTS} + 1)::int
]::int as shard
from documents
"""

ORACLE["op1_decontamination"] = r"""
with items as (
  select min(item_id) as item_id, w
  from (select item_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from benchmark)
  group by w
), shingles as (
  select item_id, s, count(*) over (partition by item_id) as n_shingles
  from (select distinct item_id, unnest(case when len(w) between 1 and 4 then [w]
                                            else list_transform(range(1, len(w) - 3), lambda i: w[i : i + 4]) end) as s from items)
), docs as (
  select doc_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
), held as (
  select distinct doc_id, s from (
    select doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: w[i : i + 4])) as s from docs
    union all
    select doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i : i + k - 1])) as s
    from docs, (select distinct len(w) as k from items where len(w) between 1 and 4)
  )
)
select doc_id, item_id, count(*) as n_shared, n_shingles, count(*) / n_shingles::double as containment
from held join shingles using (s)
group by doc_id, item_id, n_shingles
having count(*) >= 0.8 * n_shingles - 1e-9
"""

ORACLE["op10_near_dup"] = r"""
with recursive docs as (
  select doc_id, coalesce(text, '') as text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
), texts as (select min(doc_id) as t, any_value(w) as w from docs group by text),
shingled as (
  select t, unnest(case when len(w) between 1 and 4 then [w]
                        else list_transform(range(1, len(w) - 3), lambda i: w[i : i + 4]) end) as s from texts
), counted as (select t, s, count(*) as c from shingled group by t, s),
totals as (select t, sum(c) as n from counted group by t),
links as (
  select a.t as a, b.t as b
  from counted a join counted b on a.s = b.s and a.t <> b.t
  join totals x on x.t = a.t join totals y on y.t = b.t
  group by a.t, b.t, x.n, y.n
  having sum(least(a.c, b.c)) >= 0.8 * (x.n + y.n - sum(least(a.c, b.c))) - 1e-9
), reached(node, root) as (
  select t, t from texts
  union
  select links.b, reached.root from reached join links on links.a = reached.node
)
select d.doc_id, c.class_id
from docs d join (select text, min(doc_id) as t from docs group by text) x on x.text = d.text
join (select node, min(root) as class_id from reached group by node) c on c.node = x.t
"""

ORACLE["op4_line_dedup"] = r"""
with lines as (
  select doc_id, i, line
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
               unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) as i from documents)
  where regexp_matches(line, '[^\x20\x09-\x0D]')
), texts as (
  select line, min((doc_id, i)) as first, length(line) as n from lines group by line
), links as (
  select a.line as a, b.line as b, b.first as other
  from texts a join texts b on a.n between b.n - 2 and b.n + 2 and a.line <> b.line
  where a.n >= 24 and b.n >= 24 and levenshtein(a.line, b.line) <= 2
), told as (
  select a as line, count(*) as links, min(other) as earliest from links group by a
), marked as (
  select l.doc_id, (l.doc_id, l.i) = t.first as leads, coalesce(k.earliest < t.first, false) as near, coalesce(k.links, 0) as links
  from lines l join texts t using (line) left join told k using (line)
)
select d.doc_id, count(leads) as n_lines, count_if(not leads)::bigint as n_equal, count_if(leads and near)::bigint as n_near,
       coalesce(sum(links) filter (leads), 0)::bigint as n_links,
       (count(leads) - count_if(not leads) - count_if(leads and near))::bigint as n_kept
from documents d left join marked m on m.doc_id = d.doc_id
group by d.doc_id
"""
