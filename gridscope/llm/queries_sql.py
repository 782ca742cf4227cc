"""DuckDB SQL for the queries that SQL can express, written from their definitions."""

_STOP = ("the of and to in a is that for it was on with as be at by this are or from an he not you der die und das den von zu mit "
         "auf ist im ein eine nicht des dem für le la les de et un une en du que qui dans par pour sur au est avec "
         "el los las y se una del por con para su como al lo no").split()

SQL: dict[str, str] = {}

SQL["op1_url_filters"] = r"""
with urls as (
  select page_id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) as host,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*/)', 1)) as folder,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]+/)', 1)) as part,
         timestamp '2024-01-01' + to_days((('0x' || substr(md5(coalesce(url, '')), 1, 7))::bigint % 366)::int) as fetched
  from pages),
named as (
  select distinct 'block' as list, host as pattern, 3 as share, [0, 60, 120] as days from urls where host <> ''
  union all
  select distinct 'block', regexp_extract(host, '^[^.]+[.](.+[.].+)$', 1), 4, [30, 130] from urls
  where regexp_extract(host, '^[^.]+[.](.+[.].+)$', 1) <> ''
  union all
  select distinct 'allow', host || part, 2, [10, 200] from urls where host <> '' and part <> ''),
numbered as (select *, ('0x' || substr(md5(pattern), 1, 7))::bigint % 1000000 as n from named),
changes as (
  select list, pattern, n % 200 + unnest(days) as day, unnest(range(len(days))) % 2 = 1 as removed from numbered where n % share = 0),
moments as (select list, pattern, day, bool_or(removed) as removed from changes group by all),
valid as (
  select list, pattern, timestamp '2024-01-01' + to_days(day::int) as since,
         coalesce(timestamp '2024-01-01' + to_days((lead(day) over (partition by list, pattern order by day))::int),
                  timestamp '9999-12-31') as until, removed
  from moments),
tails as (
  select page_id, url, fetched, list_aggregate(labels[i:], 'string_agg', '.') as pattern
  from (select *, string_split(host, '.') as labels from urls where host <> ''), unnest(range(1, len(labels) + 1)) as t(i)
  union
  select page_id, url, fetched, host || list_aggregate(parts[:i], 'string_agg', '/') || '/'
  from (select *, string_split(folder, '/') as parts from urls where host <> '' and folder <> ''), unnest(range(1, len(parts))) as t(i)),
met as (
  select t.page_id, t.url, v.list, v.pattern, v.since
  from tails t join valid v on t.pattern = v.pattern and v.since <= t.fetched and t.fetched < v.until where not v.removed),
best as (
  select page_id, url, count(*) as n, arg_max((list, pattern, since), (length(pattern), list = 'allow', pattern, list, since)) as b
  from met group by all)
select u.page_id, u.fetched, coalesce(b[1] <> 'allow', false) as blocked, b[1] as list, b[2] as pattern, b[3] as since,
       coalesce(n, 0) as n_active
from urls u left join best on u.page_id is not distinct from best.page_id and u.url is not distinct from best.url
"""

SQL["op4_substring_dedup"] = r"""
with pieces as (
  select doc_id, text, unnest(string_split(regexp_replace(text, '([.!?…])[ \t\r]', '\1' || chr(10), 'g'), chr(10))) as piece,
         unnest(range(len(string_split(regexp_replace(text, '([.!?…])[ \t\r]', '\1' || chr(10), 'g'), chr(10))))) as number
  from documents),
placed as (
  select *, coalesce(sum(length(piece) + 1) over (partition by doc_id order by number rows between unbounded preceding and 1 preceding), 0)::int as start,
         regexp_extract_all(lower(piece), '[^\s]+') as found from pieces),
units as (
  select doc_id, number, start, length(piece) as size, len(found) as words, list_aggregate(found, 'string_agg', ' ') as unit,
         row_number() over (partition by doc_id order by number) as place
  from placed where len(found) > 0),
ranked as (select *, row_number() over (partition by unit order by doc_id, place) > 1 as later from units),
runs as (
  select *, place - row_number() over (partition by doc_id order by place) as run from ranked where later),
gone as (
  select doc_id, number, start, size from (select *, sum(words) over (partition by doc_id, run) as held from runs) where held >= 20),
kept as (
  select p.doc_id, p.number, p.start, p.piece, substr(p.text, p.start + length(p.piece) + 1, 1) as after,
         lead(p.number) over (partition by p.doc_id order by p.number) is null as last
  from placed p left join gone g on p.doc_id = g.doc_id and p.number = g.number where g.number is null),
texts as (select doc_id, string_agg(piece || case when last then '' else after end, '' order by number) as text from kept group by doc_id),
spans as (select doc_id, count(*) as n, string_agg(start || ':' || (start + size), ',' order by start) as removed from gone group by doc_id)
select d.doc_id, coalesce(s.n, 0) as n_removed, coalesce(s.removed, '') as removed,
       case when d.text is null then null else coalesce(t.text, '') end as text
from documents d left join texts t on d.doc_id = t.doc_id left join spans s on d.doc_id = s.doc_id
"""

SQL["op6_quality_rules"] = rf"""
with split as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') as ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) as ls from documents),
windows as (
  select doc_id, i, list_aggregate(ws[i:i + 4], 'string_agg', ' ') as w from split, unnest(range(1, len(ws) - 3)) as r(i)),
again as (
  select doc_id, count(distinct i + k) as n from
    (select doc_id, i, count(*) over (partition by doc_id, w) as c from windows), unnest(range(5)) as r(k) where c > 1 group by doc_id),
counts as (
  select s.doc_id, len(ws) as n_words, list_sum(list_transform(ws, lambda x: length(x))) as chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
         len(ls) - len(list_distinct(ls)) as n_dup, len(ls) as n_lines, coalesce(n, 0) as n_rep,
         len(list_filter(ws, lambda x: lower(x) in ({", ".join(f"'{w}'" for w in _STOP)}))) as n_stop,
         len(list_filter(ls, lambda x: regexp_matches(x, '^[ \t-\r]*[-*•]|([.][.][.]|…)[ \t-\r]*$'))) as n_marked
  from split s left join again using (doc_id)),
judged as (select *, n_words < 10 or 100 * n_rep > 20 * n_words as failed from counts)
select doc_id, n_words::bigint as n_words, coalesce(chars, 0)::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup::bigint as n_dup_lines,
       n_rep::bigint as n_repeat_words, failed as base_failed,
       not failed and chars between 2 * n_words and 14 * n_words and n_symbols <= 0.25::double * n_words
       and (n_words < 50 or (n_stop / n_words >= 0.02::double and n_dup / n_lines <= 0.5::double and n_marked / n_lines <= 0.9::double)) as kept
from judged
"""

SQL["op12_warc"] = r"""
with held as (
  select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as hex, max(page_id) over (partition by coalesce(html, '')) as of
  from pages),
fives as (
  select *, list_transform(range(8), lambda i: ('0x' || substr(hex, i * 5 + 1, 5))::int) as parts,
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' as signs from held)
select page_id, octet_length(encode(payload))::bigint as payload_bytes,
       array_to_string(list_transform(parts, lambda p: substr(signs, (p >> 15) % 32 + 1, 1) || substr(signs, (p >> 10) % 32 + 1, 1)
                                              || substr(signs, (p >> 5) % 32 + 1, 1) || substr(signs, p % 32 + 1, 1)), '') as payload_digest,
       case when of <> page_id then 'revisit' else 'response' end as record_type, case when of <> page_id then of end as refers_to
from fives
"""

SQL["op13_lexical_search"] = r"""
with docs as (
  select doc_id, row_number() over () as row,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
items as (
  select distinct item_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from benchmark),
whole as (select count(*) as n, sum(len(terms))::bigint as l from docs where len(terms) > 0),
asked as (select item_id, text, term, count(*) as again from (select item_id, text, unnest(terms) as term from items) group by all),
tf as (
  select row, doc_id, term, count(*) as tf, any_value(n) as n
  from (select row, doc_id, len(terms) as n, unnest(terms) as term from docs) where term in (select term from asked) group by all),
df as (select term, count(*) as df from tf group by term),
scored as (
  select a.item_id, a.text, t.row, t.doc_id,
         sum(a.again * floor(1000 * ln((2 * w.n + 2) / (2 * d.df + 1)))::bigint
             * ((1000000000 * t.tf) // (1000 * t.tf + 12 * (75 + (25 * t.n * w.n) // w.l))))::bigint as score
  from asked a join tf t on a.term = t.term join df d on a.term = d.term cross join whole w group by all)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by item_id, text order by score desc, doc_id nulls last) as rank from scored where score > 0)
where rank <= 20
"""
