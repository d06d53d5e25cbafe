"""DuckDB statements for the queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op3_url_filter"] = """
with parts as (
  select page_id,
    case when strpos(coalesce(url, ''), '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
hosts as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from parts),
urls as (
  select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path
  from hosts),
rules(verdict, h, p) as (
  values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits as (
  select page_id, max(struct_pack(n := length(h || p), verdict := verdict, rule := h || p)) as best
  from urls join rules on (host = h or host like '%.' || h) and starts_with(path, p)
  group by page_id)
select u.page_id, host, path, best.rule as rule, coalesce(best.verdict, 'allow') as verdict
from urls u left join fits f on u.page_id = f.page_id
"""

ORACLES["op8_decontaminate"] = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
items as (select item_id, w, least(len(w), 10) as n from b where len(w) > 0),
item_windows as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as win
  from items, unnest(range(1, cast(len(w) - n + 2 as bigint))) t(i)),
sizes as (select distinct n from item_windows),
doc_windows as (
  select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as win
  from d, sizes, unnest(range(1, cast(greatest(len(w) - n + 2, 1) as bigint))) t(i)),
hits as (select doc_id, item_id, i, d.n as n from doc_windows d join item_windows b on d.n = b.n and d.win = b.win),
hit_words as (select doc_id, count(distinct i + k) as n_hit from hits, unnest(range(0, cast(n as bigint))) t(k) group by doc_id),
hit_items as (
  select doc_id, count(distinct item_id) as n_items,
    string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as names
  from hits group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit_words h on d.doc_id = h.doc_id left join hit_items i on d.doc_id = i.doc_id
"""

#: crc32 of a blob given as hexadecimal digits, by the usual table of 256 entries (built by its rule)
_CRC = r"""
crc_table as (
  select list(list_reduce(range(0, 8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b) order by b) as t
  from range(0, 256) r(b)),
"""
_CRC_OF = """xor(list_reduce(list_transform(range(0, cast(length({hex}) // 2 as bigint)),
      lambda k: cast('0x' || substr({hex}, 2 * k + 1, 2) as bigint)),
    lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]), cast(4294967295 as bigint)), 4294967295)"""
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op11_spelling"] = r"""
with recursive """ + _CRC + r"""
runs as (
  select doc_id, unnest(regexp_extract_all(""" + _LOWER + r""", '[a-z\x{00C0}-\x{00FF}]+')) as run from documents),
counted as (select doc_id, run, count(*) as n, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || run)) as x from runs group by doc_id, run),
hashed as (select run, n, """ + _CRC_OF.format(hex="x") + r""" as h from counted, crc_table),
typed as (
  select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from hashed),
words as (select word, cast(sum(n) as bigint) as n from typed group by word having sum(n) >= 3 and length(word) >= 5),
rests as (
  select word, n, length(word) as l, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from words, unnest(range(1, cast(length(word) + 1 as bigint))) t(i)),
pairs as (
  select a.word, b.word as near, b.n as near_n from rests a join rests b on a.rest = b.rest and a.i = b.i and a.l = b.l and a.word <> b.word
  union select a.word, b.word, b.n from rests a join words b on a.rest = b.word
  union select b.word, a.word, a.n from rests a join words b on a.rest = b.word),
best as (
  select word, count(*) as n_near, min(struct_pack(m := -near_n, w := near)) as b from pairs group by word),
forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when -b.m >= 2 * w.n then b.w end as form,
    case when -b.m >= 2 * w.n then -b.m end as form_n
  from words w left join best using (word)),
walk(word, place) as (
  select word, word from forms
  union all
  select walk.word, f.form from walk join forms f on walk.place = f.word where f.form is not null),
roots as (select walk.word, walk.place as root from walk join forms f on walk.place = f.word where f.form is null)
select word, form, root, n, n_near, form_n from forms join roots using (word)
"""

ORACLES["op12_resample"] = r"""
with """ + _CRC + r"""
texts as (
  select false as target, doc_id, regexp_extract_all(""" + _LOWER + r""", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
  union all
  select true, null, regexp_extract_all(""" + _LOWER + r""", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
counted as (select target, doc_id, word, count(*) as n from (select target, doc_id, unnest(w) as word from texts) group by all),
hashes as (select word, """ + _CRC_OF.format(hex="x") + r""" % 10000 as bucket
  from (select distinct word, hex(encode(word)) as x from counted), crc_table),
totals as (
  select bucket, sum(case when target then 0 else n end) as s, sum(case when target then n else 0 end) as t
  from counted join hashes using (word) group by bucket),
gains as (
  select bucket, floor(1000 * ln((t + 1.0::double) * (sum(s) over () + 10000)::double / ((s + 1.0::double) * (sum(t) over () + 10000)::double))) as gain
  from totals),
weights as (
  select doc_id, cast(sum(n * gain) as bigint) as weight from counted join hashes using (word) join gains using (bucket) where not target group by doc_id),
scored as (
  select d.doc_id, len(w) as n_features, coalesce(weight, 0) as weight,
    cast(coalesce(weight, 0) + floor(-1000 * ln(-ln((cast('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) as bigint) + 0.5::double) / 4294967296.0::double))) as bigint) as score
  from texts d left join weights using (doc_id) where not target),
ranked as (
  select doc_id, row_number() over (order by score desc, doc_id) as r, 10 * count(*) over () // 100 as drawn from scored where n_features >= 20)
select s.doc_id, cast(n_features as bigint) as n_features, weight, score, cast(case when r <= drawn then r end as bigint) as rank
from scored s left join ranked r using (doc_id)
"""

ORACLES["op13_mixing"] = r"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents),
sources as (
  select source, cast(sum(size) as bigint) as source_size, list_value(5, 2, 1)[1 + (row_number() over (order by source nulls last) - 1) % 3] as w
  from d group by source),
ordered as (
  select *, row_number() over (order by 3.0::double * source_size / w, source nulls last) as k from sources),
levels as (
  -- if the k - 1 sources that meet their limits first are at their limits, the others share the rest
  select *, (sum(source_size) over () - coalesce(sum(3 * source_size) over (order by k rows between unbounded preceding and 1 preceding), 0))::double
    / (sum(w) over (order by k rows between current row and unbounded following))::double as level
  from ordered),
last as (select min(k) as k0 from levels where w * level <= 3.0::double * source_size),
targets as (
  select source, source_size, case when k < k0 then 3.0::double * source_size else w * (select level from levels where k = k0) end as target
  from levels, last),
placed as (
  select doc_id, size, source_size, target, case when source_size > 0 then target / source_size else 0.0::double end as rate,
    row_number() over (partition by d.source order by size, doc_id) as i,
    cast('0x' || substr(sha256(concat_ws(':', '13', d.source)), 1, 8) as bigint)::double / 4294967296.0::double as u
  from d join targets t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
  cast((floor(rate) + floor((rate - floor(rate)) * i + u) - floor((rate - floor(rate)) * (i - 1) + u)) * size as bigint) as taken
from placed
"""
