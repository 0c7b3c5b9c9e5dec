"""Registered queries of this subpackage: one per operator, each over its
whole table, with the DuckDB statement where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import (
    exact_dedup,
    filter_audit,
    langid,
    mixing,
    near_dedup,
    packing,
    pii,
    quality_rules,
    quote_threads,
    resampling,
    set_join,
    suffix_dedup,
    url_filter,
)
from ledgerloom.llm.common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op4_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_threads.link(table(spark, sf_dir, "conversations"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest_pieces(packing.pack(table(spark, sf_dir, "documents")))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.report(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.group_documents(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents"))


def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.group(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_language_id,
        op3_pii,
        op4_quote_threads,
        op5_url_filter,
        op6_packing,
        op7_near_dedup,
        op8_exact_dedup,
        op9_quality_rules,
        op10_mixing,
        op11_ngram_jaccard,
        op12_importance_resampling,
        op13_filter_audit,
    )
}

SQL: dict[str, str] = {}

SQL["op8_exact_dedup"] = r"""
with d as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over (partition by text_sha256) as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       row_number() over (partition by text_sha256 order by doc_id nulls last) = 1 as kept, text_sha256
from d
"""

SQL["op10_mixing"] = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'n' || coalesce(text, ''))), 1, 15)) as bigint) as hash
  from documents),
s as (
  select source, sum(size) as source_size, row_number() over (order by source nulls last) as nth from d group by source),
w as (select *, [3, 1, 2][(nth - 1) % 3 + 1] as w, 2 * source_size as cap from s),
r as (select *, cap / w as ratio from w),
k as (
  select *, row_number() over (order by ratio, nth) as k,
         (1.5 * sum(source_size) over () - coalesce(sum(cap) over (
            order by ratio, nth rows between unbounded preceding and 1 preceding), 0))::double
         / (sum(w) over (order by ratio, nth rows between current row and unbounded following))::double as level
  from r),
lam as (select level from k where level <= ratio order by k limit 1),
t as (
  select source, source_size::bigint as source_size, least(cap::double, coalesce((select level from lam), 0) * w) as target
  from k),
b as (
  select *, case when target >= source_size then 1 else 0 end as base,
         floor(target)::bigint - case when target >= source_size then source_size else 0 end as budget
  from t),
c as (
  select d.doc_id, d.size, d.hash, b.source_size, b.target, b.base, b.budget,
         (sum(size) over (partition by d.source order by hash range between unbounded preceding and current row))::bigint as upto,
         (sum(size) over (partition by d.source, hash))::bigint as tied
  from d join b on d.source is not distinct from b.source)
select doc_id, size::bigint as size, source_size, target,
       (base * size + case when upto <= budget then size
                           when upto - tied >= budget then 0
                           else ((budget - (upto - tied)) * size) // greatest(tied, 1) end)::bigint as taken
from c
"""

SQL["op5_url_filter"] = r"""
with p as (
  select page_id, url, case when url like '%://%' then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (
  select page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
         regexp_extract(coalesce(url, ''), '^[^?#]*(\?[^#]*)?', 1) as query
  from p),
m as (
  select *, '.' || host || ' ' || path || query as c,
         case when ('.' || host) like '%.example.com' and path like '/de/%' then 'example.com/de/'
              when ('.' || host) like '%.example.net' and path like '/en/%' then 'example.net/en/'
              when ('.' || host) like '%.org' and path like '/fr/%' then 'org/fr/'
              when ('.' || host) like '%.net' and path like '/%' then 'net/' end as rule
  from h)
select page_id, host, path, rule,
       case when rule in ('net/', 'example.com/de/') then 'block'
            when rule is not null then 'allow'
            when c like '%.ads.%' or c like '%/login%' or c like '%/cart/%' or c like '%/download/%.exe'
              or c like '%?%sessionid=%' then 'block'
            else 'allow' end as verdict
from m
"""

SQL["op4_quote_threads"] = r"""
with recursive m as (
  select row_number() over () as id, conv_id, turn, role, string_split(coalesce(text, ''), chr(10)) as ls from conversations),
l as (select id, conv_id, turn, unnest(ls) as line, generate_subscripts(ls, 1) as i from m),
k as (select *, regexp_extract(line, '^[ \t>]*>') as mark from l),
b as (select *, length(regexp_replace(mark, '[ \t]', '', 'g')) as level, substr(line, length(mark) + 1) as body from k),
r as (
  select *, case when trim(regexp_replace(body, '[\x20\x09-\x0D]+', ' ', 'g')) = '' then -1 else level end as run,
         lead(level) over (partition by id order by i) as next_level
  from b),
g as (select *, i - row_number() over (partition by id, run order by i) as island from r),
p as (
  select conv_id, turn, run as level,
         md5(lower(trim(regexp_replace(string_agg(body, ' ' order by i), '[\x20\x09-\x0D]+', ' ', 'g')))) as hash
  from g where run >= 0 and conv_id is not null and turn is not null group by id, conv_id, turn, run, island),
d as (select distinct * from p),
q as (
  select a.conv_id, a.turn, a.level, a.hash, max(o.turn) as found
  from d a left join d o on o.conv_id = a.conv_id and o.hash = a.hash and o.level = 0 and o.turn < a.turn
  where a.level > 0 group by all),
n as (
  select conv_id, turn, count(*) as n_quotes, count(found) as n_linked,
         arg_min(found, level * 1000000000 - found) filter (found is not null) as answered
  from q group by all),
t as (
  select conv_id, turn, lag(turn) over (partition by conv_id order by turn) as prior
  from (select distinct conv_id, turn from m where conv_id is not null and turn is not null)),
a as (
  select t.conv_id, t.turn, coalesce(answered, prior) as reply_to, coalesce(n_quotes, 0) as n_quotes, coalesce(n_linked, 0) as n_linked
  from t left join n using (conv_id, turn)),
x as (
  select conv_id, turn, 0 as depth, turn as thread from a where reply_to is null
  union all
  select a.conv_id, a.turn, x.depth + 1, x.thread from a join x on a.conv_id = x.conv_id and a.reply_to = x.turn),
c as (
  select id, regexp_replace(coalesce(string_agg(body, chr(10) order by i), ''), '^[\s]+|[\s]+$', '', 'g') as clean_text
  from r where level = 0 and not (regexp_matches(body, '^[ \t]*On .* wrote:[ \t\r]*$') and coalesce(next_level > 0, false))
  group by id)
select m.conv_id, m.turn, m.role, a.reply_to, coalesce(x.depth, 0)::bigint as depth, coalesce(x.thread, m.turn) as thread,
       coalesce(a.n_quotes, 0)::bigint as n_quotes, coalesce(a.n_linked, 0)::bigint as n_linked, coalesce(c.clean_text, '') as clean_text
from m left join a using (conv_id, turn) left join x using (conv_id, turn) left join c using (id)
"""

SQL["op12_importance_resampling"] = r"""
with x as (select unnest(range(256)) as i),
crc as (
  select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from x),
w as (
  select 'd' as kind, row_number() over () as id, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents
  union all
  select 'b', row_number() over (), null, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
f as (select kind, id, unnest(ws) as word from w),
v as (
  select word, hex(encode(word)) as h, (select t from crc) as t from (select distinct word from f)),
u as (
  select word, xor(list_reduce([4294967295] || list_transform(range(1, len(h) // 2 + 1), lambda k: ('0x' || substr(h, 2 * k - 1, 2))::bigint),
                  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
  from v),
g as (select f.kind, f.id, u.bucket from f join u using (word)),
k as (
  select bucket, count(*) filter (kind = 'd') as s, count(*) filter (kind = 'b') as t,
         sum(count(*) filter (kind = 'd')) over () as s_all, sum(count(*) filter (kind = 'b')) over () as t_all
  from g group by bucket),
e as (
  select bucket, floor(1000 * ln((t + 1.0::double) * (s_all + 10000)::double / ((s + 1.0::double) * (t_all + 10000)::double)))::bigint as gain from k),
m as (select id, count(*) as n, floor(sum(gain)::double / count(*))::bigint as weight from g join e using (bucket) where kind = 'd' group by id),
q as (
  select w.doc_id, coalesce(m.n, 0)::bigint as n_features, coalesce(m.weight, 0)::bigint as weight,
         ('0x' || substr(sha256('2024:' || coalesce(cast(w.doc_id as varchar), '')), 1, 8))::bigint as h
  from w left join m using (id) where w.kind = 'd'),
r as (select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint as score from q),
o as (
  select *, row_number() over (order by score desc, doc_id nulls last) as nth, (10 * count(*) over ()) // 100 as draws
  from r where n_features >= 20)
select r.doc_id, r.n_features, r.weight, r.score, case when o.nth <= o.draws then o.nth end::bigint as rank
from r left join o on o.doc_id = r.doc_id
"""

SQL["op13_filter_audit"] = r"""
with t as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
d as (
  select doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
         100 * (len(text) - len(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * len(text),
         regexp_matches(text, '[#$%&*|]'),
         exists (select 1 from t o where o.text = t.text and o.doc_id < t.doc_id)] as fails,
         exists (select 1 from labels l where l.doc_id = t.doc_id and l.quality = 1) as good,
         exists (select 1 from labels l where l.doc_id = t.doc_id and l.toxic = 1) as toxic
  from t),
c as (select part, fails, good, toxic, count(*) as n from d group by all),
f as (select unnest(range(1, 6)) as i),
o as (
  select [a.i, b.i, c.i, d.i, e.i] as p
  from f a, f b, f c, f d, f e
  where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
x as (
  select c.*, p, step, fails[p[step]] as now,
         coalesce(len(list_filter(p[1:step - 1], lambda k: fails[k])), 0) > 0 as before,
         len(list_filter(fails, lambda b: b)) = 1 and fails[p[step]] as only_now, p[step] as own
  from c, o, (select unnest(range(1, 6)) as step)),
s as (
  select part, p, step, own, sum(n) filter (not now and not before) as kept, sum(n) filter (now and not before) as removed,
         sum(n) filter (now and before) as redundant, sum(n) filter (only_now) as unique_fails,
         sum(n) filter (now and not before and good) as good_lost, sum(n) filter (now and not before and toxic) as toxic_lost
  from x group by part, p, step, own),
y as (select part, own, sum(removed) as shapley from s group by part, own)
select part, list_reduce(list_transform(p, lambda k: substr('ABCDE', k, 1)), lambda a, b: a || b) as filter_order, step::int as step,
       coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant,
       coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost,
       coalesce(toxic_lost, 0)::bigint as toxic_lost, coalesce(shapley, 0)::bigint as shapley
from s join y using (part, own)
"""
