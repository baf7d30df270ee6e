"""The ten operators over their whole tables, with production parameters, and DuckDB SQL for those that it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontam, lines, mixing, quality, quotient, revisits, sharding, simhash, suffixes, toolcalls
from .common import table


def op1_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op2_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(table(spark, sf_dir, "documents"))


def op4_tool_call_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toolcalls.chats(*toolcalls.turns_as_calls(table(spark, sf_dir, "conversations")), toolcalls.REPLY)


def op5_byte_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op6_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.resolve(revisits.crawls(table(spark, sf_dir, "pages")))


def op7_quotient_filter_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotient.copies(table(spark, sf_dir, "documents"))


def op8_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_line_alignment_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.without_repeated_lines(table(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeats(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_simhash_vptree, op2_bm25_decontamination, op3_source_mixing, op4_tool_call_chats, op5_byte_sharding, op6_revisit_resolution, op7_quotient_filter_dedup, op8_quality_discriminant, op9_line_alignment_dedup, op10_suffix_array_dedup)}

ORACLES = {
    "op3_source_mixing": f"""
with d as (
  select doc_id, coalesce(min(source), '') as source,
         max(case when coalesce(strlen(text), 0) = 0 then 0 else 2 * strlen(text) - strlen(replace(text, ' ', '')) - strlen(replace(text, chr(10), '')) + 1 end)::bigint as n_tokens
  from documents where doc_id is not null group by doc_id),
h as (select *, ('0x' || substr(md5('42|' || doc_id), 1, 15))::bigint as h from d),
p as (select *, (coalesce(sum(n_tokens) over (partition by source order by h, doc_id rows between unbounded preceding and 1 preceding), 0))::bigint as start_token from h),
t as (select source, sum(n_tokens)::bigint as t, floor(sqrt(sum(n_tokens)::double) * {mixing.UNIT}.0)::bigint as w, greatest(1, (sum(n_tokens)::bigint - 1) // {mixing.BLOCK_TOKENS} + 1) as blocks from d group by source),
c as (select *, coalesce(sum(w) over (order by source rows between unbounded preceding and 1 preceding), 0)::hugeint as below, greatest(1, sum(w) over ())::hugeint as total from t),
r as (select source, w, blocks, total, (below * 4294967296 // total)::bigint as low, ((below + w) * 4294967296 // total)::bigint as high from c),
k as (select coalesce(min(blocks * total // w), 0)::bigint as k from r where w > 0),
s as (select unnest(range(1, k + 1)) as slot from k),
u as (select slot, source, row_number() over (partition by source order by slot) - 1 as block from s join r on (slot * {mixing.GOLDEN}) % 4294967296 >= low and (slot * {mixing.GOLDEN}) % 4294967296 < high),
n as (select r.source, w, blocks, count(slot) as used from r left join u on r.source = u.source group by all),
l as (select source, w, used, unnest(range(used, blocks)) as block from n),
v as (select source, k + row_number() over (order by case when w > 0 then (2 * (block - used) + 1)::double / w end nulls last, source, block) as slot, block from l, k),
a as (select source, slot, block from u union all select source, slot, block from v),
q as (select p.*, unnest(range(least(start_token // {mixing.BLOCK_TOKENS}, blocks - 1), least(greatest(start_token + n_tokens - 1, start_token) // {mixing.BLOCK_TOKENS}, blocks - 1) + 1)) as block from p join t using (source))
select q.doc_id, q.source, a.slot::bigint as slot, q.block::bigint as block, greatest(start_token, q.block * {mixing.BLOCK_TOKENS}) - start_token as from_token,
  least(start_token + n_tokens, (q.block + 1) * {mixing.BLOCK_TOKENS}) - greatest(start_token, q.block * {mixing.BLOCK_TOKENS}) as n_tokens, greatest(start_token, q.block * {mixing.BLOCK_TOKENS}) as start_token
from q join a on q.source = a.source and q.block = a.block""",
    "op4_tool_call_chats": """
with t as (select conv_id, turn, role, text, max(case when role = 'user' then turn end) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) as last from conversations),
r as (select conv_id, last, list(text order by turn) as said from t where role = 'assistant' group by all),
c as (select u.conv_id, u.turn, coalesce(len(r.said), 0) > 0 as linked, coalesce(length(u.text), 0) > 0 as valid,
        '{"arguments":{"text":' || to_json(u.text)::varchar || ',"turn":' || u.turn || '},"id":"call_' || u.conv_id || '_' || u.turn || '","name":"reply","results":' || coalesce(to_json(r.said)::varchar, '[]') || ',"valid":' || (coalesce(length(u.text), 0) > 0) || '}' as line
      from t u left join r on u.conv_id = r.conv_id and u.turn = r.last where u.role = 'user'),
g as (select conv_id, count(*) as n_calls, count(*) filter (linked) as n_linked, count(*) filter (not valid) as n_invalid, string_agg(line, ',' order by turn) as lines from c group by 1),
x as (select conv_id, list(text order by turn) as context from t where role not in ('user', 'assistant') group by 1),
o as (select conv_id, said as orphans from r where last is null),
v as (select distinct conv_id from t)
select v.conv_id, coalesce(n_calls, 0)::bigint as n_calls, coalesce(n_linked, 0)::bigint as n_linked, coalesce(n_calls - n_linked, 0)::bigint as n_unanswered, coalesce(len(orphans), 0)::bigint as n_orphans,
  coalesce(n_invalid, 0)::bigint as n_invalid, 0::bigint as n_cyclic,
  '{"calls":[' || coalesce(lines, '') || '],"context":' || coalesce(to_json(context)::varchar, '[]') || ',"conv_id":' || v.conv_id || ',"orphans":' || coalesce(to_json(orphans)::varchar, '[]') || '}' as json
from v left join g using (conv_id) left join x using (conv_id) left join o using (conv_id)""",
    "op5_byte_sharding": f"""
with b as (select doc_id, coalesce(strlen(text), 0)::bigint as n_bytes from documents),
p as (select *, coalesce(sum(n_bytes) over (order by doc_id nulls first, n_bytes rows between unbounded preceding and 1 preceding), 0)::bigint as byte_start, sum(n_bytes) over ()::bigint as total from b)
select doc_id, n_bytes, byte_start, least(byte_start * greatest(1, ceil(total / {sharding.TARGET_BYTES}.0)::bigint) // greatest(total, 1), greatest(1, ceil(total / {sharding.TARGET_BYTES}.0)::bigint) - 1)::bigint as shard from p""",
    "op6_revisit_resolution": f"""
with a as (select page_id, url, html, regexp_replace(trim(url), '#.*$', '') as bare from pages),
b as (select *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '{revisits.SCHEME}([^/?]*)', 2)), case when lower(bare) like 'https:%' then ':443$' else ':80$' end, ''), '^www[.]', '') as host, regexp_replace(bare, '{revisits.SCHEME}[^/?]*', '') as rest from a),
c as (select *, regexp_replace(regexp_replace(regexp_extract(rest, '^[^?]*', 0), '/index[.]html?$', ''), '/+$', '') as path,
        array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '[?](.*)$', 1), '&'), lambda p: p <> '' and not regexp_matches(p, '{revisits.TRACKING}'))), '&') as query from b),
d as (select page_id, url, html, md5(html) as tag, host || path || case when coalesce(query, '') <> '' then '?' || query else '' end as canonical_url from c),
l as (select canonical_url, max(page_id) as refers_to from d group by 1),
j as (select d.page_id as record_id, d.url, d.canonical_url, l.refers_to, f.html as payload, f.tag, d.tag = f.tag as ok from d join l using (canonical_url) join d f on f.page_id = l.refers_to)
select record_id, url, canonical_url, case when ok then 'resolved' else 'validator_mismatch' end as status, refers_to,
  case when ok then '{{"content-length":"' || strlen(payload) || '","content-type":"text/html","date":"' || (record_id + {revisits.SECOND_CRAWL}) || '","etag":"\\"' || tag || '\\""}}' end as headers,
  case when ok then payload end as payload from j""",
    "op7_quotient_filter_dedup": """
select doc_id, min(doc_id) over w as first_doc_id, count(*) over w as n_copies from documents where text is not null
window w as (partition by text) qualify count(*) over w > 1""",
}
