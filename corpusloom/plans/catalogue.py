"""Registered queries over whole tables, with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quality as Q
from ..functions import text as T
from ..operators import chunks, dedup, records, scale, sft

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WORD = r"\pL\pN_"
STRIP = r"^\s+|\s+$"
SQL_LINES = "string_split({t}, chr(10))"
SQL_SENTENCES = "list_filter(list_transform(regexp_extract_all(text, '[^。！？.!?;；]*[。！？.!?;；]|[^。！？.!?;；]+'), lambda x: regexp_replace(x, '^\\s+', '')), lambda x: trim(x) <> '')"
SQL_PAGE = "coalesce(array_to_string(list_filter(list_transform(string_split(regexp_replace(regexp_replace({t}, '<[^>]+>', '', 'g'), 'https?://\\S+', '', 'g'), chr(10)), lambda x: regexp_replace(regexp_replace(x, '[ \\t]+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')), lambda x: x <> ''), chr(10)), '')"
SQL_MAIL = SQL_PAGE.replace("'https?://\\S+', '', 'g')", "'https?://\\S+', '', 'g'), '[\\pL\\pN_.+-]+@[\\pL\\pN_-]+\\.[\\pL\\pN_.-]+', '', 'g')").replace("string_split(regexp_replace(", "string_split(regexp_replace(regexp_replace(")
SQL_KEY = "md5(lower(regexp_replace(text, '\\s+', '', 'g')))"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, table: str, sql: str | None = None):
    """Registers a function of one table."""

    def add(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            scale.small_batches(spark)
            return f(scale.spread(read(spark, sf_dir, table)))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return f

    return add


def scalar(name: str, cleaner: T.Cleaner, sql: str | None, table: str = "documents", key: str = "doc_id", column: str = "text") -> None:
    query(name, table, f"select {key}, {sql} as clean from {table}" if sql else None)(lambda df: df.select(key, cleaner(F.col(column)).alias("clean")))


def lines_sql(test: str) -> str:
    return f"coalesce(array_to_string(list_filter(string_split(text, chr(10)), lambda x: {test}), chr(10)), '')"


scalar("strip_tags", T.strip_tags, "regexp_replace(html, '<[^>]+>', '', 'g')", "pages", "page_id", "html")
scalar("strip_urls", T.strip_urls, r"regexp_replace(url, 'https?://\S+', '', 'g')", "pages", "page_id", "url")
scalar("strip_emails", T.strip_emails, rf"regexp_replace(text, '[{WORD}.\-]+@[{WORD}.\-]+\.[{WORD}]+', '', 'g')")
scalar("one_space", T.one_space(), r"regexp_replace(text, '[^\S\n]+', ' ', 'g')")
scalar("keep_known_chars", T.keep_known_chars, r"regexp_replace(text, '[^\x20-\x7E\x{4E00}-\x{9FFF}\x{3000}-\x{303F}\x{FF00}-\x{FFEF}\n\r\t]', '', 'g')")
scalar("keep_line_chars", T.keep_line_chars, r"regexp_replace(text, '[^\x20-\x7E\x{4E00}-\x{9FA5}\x{3000}-\x{303F}\x{FF00}-\x{FFEF}]', '', 'g')")
scalar("squeeze_spaces", T.squeeze_spaces, rf"regexp_replace(regexp_replace(regexp_replace(text, '[^\S\n]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '{STRIP}', '', 'g')")
scalar("drop_blank_lines", T.drop_blank_lines, lines_sql(r"regexp_replace(x, '^\s+|\s+$', '', 'g') <> ''"))
scalar("drop_short_lines", T.drop_short_lines(20), lines_sql(r"length(regexp_replace(x, '^\s+|\s+$', '', 'g')) >= 20"))
scalar("drop_page_numbers", T.drop_page_numbers, lines_sql(r"not regexp_matches(x, '^\s*第\s*\d+\s*页\s*$|^\s*\d+\s*/\s*\d+\s*$|^\s*-?\s*\d+\s*-?\s*$|^\s*Page\s*\d+\s*$')"))
scalar("drop_notices", T.drop_notices(), lines_sql(r"not regexp_matches(x, '(?i)Copyright\s+|All rights reserved|版权所有')"))
scalar("fix_mojibake", T.fix_mojibake, "replace(replace(replace(replace(text, '锟斤拷', ''), '烫烫烫', ''), '屯屯屯', ''), chr(65533), '')")
scalar("strip_images", T.strip_images, r"regexp_replace(text, '!\[.*?\]\(.*?\)', '', 'g')")
scalar("strip_links", T.strip_links(), r"regexp_replace(text, '\[([^\]]+)\]\([^\)]+\)', '\1', 'g')")
scalar("strip_code_blocks", T.strip_code_blocks, r"regexp_replace(text, '```[\s\S]*?```', '', 'g')")
scalar("drop_comments", T.drop_comments("python"), r"""regexp_replace(regexp_replace(regexp_replace(text, '(?m)#.*$', '', 'g'), '\"\"\"[\s\S]*?\"\"\"', '', 'g'), '''''''[\s\S]*?''''''', '', 'g')""")
scalar("drop_imports", T.drop_imports("python"), r"regexp_replace(regexp_replace(text, '(?m)^import .+$', '', 'g'), '(?m)^from .+ import .+$', '', 'g')")
scalar("clean_page", T.clean_page, SQL_PAGE.format(t="html"), "pages", "page_id", "html")
scalar("clean_page_and_mail", T.clean_page_and_mail, SQL_MAIL.format(t="text"))
scalar("strip_tail_page", T.strip_tail_page, r"regexp_replace(regexp_replace(text, '[/\s]*\(\s*\d{1,4}\s*\)\s*$', '', 'g'), '[/\s]+\d{1,4}\s*$', '', 'g')")


@query(
    "cleaning_stats", "documents",
    f"""with c as (select text, regexp_replace(regexp_replace(regexp_replace(text, '[^\\S\\n]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '{STRIP}', '', 'g') as clean from documents)
select sum(length(text))::bigint as original_chars, sum(length(clean))::bigint as cleaned_chars, sum(len(string_split(text, chr(10))))::bigint as original_lines, sum(len(string_split(clean, chr(10))))::bigint as cleaned_lines from c""",
)
def cleaning_stats(df: DataFrame) -> DataFrame:
    df = df.select("text", T.squeeze_spaces(F.col("text")).alias("clean"))
    total = lambda c: F.sum(c).cast("long")
    return df.agg(total(F.length("text")).alias("original_chars"), total(F.length("clean")).alias("cleaned_chars"), total(F.size(T.lines(F.col("text")))).alias("original_lines"), total(F.size(T.lines(F.col("clean")))).alias("cleaned_lines"))


@query(
    "clean_dedup_by_source", "documents",
    f"""with c as (select doc_id, source, {SQL_PAGE.format(t="text")} as text from documents where length(regexp_replace(text, '{STRIP}', '', 'g')) >= 50),
d as (select * from c where length(text) >= 50 qualify row_number() over (partition by {SQL_KEY} order by doc_id) = 1)
select source, count(*) as n, sum(length(text))::bigint as chars, round(sum(length(text)) / 1048576, 1) as mb from d group by source""",
)
def clean_dedup_by_source(df: DataFrame) -> DataFrame:
    df = df.where(F.length(T.strip(F.col("text"))) >= 50)
    # generated, so that the cleaner isn't evaluated again for the filter and for each use of its result
    df = df.select("doc_id", "source", F.explode(F.array(T.clean_page(F.col("text")))).alias("text")).where(F.length("text") >= 50)
    # the digest, not the text, goes through the exchange that finds first rows; lengths are all that the report needs
    df = df.select("doc_id", "source", T.normal_key(F.col("text")).alias("k"), F.length("text").alias("n"))
    first = df.groupBy("k").agg(F.min(F.struct("doc_id", "source", "n")).alias("f")).select("f.*")
    return first.groupBy("source").agg(F.count("*").alias("n"), F.sum("n").cast("long").alias("chars"), F.round(F.sum("n") / 1048576, 1).alias("mb"))


query("dedup_exact", "documents", "select doc_id from documents qualify row_number() over (partition by md5(coalesce(text, '')) order by doc_id) = 1")(lambda df: dedup.exact(df).select("doc_id"))
query("dedup_normalised", "documents", f"select doc_id from documents qualify row_number() over (partition by {SQL_KEY} order by doc_id) = 1")(lambda df: dedup.normalised(df).select("doc_id"))
query("dedup_rule", "documents", rf"with d as (select doc_id, regexp_replace(text, '{STRIP}', '', 'g') as text from documents) select doc_id, text from d where text <> '' qualify row_number() over (partition by {SQL_KEY} order by doc_id) = 1")(lambda df: dedup.rule(df).select("doc_id", "text"))
query(
    "distinct_lines", "documents",
    rf"""with l as (select doc_id, unnest({SQL_LINES.format(t="text")}) as line, generate_subscripts({SQL_LINES.format(t="text")}, 1) - 1 as line_no from documents)
select doc_id, line_no, line from l where regexp_replace(line, '{STRIP}', '', 'g') <> '' qualify row_number() over (partition by doc_id, lower(line) order by line_no) = 1""",
)(lambda df: dedup.distinct_lines(df))
query(
    "dedup_rates", "documents",
    f"with u as (select count(*) as n, count(distinct {SQL_KEY}) as u from documents) select n as total, u as \"unique\", n - u as duplicates, (n - u) / greatest(n, 1) as rate from u",
)(lambda df: dedup.rates(df, dedup.normalised(df)))
query("longest_name", "pages", "select page_id from (select page_id, sha256(html) as h, url from pages) qualify row_number() over (partition by h order by length(regexp_extract(url, '[^/]*$')) desc, url) = 1")(
    lambda df: dedup.longest_name(df.select("page_id", F.sha2("html", 256).alias("sha256"), F.col("url").alias("path"))).select("page_id")
)
#: Classes of equal shingle sets, and the pairs of them.
SQL_MINHASH = """g as (select doc_id, list_sort(list_distinct(list_transform(range(1, length(text) - 1), lambda i: substr(text, i, 3)))) as g from documents where length(text) >= 3),
m as (select doc_id as id, min(doc_id) over (partition by g) as first, g from g),
k as (select id as doc_id, g from m where id = first),
p as (select a.doc_id as a, b.doc_id as b, len(list_intersect(a.g, b.g)) as n, len(a.g) as x, len(b.g) as y from k a join k b on a.doc_id < b.doc_id and least(len(a.g), len(b.g)) >= 0.9 * greatest(len(a.g), len(b.g))),
e as (select a, b, n / (x + y - n) as jaccard from p where n / (x + y - n) >= 0.9)"""


def sql_greedy(edges: str) -> str:
    """Of the nodes of e (a, b), in the order of ids, those that no earlier one of them is next to: k (step, kept)."""
    return f"""with recursive {edges},
v as (select id, row_number() over (order by id) as step from (select a as id from e union select b from e)),
b as (select v.step, v.id, coalesce(list(e.a) filter (e.a is not null), []) as near from v left join e on e.b = v.id group by all),
choice as (select 0::bigint as step, []::bigint[] as kept union all select b.step, case when list_has_any(choice.kept, b.near) then choice.kept else list_append(choice.kept, b.id) end from choice join b on b.step = choice.step + 1),
stay as (select unnest(kept) as id from choice where step = (select max(step) from choice))"""


query("minhash_pairs", "documents", f"with {SQL_MINHASH} select a, b, jaccard from e")(lambda df: dedup.minhash_pairs(df, 0.9)[0])
query("minhash_classes", "documents", f"with {SQL_MINHASH} select id, first from m")(lambda df: dedup.minhash_pairs(df, 0.9)[1])
query("dedup_minhash", "documents", sql_greedy(SQL_MINHASH) + " select doc_id from documents where doc_id not in (select id from m where id <> first) and (doc_id not in (select id from v) or doc_id in (select id from stay))")(lambda df: dedup.minhash(df, 0.9).select("doc_id"))
SQL_COSINE = "u as (select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings), e as (select a.vec_id as a, b.vec_id as b, list_cosine_similarity(a.v, b.v) as c from u a join u b on a.vec_id < b.vec_id where list_cosine_similarity(a.v, b.v) > 0.3)"
query("cosine_pairs", "embeddings", f"with {SQL_COSINE} select a, b from e")(lambda df: dedup.cosine_pairs(df, 0.3).select("a", "b"))
query("dedup_semantic", "embeddings", sql_greedy(SQL_COSINE) + " select vec_id from embeddings where vec_id not in (select id from v) or vec_id in (select id from stay)")(lambda df: dedup.semantic(df, 0.3).select("vec_id"))
query("semantic_reasons", "embeddings", sql_greedy(SQL_COSINE) + " select vec_id, coalesce(vec_id in (select id from stay) or vec_id not in (select id from v), true) as kept, case when vec_id in (select id from v) and vec_id not in (select id from stay) then 'semantic_duplicate' end as reason from embeddings")(
    lambda df: dedup.semantic_reasons(df, 0.3).select("vec_id", "kept", "reason")
)
query("hybrid_dedup", "embeddings", sql_greedy(SQL_COSINE) + " select vec_id from embeddings where vec_id not in (select id from v) or vec_id in (select id from stay)")(
    lambda df: dedup.hybrid(df.withColumn("text", F.col("vec_id").cast("string")), 0.3, order="vec_id").select("vec_id")
)
query("quick_hashes", "pages", "with h as (select page_id, hex(encode(html)) as h from pages) select page_id, sha256(unhex(case when length(h) > 4000 then left(h, 2000) || right(h, 2000) else left(h, 2000) end)) || '_' || length(h) // 2 as h from h")(
    lambda df: df.select("page_id", dedup.quick_hash(F.col("html").cast("binary"), F.octet_length("html"), 1000).alias("h"))
)

query("split_lines", "documents", rf"with l as (select doc_id, unnest({SQL_LINES.format(t='text')}) as x, generate_subscripts({SQL_LINES.format(t='text')}, 1) - 1 as pos from documents) select doc_id, pos, regexp_replace(x, '{STRIP}', '', 'g') as text from l where length(regexp_replace(x, '{STRIP}', '', 'g')) between 40 and 400")(
    lambda df: chunks.split_by(df, "line", 40, 400)
)
query("split_paragraphs", "documents", rf"with l as (select doc_id, unnest(string_split(text, chr(10) || chr(10))) as x, generate_subscripts(string_split(text, chr(10) || chr(10)), 1) - 1 as pos from documents) select doc_id, pos, regexp_replace(x, '{STRIP}', '', 'g') as text from l where length(regexp_replace(x, '{STRIP}', '', 'g')) >= 1")(
    lambda df: chunks.split_by(df, "paragraph")
)
query("sentences", "documents", f"select doc_id, unnest({SQL_SENTENCES}) as sentence from documents")(lambda df: df.select("doc_id", F.explode(T.sentences(F.col("text"), " \t\n\f\r")).alias("sentence")))
SQL_STOP = "[" + ", ".join(f"'{w}'" for w in Q.STOP_EN + Q.STOP_ZH) + "]"
SQL_WORDS = rf"list_filter(list_distinct(list_concat(list_filter(regexp_extract_all(lower(text), '[a-zA-Z]+'), lambda w: length(w) > 1), regexp_extract_all(text, '[\x{{4e00}}-\x{{9fff}}]'))), lambda w: not list_contains({SQL_STOP}, w))"
query(
    "info_density", "documents",
    rf"""with d as (select doc_id, coalesce(list_sum(list_transform({SQL_WORDS}, lambda w: length(w))), 0) / length(text) as d from documents)
select doc_id, round(case when d >= 0.8 then 1.0 when d <= 0.3 then 0.2 else 0.2 + 0.8 * (d - 0.3) / 0.5 end, 4)::double as info_density from d""",
)(lambda df: df.select("doc_id", (F.round(Q.density(F.col("text")) * 10000) / 10000).alias("info_density")))


def _sql_quality() -> str:
    """The four parts and the overall score of documents."""
    words = "list_filter(list_distinct(list_concat(list_filter(regexp_extract_all(lower(s), '[a-zA-Z]+'), lambda w: length(w) > 1), regexp_extract_all(s, '[\\x{4e00}-\\x{9fff}]'))), lambda w: not list_contains(stop, w))"
    runs = "|".join((f"\\x{{{ord(c):x}}}" + "{5,}") for c in map(chr, [*range(33, 127), *range(0xA1, 0x180), 32, 9, 0x2019, 0x201C, 0x201D, 0x2013, 0x2014, 0x2026]))
    odd = r"[^\pL\pN\pM_\s\x{4e00}-\x{9fff}\x{3000}-\x{303f}\x{ff00}-\x{ffef}\"\[\]{}()\-+*/=<>]"
    gone = lambda p: f"(length(text) - length(regexp_replace(text, '{p}', '', 'g')))"
    marks = " + ".join(f"(text like '%{m}%')::int" for m in Q.MARKS)
    return f"""with s as (select doc_id, text, {SQL_STOP} as stop, list_transform({SQL_SENTENCES}, lambda x: regexp_replace(x, '{STRIP}', '', 'g')) as ss from documents),
b as (select *, list_sum(list_transform(ss, lambda s: length(s))) / len(ss) as a, list_transform(ss, lambda s: {words}) as bags, coalesce(list_sum(list_transform({SQL_WORDS}, lambda w: length(w))), 0) / length(text) as d from s),
c as (select *, list_filter(list_transform(range(1, len(bags)), lambda i: case when len(bags[i]) > 0 and len(bags[i + 1]) > 0 then len(list_intersect(bags[i], bags[i + 1])) >= 2 end), lambda p: p is not null) as p from b),
q as (select doc_id, 0.6e0 * case when a < 10 then 0.2e0 when a < 30 then 0.2e0 + 0.8e0 * (a - 10) / 20 when a <= 80 then 1.0e0 when a <= 200 then 1 - 0.7e0 * least((a - 80) / 120, 1.0e0) else 0.3e0 end + 0.4e0 * least(({marks}) / 5, 1.0e0) as r,
  case when len(ss) < 2 then 0.7e0 when len(p) = 0 then 0.5e0 else len(list_filter(p, lambda x: x)) / len(p) end as c,
  case when d >= 0.8e0 then 1.0e0 when d <= 0.3e0 then 0.2e0 else 0.2e0 + 0.8e0 * (d - 0.3e0) / 0.5e0 end as d,
  least(({gone('https?://[^ ]+')} + {gone(r'[^ ]+@[^ ]+[.][^ ]+').replace('[^ ]', chr(92) + 'S')} + {gone(odd)} + {gone(runs)}) / length(text), 1.0e0) as n from c),
f as (select doc_id, printf('%.4f', r)::double as readability, printf('%.4f', c)::double as coherence, printf('%.4f', d)::double as info_density, printf('%.4f', n)::double as noise_ratio, printf('%.4f', (0.3e0 * r + 0.25e0 * c + 0.25e0 * d + 0.2e0 * (1 - n)))::double as quality_score from q)"""


query("quality_scores", "documents", _sql_quality() + " select * from f")(lambda df: df.select("doc_id", Q.scores(F.col("text")).alias("q")).select("doc_id", "q.*"))
query("quality_filter", "documents", _sql_quality() + " select * from f where quality_score >= 0.3 and noise_ratio <= 0.1")(lambda df: df.select("doc_id", Q.scores(F.col("text")).alias("q")).select("doc_id", "q.*").where("quality_score >= 0.3 and noise_ratio <= 0.1"))
query("length_gate", "documents", rf"select doc_id from documents where length(regexp_replace(text, '{STRIP}', '', 'g')) between 100 and 1000000")(lambda df: records.length_gate(df).select("doc_id"))

query("source_stats", "documents", "select source, count(*) as n, sum(length(text))::bigint as chars, round(sum(length(text)) / 1048576, 1) as mb from documents group by 1")(records.by_group)
query(
    "corpus_metadata", "documents",
    "select (select count(distinct source) from documents) as n_sources, sum(length(text))::bigint as total_chars, count(*) as total_records, array_to_string(list_sort(list(distinct source)), ',') as sources from documents",
)(lambda df: df.agg(F.count_distinct("source").alias("n_sources"), F.sum(F.length("text")).cast("long").alias("total_chars"), F.count("*").alias("total_records"), F.array_join(F.sort_array(F.collect_set("source")), ",").alias("sources")))
query("duplicate_index", "documents", "select sha256(text) as sha256, count(*) as n, array_to_string(list_sort(list(doc_id)), ',') as ids from documents group by 1 having count(*) > 1")(
    lambda df: df.groupBy(F.sha2("text", 256).alias("sha256")).agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("doc_id")), ",").alias("ids")).where("n > 1")
)
STATES = ["click", "view", "purchase"]
query("status_pivot", "events", "select user_id % 10 as category, count(*) as total, " + ", ".join(f"count(*) filter (event_type = '{v}') as {v}" for v in STATES) + " from events group by 1")(lambda df: records.pivot_by_status(df, F.col("user_id") % 10, "event_type", STATES))
query("human_size", "documents", "with d as (select doc_id, n_chars::hugeint * (1024::hugeint ** (doc_id % 5))::hugeint as n from documents), u as (select doc_id, n, case when n < 1024 then 0 when n < 1048576 then 1 when n < 1073741824 then 2 when n < 1099511627776 then 3 else 4 end as k from d) select doc_id, printf('%.1f', floor(n / (1024.0 ** k) * 10 + 0.5) / 10) || ['  B', ' KB', ' MB', ' GB', ' TB'][k + 1].replace('  ', ' ') as size from u")(
    lambda df: df.select("doc_id", records.human_size(F.col("n_chars") * F.pow(F.lit(1024.0), F.col("doc_id") % 5).cast("long")).alias("size"))
)
query("analyse_dataset", "documents", "select count(*) as samples, sum(length(text))::bigint as chars, sum(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')))::bigint as words, min(length(text)) as min_length, max(length(text)) as max_length, avg(length(text)) as avg_length, list_sort(list(length(text)))[count(*) // 2 + 1] as median_length from documents")(
    records.analyse
)
SQL_ORDER = "row_number() over (order by md5(doc_id::varchar || '42'), doc_id)"
query("split_dataset", "documents", f"with d as (select doc_id, {SQL_ORDER} as k, count(*) over () as n from documents) select doc_id, case when k <= floor(n * 0.1) then 'test' when k <= floor(n * 0.1) + floor(n * 0.05) then 'val' else 'train' end as split from d")(
    lambda df: records.split(df.select("doc_id"), 0.1, 0.05)
)
query("sample_rows", "documents", f"select doc_id from documents qualify {SQL_ORDER} <= 100")(lambda df: records.sample(df.select("doc_id"), n=100))
query("sample_ratio", "documents", f"select doc_id from documents qualify {SQL_ORDER} <= floor(count(*) over () * 0.25)")(lambda df: records.sample(df.select("doc_id"), ratio=0.25))


def _merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {"documents": read(spark, sf_dir, "documents").select("text"), "benchmark": read(spark, sf_dir, "benchmark").select("text"), "again": read(spark, sf_dir, "documents").select("text")}
    return records.merge_stats(frames)


QUERIES["merge_datasets"] = _merge
ORACLES["merge_datasets"] = """with r as (select 1 as k, 'documents' as origin, text from documents union all select 2, 'benchmark', text from benchmark union all select 3, 'again', text from documents),
f as (select *, row_number() over (partition by text order by k) as n from r where length(text) > 0) select origin, count(*) as total, count(*) filter (n = 1) as "unique" from f group by 1"""

query("assemble_messages", "conversations", "select conv_id, string_agg(role || ':' || text, chr(10) order by turn) as chat, count(*) as n from conversations group by 1")(
    lambda df: records.assemble(df).select("conv_id", F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n").alias("chat"), F.size("messages").cast("long").alias("n"))
)
query("validate_messages", "conversations", "select conv_id, (count(*) >= 2 and arg_max(role, turn) = 'assistant') as valid from conversations group by 1")(
    lambda df: records.assemble(df).select("conv_id", (F.size(records.message_errors(F.col("messages"), strict=True)) == 0).alias("valid"))
)
query("message_errors", "conversations", "with c as (select conv_id, count(*) as n, arg_max(role, turn) as r from conversations group by 1), e as (select case when n < 2 then 'fewer than 2 messages' end as e from c union all select case when r <> 'assistant' then 'last message is not the assistant''s' end from c) select e as error, count(*) as n from e where e is not null group by 1")(
    lambda df: records.assemble(df).select(F.explode(records.message_errors(F.col("messages"), strict=True)).alias("error")).groupBy("error").agg(F.count("*").alias("n"))
)
query("role_distribution", "conversations", "select role, count(*) as n from conversations group by 1")(lambda df: df.groupBy("role").agg(F.count("*").alias("n")))
query("message_lengths", "conversations", "select conv_id, sum(length(text))::bigint as chars from conversations group by 1 having sum(length(text)) between 10 and 50000")(
    lambda df: records.assemble(df).select("conv_id", records.total_length(F.col("messages")).cast("long").alias("chars")).where("chars between 10 and 50000")
)
query("record_formats", "conversations", "select conv_id, turn, case role when 'system' then 'alpaca' when 'user' then 'messages' else 'qa' end as format from conversations")(
    lambda df: df.select("conv_id", "turn", records.record_format(F.when(F.col("role") == "user", F.lit('{"messages":null,"question":1,"answer":2}')).when(F.col("role") == "system", F.to_json(F.struct(F.col("text").alias("instruction")))).otherwise(F.to_json(F.struct(F.col("text").alias("question"), F.col("text").alias("answer"))))).alias("format"))
)


def _first(messages: Column) -> list[Column]:
    return [messages[0]["content"].alias("ask"), messages[1]["content"].alias("answer")]


def _qa(df: DataFrame) -> DataFrame:
    pairs = df.alias("q").join(df.alias("a"), (F.col("q.conv_id") == F.col("a.conv_id")) & (F.col("a.turn") == F.col("q.turn") + 1)).where("q.role = 'user' and a.role = 'assistant'")
    return pairs.select(F.col("q.conv_id").alias("conv_id"), F.col("q.turn").alias("turn"), records.qa_messages(F.col("q.text"), F.col("a.text"), F.col("q.role")).alias("m")).select("conv_id", "turn", *_first(F.col("m")))


query("qa_messages", "conversations", "select q.conv_id, q.turn, '背景信息：' || chr(10) || q.role || chr(10) || chr(10) || '问题：' || q.text as ask, a.text as answer from conversations q join conversations a on q.conv_id = a.conv_id and a.turn = q.turn + 1 where q.role = 'user' and a.role = 'assistant'")(_qa)
query("instruction_messages", "documents", "select doc_id, lang || chr(10) || chr(10) || source as ask, text as answer from documents")(
    lambda df: df.select("doc_id", records.instruction_messages(F.col("lang"), F.col("source"), F.col("text")).alias("m")).select("doc_id", *_first(F.col("m")))
)
query("sharegpt_messages", "conversations", "select conv_id, turn, case when role = 'user' then 'user' else 'assistant' end as role, text as content from conversations")(
    lambda df: df.select("conv_id", "turn", F.array(F.struct(F.when(F.col("role") == "user", "human").otherwise(F.col("role")).alias("from"), F.col("text").alias("value"))).alias("c")).select("conv_id", "turn", F.inline(records.sharegpt_messages(F.col("c"))))
)
query("summary_messages", "documents", "select doc_id, '请总结以下内容：' || chr(10) || chr(10) || text as ask, source as answer from documents")(
    lambda df: df.select("doc_id", records.summary_messages(F.col("text"), F.col("source")).alias("m")).select("doc_id", *_first(F.col("m")))
)
query("section_records", "documents", "select doc_id, '# ' || source || chr(10) || chr(10) || text as record from documents where text not like '#%' union all select doc_id, text from documents where text like '#%'")(
    lambda df: df.select("doc_id", records.section_record(F.col("source"), F.col("text")).alias("record"))
)
query("code_records", "documents", "select doc_id, '# Repository: ' || source || case doc_id % 3 when 0 then '' else ' | File: f' || doc_id end || ' | Language: ' || ['Python', 'YAML', '.h', '.CC'][doc_id % 4 + 1] || chr(10) || chr(10) || text as record from documents")(
    lambda df: df.select("doc_id", records.code_record(F.col("text"), F.col("source"), F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit("f"), "doc_id")), F.element_at(F.array(*map(F.lit, (".PY", ".yml", ".h", ".CC"))), (F.col("doc_id") % 4 + 1).cast("int"))).alias("record"))
)
query("rich_records", "documents", "select doc_id, '# ' || lang || chr(10) || chr(10) || text as text, source as category, length(text) as char_count from documents where text not like '#%' union all select doc_id, text, source, length(text) from documents where text like '#%'")(
    lambda df: df.select("doc_id", records.rich_record(F.col("lang"), F.col("text"), category=F.col("source"), char_count=F.length("text").cast("long")).alias("r")).select("doc_id", "r.text", "r.meta.category", "r.meta.char_count")
)
query("path_category", "pages", "select page_id, regexp_extract(url, '^https?://[^/]+/([^/]+)', 1) as category from pages")(
    lambda df: df.select("page_id", records.category(F.regexp_replace("url", "^https?://[^/]+", "/data"), "/data").alias("category"))
)
query("pdf_dates", "events", "select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') as iso from events")(lambda df: df.select("event_id", records.pdf_date(F.concat(F.lit("D:"), F.date_format("ts", "yyyyMMddHHmmss"), F.lit("+08'00'"))).alias("iso")))


#: Texts with all that the line cleaners look for, made of documents.
_PIECES = (
    "Contents\n1.1 Begin 3\n2.2 End 9\n\n# Contents\n1. Begin\n[2] End\n# Part ", "doc_id", "\n", "text", "\nAs Zhang (2021) and Li(2019,2020) show [12] in Figure 3.2 and table 4-1a, see fig. 7 (12)\n\n\n![x](y)\nVisit WWW.example.com\n",
    "  https://a.b/c  \nISBN CIP 1\n(Smith et al., 2024) no full stop here\njoined \u201cline\u201d \u2014 end.\n1.1 Begin ... 2.2 End 31\n## Results ##\n", "text", "\n### References\n", "text", "\n## Table of Contents\n", "text", "\n# Last\n", "text", "\ntail 1999\n",
)


def annotated(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.concat(*(F.col(p).cast("string") if p in ("doc_id", "text") else F.lit(p) for p in _PIECES)).alias("text"))


SQL_ANNOTATED = "d as (select doc_id, " + " || ".join(f"{p}::varchar" if p in ("doc_id", "text") else "'" + p.replace("\n", "' || chr(10) || '") + "'" for p in _PIECES) + " as text from documents), l as (select doc_id, unnest(string_split(text, chr(10))) as x, generate_subscripts(string_split(text, chr(10)), 1) as n from d)"


def _R(x: str, *patterns: str) -> str:
    """SQL that takes the patterns out of *x* one after the other."""
    for p in patterns:
        x = f"regexp_replace({x}, '{p}', '', 'g')"
    return x


_TAIL = (r"[/\s]*\(\s*\d{1,4}\s*\)\s*$", r"[/\s]+\d{1,4}\s*$")
_FIGURES = tuple(rf"(?i){w}\s?\d+[.\d\-]*" for w in ("表", "图", "table", "figure"))
_CROSS = (r"(?:参见|如|见)?\s*[图表]\s*\d+(?:[.\-]\d+)*[A-Za-z]?\s*(?:所[示列给])?", r"(?i)(?:as\s+shown\s+in|see)?\s*(?:fig(?:ure|\.)?|table)\s+\d+(?:[.\-]\d+)*[A-Za-z]?")
_YEAR = r"[\pL\pN_]+(?:和[\pL\pN_]+)?\s*[（(]\d{4}(?:[，,]\d{4})*[）)]"
_ETAL = r"\((?:[A-Za-z]|[一-龥])+\s+et\s+al\.,\s+\d{4}\)"
_LINE = r"[^\x20-\x7E\x{4E00}-\x{9FA5}\x{3000}-\x{303F}\x{FF00}-\x{FFEF}]"
_LINK = "not (ltrim(x) like '![%' or x like '%](%') and not regexp_matches(lower(x), 'copyright|email|www\\.|西安交通大学|xianjiaotonguniversity')"
SQL_MARKDOWN_LINES = f"""{SQL_ANNOTATED},
r as (select doc_id, n, regexp_replace(x, '\\s+$', '') as x from l),
t as (select *, coalesce(last_value(case when lower(x) like 'contents%' or x like '%目录%' then true when trim(x) = '' or x like '#%' then false end ignore nulls) over (partition by doc_id order by n), false) as toc from r),
a as (select doc_id, n, {_R('x', r'\[.*?\]', _YEAR)} as x from t where not toc and {_LINK}),
b as (select doc_id, n, x, regexp_replace(x, '{STRIP}', '', 'g') as s from a),
c as (select doc_id, n, {_R('x', *_TAIL, *_FIGURES, *_CROSS)} as x from b where not (s like '%图书在版编目%' or s like '%CIP%') and not (len(regexp_extract_all(s, '\\d+\\.\\d+(?:\\.\\d+)*')) >= 2 and regexp_matches(s, '[/\\s]\\d{{1,4}}'))
  and not regexp_matches(s, '^#?\\s*第(?:\\d+|[一二三四五六七八九十百])章.*?[/\\s]+\\d{{1,4}}\\s*$') and not regexp_matches(s, '^\\d+(?:\\.\\d+)+.*?(?:[/\\s]+\\d{{1,4}}|\\(\\d{{1,4}}\\))\\s*$') and not regexp_matches(s, '^https?://\\S+$')),
m as (select doc_id, n, regexp_replace({_R("regexp_replace(x, '" + STRIP + "', '', 'g')", _ETAL)}, '{STRIP}', '', 'g') as x from c),
k as (select doc_id, n, regexp_replace({_R('x', _LINE)}, '{STRIP}', '', 'g') as x from m),
ls as (select * from k where x <> '')"""
query("markdown_lines", "documents", f"with {SQL_MARKDOWN_LINES} select d.doc_id, coalesce(string_agg(x, chr(10) order by n), '') as clean from d left join ls using (doc_id) group by 1")(lambda df: annotated(df).select("doc_id", F.array_join(T.markdown_lines(F.col("text")), "\n").alias("clean")))
SQL_PLAIN_LINES = f"""{SQL_ANNOTATED},
r as (select doc_id, n, regexp_replace(x, '\\s+$', '') as x from l),
a as (select doc_id, n, x as raw, regexp_replace({_R('x', r'\[.*?\]', _YEAR, *_TAIL, *_FIGURES, *_CROSS, _LINE, _ETAL)}, '{STRIP}', '', 'g') as x from r where x = '' or {_LINK} and not (x like '%图书在版编目%' or x like '%CIP%') and not regexp_matches(regexp_replace(x, '{STRIP}', '', 'g'), '^https?://\\S+$')),
b as (select *, lag(x) over (partition by doc_id order by n) as before from a where raw = '' or x <> ''),
ls as (select doc_id, n, x from b where x <> '' or coalesce(before, '#') <> '')"""
query("plain_lines", "documents", f"with {SQL_PLAIN_LINES} select doc_id, string_agg(x, chr(10) order by n) as clean from ls group by 1")(lambda df: annotated(df).select("doc_id", F.array_join(T.plain_lines(F.col("text"), mend=False), "\n").alias("clean")))
query(
    "mended_lines", "documents",
    f"""with recursive {SQL_PLAIN_LINES},
g as (select doc_id, list(x order by n) as ls from ls group by 1),
w as (select doc_id, ls, 1 as i, []::varchar[] as out from g union all
  select doc_id, ls, i + case when joins then 2 else 1 end, list_append(out, case when joins then ls[i] || ' ' || ls[i + 1] else ls[i] end)
  from (select *, ls[i] <> '' and not regexp_matches(ls[i], '[。.！？；;：:—…]$') and coalesce(ls[i + 1], '') <> '' and not coalesce(ls[i + 1], '') like '#%' as joins from w where i <= len(ls)))
select doc_id, array_to_string(arg_max(out, i), chr(10)) as clean from w group by 1""",
)(lambda df: annotated(df).select("doc_id", F.array_join(T.plain_lines(F.col("text")), "\n").alias("clean")))
query(
    "drop_contents", "documents",
    f"""with {SQL_ANNOTATED},
t as (select *, regexp_matches(x, '^#\\s*(目录|Contents|Table of Contents)') as opens, regexp_matches(x, '^\\s*[\\d.\\-]+\\s+|^\\s*\\[') as entry from l),
u as (select *, last_value(case when opens then true when not entry then false end ignore nulls) over (partition by doc_id order by n) as inside from t)
select doc_id, string_agg(x, chr(10) order by n) as clean from u where not coalesce(inside, false) group by 1""",
)(lambda df: annotated(df).select("doc_id", T.drop_contents(F.col("text")).alias("clean")))
query("strip_author_year", "documents", f"with {SQL_ANNOTATED} select doc_id, {_R('text', _YEAR)} as clean from d")(lambda df: annotated(df).select("doc_id", T.strip_author_year(F.col("text")).alias("clean")))
query("strip_figures_and_references", "documents", f"with {SQL_ANNOTATED} select doc_id, {_R('text', *_FIGURES, *_CROSS, _ETAL, r'\[.*?\]')} as clean from d")(lambda df: annotated(df).select("doc_id", T.compose(T.strip_figures, T.strip_references, T.strip_et_al, T.strip_brackets)(F.col("text")).alias("clean")))
_SQUEEZE = lambda x: f"regexp_replace(regexp_replace(regexp_replace({x}, '[^\\S\\n]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '{STRIP}', '', 'g')"
_KNOWN = _R("replace(replace(replace(replace(text, '锟斤拷', ''), '烫烫烫', ''), '屯屯屯', ''), chr(65533), '')", r"[^\x20-\x7E\x{4E00}-\x{9FFF}\x{3000}-\x{303F}\x{FF00}-\x{FFEF}\n\r\t]")
query("preset_file", "documents", f"with {SQL_ANNOTATED} select doc_id, {_SQUEEZE(_R(_KNOWN, '<[^>]+>', r'https?://[^ ]+'.replace('[^ ]', chr(92) + 'S')))} as clean from d")(lambda df: annotated(df).select("doc_id", T.PRESETS["file"](F.col("text")).alias("clean")))
query("preset_folder", "documents", f"with {SQL_ANNOTATED} select doc_id, {_SQUEEZE(_KNOWN)} as clean from d")(lambda df: annotated(df).select("doc_id", T.PRESETS["folder"](F.col("text")).alias("clean")))
query("preset_code", "documents", "select doc_id, text as clean from documents")(lambda df: df.select("doc_id", T.PRESETS["code"](F.col("text")).alias("clean")))
query("drop_comments_java", "documents", r"""with t as (select doc_id, replace(text, '. ', ' // x' || chr(10) || '/* y' || chr(10) || ' z */ ') as text from documents) select doc_id, regexp_replace(regexp_replace(text, '(?m)//.*$', '', 'g'), '/\*[\s\S]*?\*/', '', 'g') as clean from t""")(
    lambda df: df.select("doc_id", T.drop_comments("java")(F.replace("text", F.lit(". "), F.lit(" // x\n/* y\n z */ "))).alias("clean"))
)
#: Sections of the annotated texts, whose headings have up to three levels.
SQL_SECTIONS = f"""{SQL_MARKDOWN_LINES},
h as (select *, x like '#%' as head, least(length(regexp_extract(x, '^#+')), 6) as level, regexp_replace(regexp_replace(x, '^#+|#+$', '', 'g'), '{STRIP}', '', 'g') as title from ls),
s as (select *, sum(head::int) over (partition by doc_id order by n) as sec from h),
p as (select * from s where head),
above as (select a.doc_id, a.sec, a.title, a.level, (select list(b.title order by b.sec) from p b where b.doc_id = a.doc_id and b.sec < a.sec and b.level < a.level and not exists (select 1 from p z where z.doc_id = a.doc_id and z.sec > b.sec and z.sec < a.sec and z.level <= b.level)) as up from p a),
y as (select s.doc_id, s.sec, string_agg(x || case when not regexp_matches(x, '[。.！？；;：:]$') and later then ' ' else '' end, '' order by n) as body from (select *, lead(sec) over (partition by doc_id order by n) is not distinct from sec as later from s where not head) s where sec > 0 group by all),
o as (select v.doc_id, v.sec, v.title, array_to_string(list_append(coalesce(v.up, []), v.title), ' > ') as full_path, v.level, body, len(coalesce(v.up, [])) as depth, list_concat(coalesce(v.up, [])[-1:], [v.title]) as two from above v join y using (doc_id, sec)),
f as (select * from o where length(regexp_replace(body, '[^\\pL\\pN_]', '', 'g')) > case when depth = 0 then 150 else 50 end and not list_bool_or(list_transform(two, lambda t: regexp_matches(lower(t), '{"|".join(T.SKIP)}'))))"""
query("markdown_sections", "documents", f"with {SQL_SECTIONS} select doc_id, row_number() over (partition by doc_id order by sec) - 1 as section_no, title, full_path, level, body, length(body) as char_count from f")(lambda df: chunks.markdown_sections(annotated(df)))
SQL_PLAIN_SECTIONS = f"""{SQL_PLAIN_LINES},
h as (select *, regexp_matches(x, '^第[一二三四五六七八九十百千万\\d]+[章节篇部]|^\\d+[.、]\\s*\\S+|^#\\s*.+') as head from ls where x <> ''),
s as (select *, sum(head::int) over (partition by doc_id order by n) as sec from h),
g as (select doc_id, sec, max(x) filter (head) as x, string_agg(x, chr(10) order by n) filter (not head) as body from s group by all),
t as (select doc_id, sec, case when x is null then doc_id::varchar when x like '#%' then regexp_replace(substr(x, 2), '{STRIP}', '', 'g') else x end as title, case when x is null or not regexp_matches(x, '^\\d+[.、]\\s*\\S+') then 1 else 2 end as level, regexp_replace(body, '{STRIP}', '', 'g') as body from g),
f as (select * from t where length(body) > 30)"""
query("plain_sections", "documents", f"with {SQL_PLAIN_SECTIONS} select doc_id, row_number() over (partition by doc_id order by sec) - 1 as section_no, title, title as full_path, level, body, length(body) as char_count from f")(lambda df: chunks.plain_sections(annotated(df), mend=False))


def sql_packs(pieces: str, most: int, least: int) -> str:
    """Packs of the lists *ss* of *pieces* (k, ss), greedy: (k, pack_no, content)."""
    return f"""with recursive {pieces},
w as (select k, ss, 1 as i, ''::varchar as cur, []::varchar[] as out from pieces union all
  select k, ss, i + 1, case when cur <> '' and length(cur) + length(ss[i]) > {most} then ss[i] else cur || ss[i] end, case when cur <> '' and length(cur) + length(ss[i]) > {most} then list_append(out, cur) else out end from w where i <= len(ss)),
e as (select k, unnest(list_append(out, cur)) as c, generate_subscripts(list_append(out, cur), 1) as j from w where i = len(ss) + 1),
packs as (select k, row_number() over (partition by k order by j) - 1 as pack_no, regexp_replace(c, '{STRIP}', '', 'g') as content from e where length(regexp_replace(c, '{STRIP}', '', 'g')) >= greatest({least}, 1))"""


query("chunks", "documents", sql_packs(f"pieces as (select doc_id as k, {SQL_SENTENCES} as ss from documents)", 500, 50) + " select k as doc_id, pack_no as chunk_no, content, length(content) as char_count from packs")(lambda df: chunks.chunks(df))
query(
    "section_chunks", "documents",
    sql_packs(SQL_SECTIONS + f", q as (select doc_id, sec, full_path, title, level, body as text from f), pieces as (select struct_pack(doc_id := doc_id, sec := sec, title := title, full_path := full_path, level := level) as k, {SQL_SENTENCES} as ss from q)", 500, 50)
    + " select content, k.title as section_title, k.full_path as full_path, k.doc_id as source_file, 'md' as source_type, row_number() over (order by k.doc_id, k.sec, pack_no) - 1 as chunk_index, k.level as level, length(content) as char_count from packs",
)(lambda df: chunks.section_chunks(chunks.markdown_sections(annotated(df)).withColumnRenamed("doc_id", "source_file").withColumn("kind", F.lit("md")), source_type="kind"))
query("packed_paragraphs", "documents", sql_packs(rf"par as (select doc_id, unnest(string_split(replace(text, '. ', '.' || chr(10) || chr(10)), chr(10) || chr(10))) as p, generate_subscripts(string_split(replace(text, '. ', '.' || chr(10) || chr(10)), chr(10) || chr(10)), 1) as n from documents), q as (select doc_id, n, regexp_replace(p, '{STRIP}', '', 'g') as text from par), pieces as (select struct_pack(doc_id := doc_id, n := n) as k, case when length(text) <= 80 then [text] else {SQL_SENTENCES} end as ss from q where text <> '')", 80, 1) + " select k.doc_id as doc_id, row_number() over (partition by k.doc_id order by k.n, pack_no) - 1 as pos, content as text from packs")(
    lambda df: df.select("doc_id", F.posexplode(chunks.paragraphs(F.replace("text", F.lit(". "), F.lit(".\n\n")), 80)).alias("pos", "text"))
)
query("headed_parts", "documents", rf"""with d as (select doc_id, '# A' || doc_id || chr(10) || replace(text, '. ', '.' || chr(10) || chr(10)) || chr(10) || '## B ' || chr(10) || text || chr(10) || '# C' as text from documents),
p as (select doc_id, unnest(string_split(text, chr(10) || '#')) as p, generate_subscripts(string_split(text, chr(10) || '#'), 1) - 1 as section_no from d),
q as (select doc_id, section_no, case when p like '#%' then p else '#' || p end as p from (select doc_id, section_no, regexp_replace(p, '{STRIP}', '', 'g') as p from p)),
r as (select doc_id, section_no, regexp_replace(regexp_replace(split_part(p, chr(10), 1), '^#+', ''), '{STRIP}', '', 'g') as title, case when instr(p, chr(10)) > 0 then substr(p, instr(p, chr(10)) + 1) else '' end as body from q),
s as (select doc_id, section_no, title, list_filter(list_transform(string_split(body, chr(10) || chr(10)), lambda x: regexp_replace(x, '{STRIP}', '', 'g')), lambda x: x <> '') as ps from r),
t as (select doc_id, section_no, title, unnest(ps) as text, generate_subscripts(ps, 1) - 1 as pos from s) select doc_id, section_no, pos, title, text from t where length(text) >= 10""")(
    lambda df: chunks.headed_parts(df.select("doc_id", F.concat(F.lit("# A"), "doc_id", F.lit("\n"), F.replace("text", F.lit(". "), F.lit(".\n\n")), F.lit("\n## B \n"), "text", F.lit("\n# C")).alias("text")))
)
query("long_sentences", "documents", rf"""{sql_packs("pieces as (select doc_id as k, ['x'] as ss from documents)", 1, 1).split("pieces as")[0]} d as (select doc_id, list_filter(list_transform(string_split(replace(text, ';', ','), ','), lambda x: regexp_replace(x, '{STRIP}', '', 'g')), lambda x: x <> '') as ps, text from documents),
w as (select doc_id, ps, 1 as i, ''::varchar as cur, []::varchar[] as out from d where length(text) > 200 union all
  select doc_id, ps, i + 1, case when cur <> '' and length(cur) + length(ps[i]) + 1 > 200 then ps[i] when cur <> '' then cur || '，' || ps[i] else ps[i] end, case when cur <> '' and length(cur) + length(ps[i]) + 1 > 200 then list_append(out, cur) else out end from w where i <= len(ps)),
e as (select doc_id, list_append(out, cur) as o from w where i = len(ps) + 1 union all select doc_id, [text] from d where length(text) <= 200)
select doc_id, unnest(o) as part from e""")(lambda df: df.select("doc_id", F.explode(chunks.long_sentence(F.col("text"), 200)).alias("part")))
query("source_types", "documents", "select doc_id, case when lang = 'en' then 'pdf' when doc_id % 3 = 0 then 'docx' when doc_id % 3 = 1 then 'md' else 'unknown' end as kind from documents")(
    lambda df: df.select("doc_id", chunks.source_type(F.col("doc_id"), F.when(F.col("lang") == "en", "pdf").otherwise(""), F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("md"), F.lit("docx"))).when(F.col("doc_id") % 3 == 1, F.array(F.lit("md"))).otherwise(F.array().cast("array<string>"))).alias("kind"))
)
#: JSON records of all formats, some of them broken, made of turns.
_RAW = """case turn % 8 when 0 then '{"question":' || q || ',"answer":' || q || ',"context":"c"}' when 1 then '{"instruction":' || q || ',"input":"","output":"ok"}' when 2 then '{"conversations":[{"from":"human","value":' || q || '},{"from":"system","value":"s"}]}'
  when 3 then '{"messages":[{"role":"' || role || '","content":' || q || '},{"role":"assistant","content":"fine"}]}' when 4 then '{"prompt":' || q || ',"completion":"done"}' when 5 then '{"text":' || q || '}' when 6 then '{"messages":[{"role":"robot","content":' || q || '}' else '{"messages":[{"role":"robot","content":' || q || '},{"role":"user"}]}' end"""


def raw_records(df: DataFrame) -> DataFrame:
    return df.where("text is not null").select("conv_id", "turn", F.expr("replace(to_json(named_struct('q', text)), '{\"q\":', '')").alias("q"), "role", "text").selectExpr("conv_id", "turn", "text", "role", "substr(q, 1, length(q) - 1) as q").selectExpr("conv_id", "turn", "text", "role", f"{_RAW} as value")


_CHAT = {0: "'[{\"role\":\"user\",\"content\":' || to_json('背景信息：' || chr(10) || 'c' || chr(10) || chr(10) || '问题：' || text) || '},{\"role\":\"assistant\",\"content\":' || to_json(text) || '}]'", 1: "'[{\"role\":\"user\",\"content\":' || to_json(text) || '},{\"role\":\"assistant\",\"content\":\"ok\"}]'", 2: "'[{\"role\":\"user\",\"content\":' || to_json(text) || '},{\"role\":\"assistant\",\"content\":\"s\"}]'"}
SQL_RAW = f"r as (select conv_id, turn, role, text, to_json(text)::varchar as q from conversations where text is not null), v as (select *, {_RAW} as value from r)"
SQL_CONVERTED = SQL_RAW + ", s as (select conv_id, turn, text, value, case turn % 8 when 0 then 2 * length(text) + 12 when 1 then length(text) + 2 when 2 then length(text) + 1 when 3 then length(text) + 4 when 7 then length(text) end as n from v)"
query(
    "sft_converted", "conversations",
    f"with {SQL_CONVERTED} select conv_id, turn, case turn % 8 when 0 then 'qa' when 1 then 'alpaca' when 2 then 'sharegpt' when 3 then 'messages' when 7 then 'messages' when 6 then 'broken' else 'unknown' end as format, case when turn % 8 = 6 then 'error' when n between 40 and 400 then 'converted' else 'skipped' end as status, "
    + "case when n between 40 and 400 then case " + " ".join(f"when turn % 8 = {k} then '{{\"messages\":' || {v} || '}}'" for k, v in _CHAT.items()) + " else value end end as record from s",
)(lambda df: sft.convert(raw_records(df), least=40, most=400).select("conv_id", "turn", "format", "status", "record"))
query("sft_conversion_stats", "conversations", f"with {SQL_CONVERTED} select count(*) as total, count(*) filter (n between 40 and 400) as converted, count(*) filter (turn % 8 <> 6 and not coalesce(n between 40 and 400, false)) as skipped, count(*) filter (turn % 8 = 6) as errors from s")(lambda df: sft.conversion_stats(sft.convert(raw_records(df), least=40, most=400)))
query("prompt_completions", "conversations", f"with {SQL_RAW} select conv_id, turn, '{{\"prompt\":' || q || ',\"completion\":' || q || '}}' as record from v where turn % 8 = 0 and 2 * length(text) between 10 and 50000")(lambda df: sft.convert(raw_records(df), output_format="prompt-completion").where("format = 'qa' and status = 'converted'").select("conv_id", "turn", "record"))
_ERRORS = "case turn % 8 when 3 then [] when 4 then [] when 6 then ['malformed JSON'] when 7 then ['message 0 has an unknown role: robot', 'message 1 has no content', 'last message is not the assistant''s'] else ['unknown format'] end"
query("sft_checked", "conversations", f"with {SQL_RAW} select conv_id, turn, case turn % 8 when 3 then 'messages' when 7 then 'messages' when 4 then 'prompt-completion' when 5 then 'text' when 6 then 'broken' else 'unknown' end as format, array_to_string({_ERRORS}, '; ') as errors, len({_ERRORS}) = 0 as valid from v")(
    lambda df: sft.check(raw_records(df), strict=True).select("conv_id", "turn", "format", F.array_join("errors", "; ").alias("errors"), "valid")
)
query("sft_validation_stats", "conversations", f"with {SQL_RAW}, c as (select turn % 8 as k, case turn % 8 when 3 then length(text) + 4 when 7 then length(text) end as n, len({_ERRORS}) as e from v) select count(*) as samples, count(*) filter (e = 0) as valid, count(*) filter (e > 0) as invalid, sum(e)::bigint as errors, min(n) as min_chars, max(n) as max_chars, avg(n) as avg_chars, avg(case when n is not null then 2.0 end) as avg_messages from c")(
    lambda df: sft.validation_stats(sft.check(raw_records(df), strict=True))
)
query("sft_frequencies", "conversations", f"""with {SQL_RAW}, c as (select turn % 8 as k, role, {_ERRORS} as e from v),
f as (select unnest(case k when 0 then ['question', 'answer', 'context'] when 1 then ['instruction', 'input', 'output'] when 2 then ['conversations'] when 3 then ['messages'] when 7 then ['messages'] when 4 then ['prompt', 'completion'] when 5 then ['text'] else [] end) as name from c),
ro as (select unnest(case k when 3 then [role, 'assistant'] when 7 then ['robot', 'user'] else [] end) as name from c), e as (select unnest(e) as name from c)
select 'field' as kind, name, count(*) as n from f group by 2 union all select 'role', name, count(*) from ro group by 2 union all select 'error', name, count(*) from e group by 2""")(lambda df: sft.frequencies(sft.check(raw_records(df), strict=True)))
query("code_messages", "documents", "select doc_id, case when doc_id % 2 = 0 then '请用SQL编写代码：' || source else '请用SQL编写代码' end as ask, '```SQL' || chr(10) || text || chr(10) || '```' as answer from documents")(
    lambda df: df.select("doc_id", records.code_messages(F.col("text"), F.lit("SQL"), F.when(F.col("doc_id") % 2 == 0, F.col("source"))).alias("m")).select("doc_id", *_first(F.col("m")))
)
query("translation_messages", "documents", "select doc_id, '请将以下法文翻译成德文：' || chr(10) || chr(10) || text as ask, source as answer from documents")(
    lambda df: df.select("doc_id", records.translation_messages(F.col("text"), F.col("source"), "法文", "德文").alias("m")).select("doc_id", *_first(F.col("m")))
)
query("openassistant_messages", "conversations", "select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as content from conversations")(
    lambda df: df.select("conv_id", "turn", F.inline(records.openassistant_messages(F.array(F.struct("role", F.col("text").alias("content"))))))
)
query("qa_prompts", "documents", "select doc_id, strlen('请为下面的材料编写3组问答。问题要具体且角度各异，答案要完整并只依据材料。每组写成两段，分别以Q:和A:开头。' || chr(10) || chr(10) || '材料：' || chr(10) || text) as n from documents")(lambda df: df.select("doc_id", F.octet_length(sft.qa_prompt(F.col("text"))).alias("n")))
query("parsed_pairs", "documents", """with d as (select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') as ls from documents) select doc_id, 'q' || doc_id as question, array_to_string(list_concat(['first'], ls), chr(10)) as answer from d union all select doc_id, '二', '乙' from documents""")(
    lambda df: df.select("doc_id", F.inline(records.pairs_of(F.concat(F.lit("noise\nQ: q"), "doc_id", F.lit("\nlost\nA: first\n"), "text", F.lit("\n问题：二\n答案: 乙\nQ: dangling")))))
)
query("parsed_turns", "documents", """with d as (select doc_id, list_transform(string_split(text, chr(10)), lambda x: trim(x)) as ls from documents) select doc_id, 'user' as role, 'ask ' || doc_id as content from d union all select doc_id, 'assistant', regexp_replace(array_to_string(list_concat(['reply'], ls), chr(10)), '\\s+$', '') from d""")(
    lambda df: df.select("doc_id", F.inline(records.turns_of(F.concat(F.lit("lost\nUser: ask "), "doc_id", F.lit("\n助手: reply\n"), "text"))))
)
query("category_map", "pages", "with p as (select '/data/' || regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') as p from pages), s as (select p, regexp_replace(regexp_extract(p, '[^/]*$'), '(.)[.][^.]*$', '\\1') as stem, regexp_extract(p, '^/data/([^/]+)/', 1) as category from p) select stem, arg_max(category, p) as category from s group by 1")(
    lambda df: records.category_map(df.select(F.concat(F.lit("/data/"), F.regexp_replace(F.regexp_replace("url", "^https?://", ""), "[?#].*$", "")).alias("path")), "/data")
)
query("index_stats", "pages", "with i as (select regexp_extract(url, '^https?://[^/]+/([^/]+)', 1) as category, sha256(html) as h, strlen(html) as n from pages) select category, count(*) as files, count(distinct h) as \"unique\", count(*) - count(distinct h) as duplicates, sum(n)::bigint as bytes from i group by 1")(
    lambda df: records.index_stats(df.select(F.regexp_replace("url", "^https?://[^/]+", "/data").alias("path"), F.sha2("html", 256).alias("sha256"), F.octet_length("html").cast("long").alias("size")), "/data")
)
query("corpus_types", "documents", "with t as (select lang, count(*) as n from documents group by 1) select (select string_agg(lang || '=' || n, ',' order by lang) from t) as types, (select round(avg(n_chars), 4) from documents) as mean_score, (select count(distinct source) from documents) as n_sources, (select count(*) from documents) as total_records")(
    lambda df: records.corpus_metadata(df, score="n_chars").select(F.array_join(F.transform(F.map_entries("types"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("types"), "mean_score", "n_sources", "total_records")
)
query("funnel", "documents", "select 0 as step_no, 'all' as step, count(*) as rows from documents union all select 1, 'long', count(*) from documents where length(text) > 1000 union all select 2, 'english', count(*) from documents where length(text) > 1000 and lang = 'en'")(
    lambda df: records.funnel(all=df, long=df.where("length(text) > 1000"), english=df.where("length(text) > 1000 and lang = 'en'"))
)
query("split_info", "documents", "select 'documents' as source, 42 as seed, 0.1::double as test_size, 0.05::double as val_size, count(*) as total, count(*) - floor(count(*) * 0.1)::bigint - floor(count(*) * 0.05)::bigint as train, floor(count(*) * 0.05)::bigint as val, floor(count(*) * 0.1)::bigint as test from documents")(
    lambda df: records.split_info(records.split(df.select("doc_id"), 0.1, 0.05), "documents", 0.1, 0.05, 42)
)
