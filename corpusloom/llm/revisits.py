"""WARC not-modified revisits, resolved.

A revisit record takes the body of the latest strictly earlier full response of its canonical
URL: an as-of join, done as a window over both kinds of records, without their payloads.  A URL's records are dealt to
stretches of dates, each of which starts with the latest response before it, so that no task holds all of a hot URL.  The validators must agree
(entity tag if both have one, weakly compared, else the last-modified date); then the stored headers
are updated by those that a 304 answer may carry, and the payloads of the responses referred to are joined.

The canonical URL has no scheme, ``www.``, default port of its scheme (none means http), fragment, ``index.html``, trailing slash, or
tracking parameters; the host is lower-case, parameters are sorted.

Defined cases: status is ``resolved``, ``validator_mismatch``, ``no_validator`` (nothing to compare) or ``no_response``;
a null URL or date has no response; responses of one date: the largest id, then the largest of the other fields and of the payload's digest; repeated rows of a
revisit each give a row, of a response count once; absent headers are empty, and of names that differ in case only the last in byte order counts; null and empty payloads stay so; payloads of any
length are kept whole; other columns aren't looked at; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .common import cut, fitted

#: What a 304 answer may change (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
SCHEME = "^([a-zA-Z][a-zA-Z0-9+.-]*://)?"


def canonical_url(url: Column) -> Column:
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_extract(bare, SCHEME + "([^/?]*)", 2))
    host = F.regexp_replace(host, F.when(F.lower(bare).startswith("https:"), ":443$").otherwise(":80$"), "")
    rest = F.regexp_replace(bare, SCHEME + "[^/?]*", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, "^[^?]*", 0), "/index[.]html?$", ""), "/+$", "")
    query = F.array_join(F.array_sort(F.filter(F.split(F.regexp_extract(rest, "[?](.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.concat(F.regexp_replace(host, "^www[.]", ""), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def lower_names(headers: Column) -> Column:
    """Headers by lower-case name; of those that differ in case only, the last."""
    entries = F.array_sort(F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("name"), e["key"].alias("key"), e["value"].alias("value"))))
    last = F.filter(entries, lambda e, i: ~F.coalesce(F.get(entries, i + 1)["name"] == e["name"], F.lit(False)))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["name"], e["value"])))


def _latest(narrow: DataFrame) -> DataFrame:
    """Adds r, the latest response before each row, to rows (canonical_url, date, response: itself if it is one)."""
    ends = narrow.agg(F.count("*").alias("n"), F.min("date").alias("low"), F.max("date").alias("high")).head()
    stretches = max(1, -(-ends["n"] // common.PREFIX_ROWS))
    width = ((ends["high"] or 0) - (ends["low"] or 0)) // stretches + 1
    narrow = narrow.withColumn("stretch", F.expr(f"(date - {ends['low'] or 0}) div {width}"))
    before = Window.partitionBy("canonical_url").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    base = narrow.groupBy("canonical_url", "stretch").agg(F.max("response").alias("x")).select("canonical_url", "stretch", F.max("x").over(before).alias("base"))
    inside = Window.partitionBy("canonical_url", "stretch").orderBy("date").rangeBetween(Window.unboundedPreceding, -1)
    rows = narrow.join(base, ["canonical_url", "stretch"])
    return rows.withColumn("r", F.coalesce(F.max("response").over(inside), "base")).drop("base", "stretch")


def resolve(records: DataFrame) -> DataFrame:
    """(record_id, url, canonical_url, status, refers_to, headers, payload) of each revisit, from records
    (record_id, kind, url, date long, etag, last_modified, headers map, payload)."""
    empty = F.create_map().cast("map<string,string>")
    digest = F.coalesce(F.sha2("payload", 256), F.lit(""))
    response = F.struct("date", "record_id", "etag", "last_modified", F.to_json("headers").alias("headers"), digest.alias("digest"))
    narrow = cut(records.select("record_id", "kind", "url", canonical_url(F.col("url")).alias("canonical_url"), "date", "etag", "last_modified", "headers", F.when(F.col("kind") == "response", response).alias("response")), "records")
    placed = _latest(narrow.where("canonical_url is not null and date is not null"))
    lost = narrow.where("canonical_url is null or date is null").withColumn("r", F.lit(None).cast(placed.schema["r"].dataType))
    rows = placed.unionByName(lost).where("kind = 'revisit'")
    tag = lambda c: F.regexp_replace(F.regexp_replace(F.trim(F.col(c)), "^W/", ""), '^"|"$', "")
    agree = F.coalesce(tag("etag") == tag("r.etag"), F.col("last_modified") == F.col("r.last_modified"))
    status = F.when(F.col("r").isNull(), "no_response").when(agree.isNull(), "no_validator").when(agree, "resolved").otherwise("validator_mismatch")
    rows = cut(rows.select("record_id", "url", "canonical_url", status.alias("status"), F.coalesce("headers", empty).alias("fresh"), "r"), "resolved")
    stored = lower_names(F.coalesce(F.from_json("r.headers", "map<string,string>"), empty))
    fresh = F.map_filter(lower_names(F.col("fresh")), lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter(F.col("stored"), lambda k, v: ~F.map_contains_key("fresh", k))
    merged = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.map_concat(kept, "fresh")))))
    good = rows.where("status = 'resolved'").select("record_id", "url", "canonical_url", "status", F.col("r.record_id").alias("refers_to"), F.col("r.digest").alias("digest"), stored.alias("stored"), fresh.alias("fresh"))
    good = good.withColumn("headers", merged).drop("stored", "fresh")
    needed = cut(good.select("refers_to", "digest").distinct(), "needed")
    bodies = records.where("kind = 'response'").select(F.col("record_id").alias("refers_to"), digest.alias("digest"), "payload")
    bodies = bodies.join(fitted(needed, 100), ["refers_to", "digest"], "left_semi").groupBy("refers_to", "digest").agg(F.first("payload").alias("payload"))
    out = ["record_id", "url", "canonical_url", "status", "refers_to", "headers", "payload"]
    bare = rows.where("status <> 'resolved'").select("record_id", "url", "canonical_url", "status", F.when(F.col("status") != "no_response", F.col("r.record_id")).alias("refers_to"), F.lit(None).cast("string").alias("headers"), F.lit(None).cast(records.schema["payload"].dataType).alias("payload"))
    return good.join(bodies, ["refers_to", "digest"]).select(out).unionByName(bare.select(out))


#: Dates of the second crawl begin here.
SECOND_CRAWL = 1_000_000_000_000


def crawls(pages: DataFrame) -> DataFrame:
    """Records of two crawls over pages (page_id, url, html): the first stores each page, in the order of ids; in the
    second each answers that it's not modified since, with the entity tag of its own body."""
    pages = pages.select(F.col("page_id").cast("long").alias("record_id"), "url", F.col("html").alias("payload"))
    tag = F.concat(F.lit('"'), F.md5("payload"), F.lit('"'))
    none = F.lit(None).cast("string")
    first = pages.select(
        "record_id", F.lit("response").alias("kind"), "url", F.col("record_id").alias("date"), tag.alias("etag"), none.alias("last_modified"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.octet_length("payload").cast("string"), F.lit("ETag"), tag, F.lit("Date"), F.col("record_id").cast("string")).alias("headers"), "payload",
    )
    date = F.col("record_id") + SECOND_CRAWL
    second = pages.select(
        "record_id", F.lit("revisit").alias("kind"), "url", date.alias("date"), tag.alias("etag"), none.alias("last_modified"),
        F.create_map(F.lit("Content-Length"), F.lit("0"), F.lit("Server"), F.lit("edge"), F.lit("Date"), date.cast("string")).alias("headers"), none.alias("payload"),
    )
    return first.unionByName(second)
