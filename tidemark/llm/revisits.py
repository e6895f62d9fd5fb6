"""WARC not-modified revisits: what a 304 stands for.

A revisit record has no payload. It is resolved to the latest earlier full
response of the same canonical URL (as-of join), its validators are checked
against that response (entity tag by weak comparison, else the last-modified
date), and the stored headers are brought up to date with those of the revisit
that may change: headers that describe the payload or the connection stay.

The as-of join has two levels, so that a URL with a third of all records isn't
sorted in one task: inside (URL, time block) a window looks back, and across the
blocks of a URL only the latest response of each block, found by partial
aggregation, is carried forward. Payloads take no part; only record ids do.

Times are whole microseconds. Earlier means strictly earlier; of responses at
one time the largest record id counts. Null URL or time: nothing to resolve,
outcome ``no_response``. Null headers: none. Record ids are meant to be unique;
repeated records resolve alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: One hour, in microseconds.
BLOCK = 3_600_000_000

# fixed values: headers that a 304 may not change
PAYLOAD_HEADERS = (
    "connection", "content-encoding", "content-length", "content-location", "content-md5", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, without user, default port, fragment and
    empty parameters; parameters in order; an empty path is ``/``."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    rest = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?"
    host = F.lower(F.regexp_extract(u, rest + r"([^/?:]*)", 1))
    port = F.regexp_extract(u, rest + r"[^/?:]*:([0-9]+)", 1)
    default = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")) | (port == "")
    path = F.regexp_extract(u, rest + r"[^/?]*(/[^?]*)", 1)
    query = F.array_join(F.array_sort(F.array_remove(F.split(F.regexp_extract(u, r"\?(.*)$", 1), "&"), "")), "&")
    return F.when(host == "", u).otherwise(
        F.concat(
            scheme, F.lit("://"), host, F.when(default, F.lit("")).otherwise(F.concat(F.lit(":"), port)),
            F.when(path == "", F.lit("/")).otherwise(path), F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)),
        )
    )


def _lower_keys(headers: Column) -> Column:
    """Header names in lower case; of names that differ in case the last one in order counts."""
    entries = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    names = F.transform(entries, lambda e: F.lower(e["key"]))
    keep = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), F.lower(e["key"])))
    return F.map_from_entries(F.transform(keep, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """``stored`` with the permitted headers of ``fresh`` (names in lower case)."""
    allowed = F.map_filter(fresh, lambda k, v: ~k.isin(*PAYLOAD_HEADERS))
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(allowed, k)), allowed)


def resolve(records: DataFrame, block: int = BLOCK) -> DataFrame:
    """``records``: ``record_id long, url, at long (microseconds), status int,
    headers map<string,string>, digest, length``. For each record of status 304:
    ``record_id, url, canonical, at, outcome`` (``resolved``, ``unvalidated``: it
    names no validator, ``mismatch``, ``no_response``), ``response_id``, and of
    the response ``digest``, ``length`` and the merged ``headers`` (null unless
    resolved or unvalidated)."""
    rows = records.select(
        "record_id", "url", canonical_url(F.col("url")).alias("canonical"), "at", "status", _lower_keys(F.col("headers")).alias("headers"), "digest", "length",
        F.floor(F.col("at") / block).alias("block"),
    )
    light = rows.where("status IN (200, 304) AND canonical IS NOT NULL AND at IS NOT NULL").select("record_id", "canonical", "at", "status", "block")
    full = F.when(F.col("status") == 200, F.struct("at", "record_id"))
    look_back = Window.partitionBy("canonical", "block").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    inside = light.withColumn("near", F.max(full).over(look_back)).where("status = 304").select("record_id", "canonical", "at", "block", "near")
    latest = light.groupBy("canonical", "block").agg(F.max(full).alias("latest"))
    carried = latest.withColumn("carried", F.max("latest").over(Window.partitionBy("canonical").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)))
    asof = (
        inside.join(carried.select("canonical", "block", "carried"), ["canonical", "block"])
        .select("record_id", "at", F.coalesce("near", "carried")["record_id"].alias("response_id"))
        .where("response_id IS NOT NULL").distinct()
    )
    revisit = rows.where("status = 304").select("record_id", "url", "canonical", "at", F.col("headers").alias("fresh"))
    response = rows.where("status = 200").select(F.col("record_id").alias("response_id"), F.col("headers").alias("stored"), "digest", "length").dropDuplicates(["response_id"])
    found = revisit.join(asof, ["record_id", "at"], "left").join(response, "response_id", "left")
    tag = lambda h: F.regexp_replace(F.element_at(h, "etag"), "^W/", "")
    date = lambda h: F.element_at(h, "last-modified")
    fresh, stored = F.col("fresh"), F.col("stored")
    outcome = (
        F.when(F.col("response_id").isNull(), "no_response")
        .when(tag(fresh).isNotNull(), F.when(tag(fresh).eqNullSafe(tag(stored)), "resolved").otherwise("mismatch"))
        .when(date(fresh).isNotNull(), F.when(date(fresh).eqNullSafe(date(stored)), "resolved").otherwise("mismatch"))
        .otherwise("unvalidated")
    )
    good = outcome.isin("resolved", "unvalidated")
    return found.select(
        "record_id", "url", "canonical", "at", outcome.alias("outcome"), "response_id",
        F.when(good, F.col("digest")).alias("digest"), F.when(good, F.col("length")).alias("length"), F.when(good, merged_headers(stored, fresh)).alias("headers"),
    )


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Crawl records from a table of pages (page_id, url, html): a full response
    for each page and a revisit of it some days later under another spelling of
    its URL; every fifth revisit names another entity tag, every seventh a date
    only, every eleventh no validator."""
    day = 86_400_000_000
    p = pages.select(
        "page_id", "url", F.md5(F.coalesce("html", F.lit(""))).alias("digest"), F.octet_length(F.coalesce("html", F.lit(""))).cast("long").alias("length"),
        (F.col("page_id") * 60_000_000).alias("t"),
    )
    tag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))
    when = F.date_format(F.timestamp_micros("t"), "yyyy-MM-dd HH:mm:ss")
    head = lambda *kv: F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in kv])
    full = p.select(
        (F.col("page_id") * 2).alias("record_id"), "url", F.col("t").alias("at"), F.lit(200).alias("status"),
        head("ETag", tag, "Last-Modified", when, "Content-Type", "text/html", "Content-Length", F.col("length").cast("string"), "Cache-Control", "max-age=60").alias("headers"),
        "digest", "length",
    )
    later = F.col("t") + (1 + F.col("page_id") % 7) * day
    validators = (
        F.when(F.col("page_id") % 11 == 0, head("Content-Length", "0"))
        .when(F.col("page_id") % 7 == 0, head("Last-Modified", when, "Content-Length", "0"))
        .when(F.col("page_id") % 5 == 0, head("ETag", '"other"', "Content-Length", "0"))
        .otherwise(head("ETag", F.concat(F.lit("W/"), tag), "Content-Length", "0"))
    )
    again = p.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.concat("url", F.when(F.col("url").contains("#"), F.lit("")).otherwise(F.lit("#again"))).alias("url"),
        later.alias("at"), F.lit(304).alias("status"),
        F.map_concat(validators, head("Cache-Control", "max-age=600", "Date", F.date_format(F.timestamp_micros(later), "yyyy-MM-dd HH:mm:ss"))).alias("headers"),
        F.lit(None).cast("string").alias("digest"), F.lit(None).cast("long").alias("length"),
    )
    return full.unionByName(again)
