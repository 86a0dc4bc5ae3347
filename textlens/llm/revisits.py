"""Resolving not-modified revisit records of web archives.

A revisit (HTTP 304) stands for the latest earlier full response of the same
canonical URL.  The as-of join range-partitions all records by (URL, time), so
a URL that holds a third of all records spreads over many tasks; within a
partition the last full response is carried forward by a window, and over
partition borders by a window with one row per URL and partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textlens.llm.common import materialise

#: Fixed values (RFC 9110, 15.4.5): header fields that a 304 response may
#: carry to update the stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical_url(url: Column) -> Column:
    """One spelling per page: scheme, ``www.``, default port, fragment, utm
    parameters and closing slash dropped, A-Z of the host lower-cased.  Null
    stays null."""
    rest = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[^/?]*", 0)), r"^www[.]", ""),
                            r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_replace(F.regexp_extract(rest, r"[?](.*)$", 1), r"(^|&)utm_[^&]*", "")
    query = F.regexp_replace(query, r"^&+", "")
    return F.concat(host, F.when(path == "", "/").otherwise(path),
                    F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def _plain(tag: Column) -> Column:
    return F.regexp_replace(tag, r"^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records(record_id, url, captured_at, status, headers, payload_digest)``
    -> one row per record: ``record_id, canonical, source_id, outcome,
    headers, payload_digest``.

    Status 304 is a revisit, 200 a full response (outcome ``full``, its own
    source), any other passes as ``other``.  A revisit looks at the latest full
    response captured before it (of several at one time the largest
    record_id): ``resolved`` if the entity tags of both are equal by weak
    comparison, or, where one has none, both last-modified dates; then it gets
    that record's headers, updated by its own PERMITTED ones, and digest.
    Otherwise it keeps its own and is ``changed``, ``unchecked`` (no validator
    in common) or ``missing`` (no earlier response, or no URL or time).

    Header names are lower-cased, null headers are none; of names that differ
    only in case the smallest value counts.  An empty table gives no rows."""
    entries = F.transform(F.map_entries(F.coalesce("headers", F.create_map().cast("map<string,string>"))),
                          lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    clean = F.map_from_entries(F.transform(names, lambda n: F.struct(
        n.alias("key"), F.array_min(F.transform(F.filter(entries, lambda e: e["key"] == n), lambda e: e["value"])).alias("value"))))
    r = records.select(
        "record_id", canonical_url(F.col("url").cast("string")).alias("canonical"),
        F.col("captured_at").cast("long").alias("at"), F.col("status").cast("int").alias("status"),
        clean.alias("headers"), "payload_digest")
    r = r.withColumn("full", F.coalesce((F.col("status") == 200) & F.col("canonical").isNotNull()
                                        & F.col("at").isNotNull(), F.lit(False)))
    # a revisit sorts before a response of the same time, which is not earlier
    keys = ["canonical", "at", "full", "record_id"]
    dealt = materialise(r.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "revisits")
    known = F.when(F.col("full"), F.struct("record_id", "headers", "payload_digest"))
    # only responses of the partitions before; one row per URL and partition
    ends = dealt.where("full").groupBy("canonical", "part").agg(
        F.max_by(F.struct("record_id", "headers", "payload_digest"), F.struct("at", "record_id")).alias("end"))
    present = dealt.where("canonical IS NOT NULL").select("canonical", "part").distinct().join(
        ends, ["canonical", "part"], "left")
    earlier = Window.partitionBy("canonical").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = present.select("canonical", "part", F.last("end", ignorenulls=True).over(earlier).alias("carried"))
    here = Window.partitionBy("canonical", "part").orderBy("at", "full", "record_id").rowsBetween(
        Window.unboundedPreceding, -1)
    seen = dealt.withColumn("near", F.last(known, ignorenulls=True).over(here)).join(
        carried, ["canonical", "part"], "left")
    s = F.when(F.col("canonical").isNotNull() & F.col("at").isNotNull(), F.coalesce("near", "carried"))
    seen = seen.withColumn("s", s).withColumn("tag", F.col("headers")["etag"]).withColumn(
        "date", F.col("headers")["last-modified"])
    tag, date = F.col("s.headers")["etag"], F.col("s.headers")["last-modified"]
    check = (F.when(F.col("tag").isNotNull() & tag.isNotNull(), _plain(F.col("tag")) == _plain(tag))
             .when(F.col("date").isNotNull() & date.isNotNull(), F.col("date") == date))
    outcome = (F.when(F.col("status") == 200, "full").when(F.coalesce(F.col("status") != 304, F.lit(True)), "other")
               .when(F.col("s").isNull(), "missing").when(check, "resolved")
               .when(~check, "changed").otherwise("unchecked"))
    seen = seen.withColumn("outcome", outcome)
    update = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("s.headers", lambda k, _: ~F.map_contains_key(update, k)), update)
    ok = F.col("outcome") == "resolved"
    return seen.select(
        "record_id", "canonical",
        F.when(ok, F.col("s.record_id")).when(F.col("outcome") == "full", F.col("record_id")).alias("source_id"),
        "outcome", F.when(ok, merged).otherwise(F.col("headers")).alias("headers"),
        F.when(ok, F.col("s.payload_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"))


def archive_records(pages: DataFrame) -> DataFrame:
    """Crawl records derived from ``pages(page_id, url, html)``: each page as
    a full response, and a later revisit of it under another spelling of its
    URL with a strong, weak, missing or outdated entity tag."""
    p = pages.select("page_id", "url", F.md5("html").alias("digest"), F.octet_length("html").alias("size"))
    i = F.col("page_id")
    tag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))
    day = F.concat(F.lit("day "), (i % 7).cast("string"))
    full = p.select(
        (i * 2).alias("record_id"), "url", (i * 10).alias("captured_at"), F.lit(200).alias("status"),
        F.map_from_entries(F.array_compact(F.array(
            F.when(i % 5 != 4, F.struct(F.lit("ETag").alias("key"), tag.alias("value"))),
            F.struct(F.lit("Last-Modified").alias("key"), day.alias("value")),
            F.struct(F.lit("Content-Length").alias("key"), F.col("size").cast("string").alias("value")),
            F.struct(F.lit("Cache-Control").alias("key"), F.lit("max-age=60").alias("value"))))).alias("headers"),
        F.col("digest").alias("payload_digest"))
    again = (F.when(i % 3 == 0, F.concat("url", F.lit("#again")))
             .when(i % 3 == 1, F.regexp_replace("url", "^https:", "http:")).otherwise(F.col("url")))
    sent = (F.when(i % 4 == 0, tag).when(i % 4 == 1, F.concat(F.lit("W/"), tag))
            .when(i % 4 == 3, F.lit('"outdated"')))
    revisit = p.select(
        (i * 2 + 1).alias("record_id"), again.alias("url"), (i * 10 + 25).alias("captured_at"),
        F.lit(304).alias("status"),
        F.map_from_entries(F.array_compact(F.array(
            F.when(sent.isNotNull(), F.struct(F.lit("etag").alias("key"), sent.alias("value"))),
            F.when(i % 8 != 6, F.struct(F.lit("last-modified").alias("key"), day.alias("value"))),
            F.struct(F.lit("content-length").alias("key"), F.lit("0").alias("value")),
            F.struct(F.lit("cache-control").alias("key"), F.lit("max-age=600").alias("value")),
            F.struct(F.lit("expires").alias("key"), i.cast("string").alias("value"))))).alias("headers"),
        F.lit(None).cast("string").alias("payload_digest"))
    return full.unionByName(revisit)


def revisits_query(pages: DataFrame) -> DataFrame:
    """Records derived from ``pages`` after ``resolve_revisits``; see there for
    nulls, ties and empty tables."""
    out = resolve_revisits(archive_records(pages))
    lines = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return out.select("record_id", "canonical", "source_id", "outcome",
                      F.array_join(F.array_sort(lines), "; ").alias("headers"), "payload_digest")


SQL = r"""
WITH p AS (SELECT page_id AS i, url, md5(html) AS digest, strlen(html) AS size FROM pages),
rec AS (
  SELECT i * 2 AS record_id, url, i * 10 AS ts, 200 AS status, i, digest,
         CASE WHEN i % 5 <> 4 THEN '"' || substr(digest, 1, 16) || '"' END AS etag, 'day ' || (i % 7) AS modified,
         CAST(size AS VARCHAR) AS length, 'max-age=60' AS cache, NULL AS expires, digest AS payload_digest FROM p
  UNION ALL
  SELECT i * 2 + 1, CASE i % 3 WHEN 0 THEN url || '#again' WHEN 1 THEN regexp_replace(url, '^https:', 'http:')
                    ELSE url END, i * 10 + 25, 304, i, digest,
         CASE i % 4 WHEN 0 THEN '"' || substr(digest, 1, 16) || '"' WHEN 1 THEN 'W/"' || substr(digest, 1, 16) || '"'
                    WHEN 3 THEN '"outdated"' END,
         CASE WHEN i % 8 <> 6 THEN 'day ' || (i % 7) END, '0', 'max-age=600', CAST(i AS VARCHAR), NULL FROM p),
u AS (SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM rec),
v AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '^www[.]', ''), ':(80|443)$', '') AS host,
             regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
             regexp_replace(regexp_replace(regexp_extract(rest, '[?](.*)$', 1), '(^|&)utm_[^&]*', '', 'g'), '^&+', '') AS query
      FROM u),
w AS (SELECT *, host || CASE path WHEN '' THEN '/' ELSE path END || CASE query WHEN '' THEN '' ELSE '?' || query END AS canonical
      FROM v),
f AS (SELECT canonical, ts, max(record_id) AS source_id, arg_max(etag, record_id) AS s_etag,
             arg_max(modified, record_id) AS s_modified, arg_max(length, record_id) AS s_length,
             arg_max(digest, record_id) AS s_digest
      FROM w WHERE status = 200 GROUP BY canonical, ts),
j AS (SELECT w.*, f.source_id, s_etag, s_modified, s_length, s_digest
      FROM w ASOF LEFT JOIN f ON w.canonical = f.canonical AND w.ts > f.ts),
k AS (SELECT *, CASE WHEN etag IS NOT NULL AND s_etag IS NOT NULL
                     THEN regexp_replace(etag, '^W/', '') = regexp_replace(s_etag, '^W/', '')
                     WHEN modified IS NOT NULL AND s_modified IS NOT NULL THEN modified = s_modified END AS same FROM j),
o AS (SELECT *, CASE WHEN status = 200 THEN 'full' WHEN source_id IS NULL THEN 'missing' WHEN same THEN 'resolved'
                     WHEN NOT same THEN 'changed' ELSE 'unchecked' END AS outcome FROM k)
SELECT record_id, canonical, CASE outcome WHEN 'resolved' THEN source_id WHEN 'full' THEN record_id END AS source_id, outcome,
       concat_ws('; ',
         'cache-control: ' || cache,
         'content-length: ' || CASE outcome WHEN 'resolved' THEN s_length ELSE length END,
         'etag: ' || CASE WHEN outcome = 'resolved' THEN coalesce(etag, s_etag) ELSE etag END,
         'expires: ' || expires,
         'last-modified: ' || CASE outcome WHEN 'resolved' THEN s_modified ELSE modified END) AS headers,
       CASE outcome WHEN 'resolved' THEN s_digest ELSE payload_digest END AS payload_digest
FROM o
"""
