"""Not-modified revisits of a web archive resolved to the response they confirm.

A revisit has no body. It stands for the latest earlier full response of the same canonical URL, if its validators agree. The
as-of join is a running last value over captures in (URL, time) order. The order is cut into range parts first, so the
captures of one URL may lie in many parts: a part looks at its own rows, and a table with one row for each URL and part hands
on the last response of the parts before. Bodies stay out of all of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.sources.lake import Scratch

ROWS = 50_000  # captures in a range part, about
#: Query parameters that name a visit, not a page; headers a 304 does not change (RFC 9111, 3.2).
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=.*)?$"
UNCHANGED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
             "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer",
             "transfer-encoding", "upgrade")


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` and default ports in lower case, path without last slash, sorted query without tracking.

    Scheme, user and fragment do not tell pages apart. Null for null; text that is no http(s) URL stays as it is.
    """
    pattern = r"^(?:[hH][tT][tT][pP][sS]?)://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(url, pattern, 1)), r":(80|443)?$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(url, pattern, 2), "/+$", "")
    query = F.filter(F.split(F.regexp_extract(url, pattern, 3), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    joined = F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(query), "&"))).otherwise("")
    return F.when(url.rlike(pattern), F.concat(host, path, joined)).otherwise(url)


def _tag(tag: Column) -> Column:
    """An entity tag without its weakness mark: 304 answers compare weakly."""
    return F.regexp_replace(F.trim(tag), "^[wW]/", "")


def merged_headers(stored: Column, fresh: Column) -> Column:
    """Headers of the stored response, with those of the 304 that may replace or join them; names are lower case.

    Framing and connection headers stay as stored, as do those the 304's ``connection`` header names.
    """
    named = F.transform(F.split(F.lower(F.coalesce(fresh["connection"], F.lit(""))), ","), lambda x: F.trim(x))
    allowed = F.map_filter(fresh, lambda k, v: ~k.isin(*UNCHANGED) & ~F.array_contains(named, k) & v.isNotNull())
    kept = F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_from_entries(F.array_sort(F.concat(F.map_entries(kept), F.map_entries(allowed))))


def resolve(captures: DataFrame, scratch: Scratch, rows_per_part: int = ROWS) -> DataFrame:
    """(record_id, url_key, captured, response_id, outcome, headers) for every 304 capture.

    ``captures(record_id, url, captured, status, headers)``: headers are maps with lower-case names, ``captured`` any ordered
    type. Only status 200 is a full response. ``outcome`` is ``resolved``; ``no_response`` if nothing earlier is there;
    ``etag_differs`` or ``date_differs`` if a validator both sides have disagrees (the tag decides where both have one); or
    ``no_validator`` if they share none. ``response_id`` is the response found even where validators disagree, ``headers``
    are merged for resolved ones and null otherwise. A response counts as earlier if (captured, record_id) is smaller. Rows
    without url or captured resolve to nothing and are no response. Null headers are empty; other columns are ignored. Rows that
    repeat another one whole each come back. ``record_id`` names a capture: of responses that share one and yet differ, the
    headers of one stand for all.
    """
    h = F.coalesce("headers", F.create_map().cast("map<string,string>"))
    # rows are numbered so that headers come back to the very row; the numbered log is written, as numbers must not change
    captures = scratch.write(captures.filter("status IN (200, 304)").select(
        "record_id", "url", "captured", "status", h.alias("headers"), F.monotonically_increasing_id().alias("row")))
    h = F.col("headers")
    rows = captures.select(
        "row", "record_id", canonical_url(F.col("url")).alias("url_key"), "captured", (F.col("status") == 200).alias("full"),
        _tag(h["etag"]).alias("etag"), h["last-modified"].alias("date"))
    whole = rows.filter("url_key IS NOT NULL AND captured IS NOT NULL")
    parts = max(1, -(-whole.count() // rows_per_part))
    order = ["captured", "record_id"]
    ranged = whole.repartitionByRange(parts, "url_key", *order) if parts > 1 else whole.coalesce(1)
    placed = scratch.write(ranged.withColumn("part", F.spark_partition_id()))
    response = F.when(F.col("full"), F.struct("record_id", "row", "etag", "date"))
    inside = Window.partitionBy("part", "url_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = placed.withColumn("_own", F.last(response, ignorenulls=True).over(inside)).filter("NOT full")
    ends = placed.groupBy("url_key", "part").agg(F.max(F.when(F.col("full"), F.struct(*order, "row", "etag", "date"))).alias("_last"))
    before = Window.partitionBy("url_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    handed = (ends.withColumn("_before", F.last("_last", ignorenulls=True).over(before)).filter("_before IS NOT NULL")
                  .select("url_key", "part", F.struct("_before.record_id", "_before.row", "_before.etag", "_before.date").alias("_before")))
    found = (own.join(handed, ["url_key", "part"], "left").withColumn("_r", F.coalesce("_own", "_before"))
                .select("row", "record_id", "url_key", "captured", "etag", "date", "_r"))
    found = found.unionByName(rows.filter("NOT full AND (url_key IS NULL OR captured IS NULL)")
                                  .select("row", "record_id", "url_key", "captured", "etag", "date", F.lit(None).cast(found.schema["_r"].dataType).alias("_r")))
    tags, dates = F.col("etag").isNotNull() & F.col("_r.etag").isNotNull(), F.col("date").isNotNull() & F.col("_r.date").isNotNull()
    outcome = (F.when(F.col("_r").isNull(), "no_response")
                .when(tags & (F.col("etag") != F.col("_r.etag")), "etag_differs")
                .when(~tags & dates & (F.col("date") != F.col("_r.date")), "date_differs")
                .when(tags | dates, "resolved").otherwise("no_validator"))
    judged = found.select("row", "record_id", "url_key", "captured", F.col("_r.record_id").alias("response_id"), F.col("_r.row").alias("_response_row"),
                          outcome.alias("outcome"))
    fresh = captures.filter("status = 304").select("row", h.alias("_fresh"))
    stored = captures.filter("status = 200").select(F.col("row").alias("_response_row"), h.alias("_stored"))
    both = judged.join(fresh, "row", "left").join(stored, "_response_row", "left")
    return both.select("record_id", "url_key", "captured", "response_id", "outcome",
                       F.when(F.col("outcome") == "resolved", merged_headers(F.col("_stored"), F.col("_fresh"))).alias("headers"))


def with_bodies(resolved: DataFrame, bodies: DataFrame) -> DataFrame:
    """Resolved revisits with the ``body`` of their response, from ``bodies(record_id, body)``."""
    named = bodies.select(F.col("record_id").alias("response_id"), "body")
    return resolved.filter("outcome = 'resolved'").join(named, "response_id")


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """A crawl log from ``pages(page_id, url, html)``: each page fetched once and asked for once more some time later.

    The response of page p is captured at 2 p under record 2 p. The later request, record 2 p + 1, carries the page's entity
    tag (weak for even p) or, for every fifth page, its date only, and is answered 304. If another page of the same canonical
    URL was captured meanwhile, the validators tell them apart.
    """
    tag = F.concat(F.lit('"'), F.md5(F.col("html").cast("binary")), F.lit('"'))
    date = F.concat(F.lit("day "), (F.col("page_id") % 1000).cast("string"))
    by_date = F.col("page_id") % 5 == 0
    length = F.octet_length("html").cast("string")
    full = F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), length, F.lit("etag"), tag,
                        F.lit("last-modified"), date, F.lit("cache-control"), F.lit("max-age=60"))
    weak = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag)
    again = F.create_map(F.lit("content-length"), F.lit("0"), F.lit("connection"), F.lit("close, x-hop"), F.lit("x-hop"), F.lit("1"),
                         F.lit("cache-control"), F.lit("max-age=600"), F.lit("age"), (F.col("page_id") % 7).cast("string"))
    checked = F.map_concat(again, F.when(by_date, F.create_map(F.lit("last-modified"), date)).otherwise(F.create_map(F.lit("etag"), weak)))
    one = pages.select((F.col("page_id") * 2).alias("record_id"), "url", (F.col("page_id") * 2).alias("captured"), F.lit(200).alias("status"), full.alias("headers"))
    later = F.col("page_id") * 2 + 1 + 2000 * (F.col("page_id") % 37)
    two = pages.select((F.col("page_id") * 2 + 1).alias("record_id"), "url", later.alias("captured"), F.lit(304).alias("status"), checked.alias("headers"))
    return one.unionByName(two)


ORACLE = r"""
WITH keyed AS (
  SELECT page_id, url, html, octet_length(encode(html)) AS bytes, md5(html) AS tag, 'day ' || (page_id % 1000) AS d,
    regexp_replace(regexp_replace(lower(regexp_extract(url, '^(?:[hH][tT][tT][pP][sS]?)://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$', 1)), ':(80|443)?$', ''), '^www\.', '')
    || regexp_replace(regexp_extract(url, '^(?:[hH][tT][tT][pP][sS]?)://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$', 2), '/+$', '') AS place,
    list_sort(list_filter(string_split(regexp_extract(url, '^(?:[hH][tT][tT][pP][sS]?)://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$', 3), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=.*)?$'))) AS q
  FROM pages),
p AS (SELECT page_id, bytes, tag, d, place || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url_key FROM keyed),
full_r AS (SELECT page_id * 2 AS record_id, page_id * 2 AS captured, url_key, bytes, tag, d FROM p),
again AS (SELECT page_id, page_id * 2 + 1 AS record_id, page_id * 2 + 1 + 2000 * (page_id % 37) AS captured, url_key, tag, d FROM p),
j AS (SELECT a.*, r.record_id AS response_id, r.tag AS rtag, r.d AS rd, r.bytes AS rbytes
  FROM again a ASOF LEFT JOIN full_r r ON a.url_key = r.url_key AND a.captured > r.captured)
SELECT record_id, url_key, captured, response_id,
  CASE WHEN response_id IS NULL THEN 'no_response' WHEN page_id % 5 <> 0 AND tag <> rtag THEN 'etag_differs'
       WHEN page_id % 5 = 0 AND d <> rd THEN 'date_differs' ELSE 'resolved' END AS outcome,
  CASE WHEN response_id IS NOT NULL AND ((page_id % 5 <> 0 AND tag = rtag) OR (page_id % 5 = 0 AND d = rd)) THEN
    'age: ' || (page_id % 7) || chr(10) || 'cache-control: max-age=600' || chr(10) || 'content-length: ' || rbytes || chr(10) || 'content-type: text/html'
    || chr(10) || 'etag: ' || CASE WHEN page_id % 2 = 0 AND page_id % 5 <> 0 THEN 'W/' ELSE '' END || '"' || rtag || '"' || chr(10) || 'last-modified: ' || rd END AS headers
FROM j
"""
