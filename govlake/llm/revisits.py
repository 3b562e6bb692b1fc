"""WARC (10): not-modified revisits resolved to the response they repeat.

A revisit record (HTTP 304, no body) is resolved by an as-of join: the latest
earlier full response (status 200) of the same canonical URL. A capture at the
revisit's own time counts as earlier if its record id is smaller. The revisit's
validators are checked against that response: an ETag that both have must be
equal (weak comparison); with no ETag on both sides, a Last-Modified that both
have must be equal; with neither the link is accepted as unverified. Headers
are then merged: those of the stored response, replaced by the fields that a
304 may update (Cache-Control, Content-Location, Date, ETag, Expires,
Last-Modified, Vary); other fields of the revisit, such as Content-Length or
Set-Cookie, are dropped.

The as-of join keeps a hot URL parallel: captures are cut into slices of time,
a window runs within (URL, slice), and the last response of earlier slices is
carried over in a table of one row per URL and slice.

Canonical URLs: lower-case scheme and host, http as https, no default port, no
leading ``www.`` or ``m.``, no fragment, no tracking parameters (``utm_*``,
``gclid``, ``fbclid``), the other parameters sorted, no trailing slash.

A null URL has no canonical form and resolves to nothing; a null time sorts
before all. Null headers are no headers. Repeated rows resolve alike. Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from govlake.llm.common import pick, stored, table

#: Fields a 304 may update; fixed by the HTTP standard.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Captures of one time slice of a URL; a task window holds one slice.
SLICE_SECONDS = 30 * 86400


def canonical_url(url: Column) -> Column:
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    rest = F.regexp_replace(u, "^(?i:https?)://", "")
    host = F.lower(F.regexp_extract(rest, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), "^(www|m)\\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(rest, "\\?(.*)$", 1)
    params = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.regexp_like(p, F.lit("^(utm_[^=]*|gclid|fbclid)(=|$)"))))
    return F.concat(F.lit("https://"), host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(""))


def strong(etag: Column) -> Column:
    """An ETag for weak comparison."""
    return F.regexp_replace(F.trim(etag), "^W/", "")


def lowered(headers: Column) -> Column:
    """Field names in lower case; of names that then clash the one that sorts last wins."""
    entries = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    named = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(named, lambda e, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda x: x["key"] == e["key"]))
    return F.map_from_entries(last)


def merged(stored_headers: Column, fresh: Column) -> Column:
    updates = F.map_filter(fresh, lambda k, v: k.isin(*PERMITTED))
    return F.map_concat(F.map_filter(stored_headers, lambda k, v: ~F.map_contains_key(updates, k)), updates)


def resolve_revisits(captures: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Per 304 capture: the response it repeats, the verdict and the merged headers.

    ``captures``: capture_id long, url string, time timestamp, status int,
    headers map<string,string>, payload_sha256 string.
    """
    names = ("capture_id", "url", "time", "status", "headers", "payload_sha256")
    rows = pick(captures, **{n: n for n in names}).where(F.col("status").isin(200, 304))
    second = F.coalesce(F.unix_seconds("time"), F.lit(-(1 << 62)))
    rows = rows.select(
        "capture_id", "status", "payload_sha256", "time",
        canonical_url(F.col("url")).alias("canonical"), lowered(F.col("headers")).alias("headers"),
        second.alias("second"), F.floor(second / slice_seconds).alias("slice"),
    )
    rows = stored(rows, "captures")
    order = F.struct(F.coalesce(F.unix_micros("time"), F.lit(-(1 << 62))).alias("micros"), F.col("capture_id"))
    response = F.when((F.col("status") == 200), F.struct(order.alias("at"), "capture_id", "payload_sha256", "headers"))
    rows = rows.withColumn("at", order).withColumn("response", response)

    # the last response of a slice, carried to the later slices of the URL
    per_slice = rows.groupBy("canonical", "slice").agg(F.max_by("response", F.when(F.col("status") == 200, F.col("at"))).alias("response"))
    earlier = W.partitionBy("canonical").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    carried = stored(
        per_slice.where("canonical IS NOT NULL").select("canonical", "slice", F.last("response", ignorenulls=True).over(earlier).alias("carried")),
        "carried",
    )
    within = W.partitionBy("canonical", "slice").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    latest = (
        rows.where("canonical IS NOT NULL").withColumn("near", F.last("response", ignorenulls=True).over(within)).where("status = 304")
        .join(carried, ["canonical", "slice"], "left")
        .withColumn("found", F.coalesce("near", "carried"))
        .unionByName(rows.where("canonical IS NULL AND status = 304").withColumns({c: F.lit(None).cast(rows.schema["response"].dataType) for c in ("near", "carried", "found")}))
    )
    old, new = F.col("found.headers"), F.col("headers")
    both = lambda k: F.map_contains_key(old, F.lit(k)) & F.map_contains_key(new, F.lit(k))
    verdict = (
        F.when(F.col("found").isNull(), "unresolved")
        .when(both("etag"), F.when(strong(old["etag"]) == strong(new["etag"]), "etag").otherwise("mismatch"))
        .when(both("last-modified"), F.when(old["last-modified"] == new["last-modified"], "last-modified").otherwise("mismatch"))
        .otherwise("unverified")
    )
    good = F.col("verdict").isin("etag", "last-modified", "unverified")
    return latest.withColumn("verdict", F.coalesce(verdict, F.lit("mismatch"))).select(
        "capture_id", "canonical", "time", "verdict",
        F.col("found.capture_id").alias("candidate_id"),
        F.when(good, F.col("found.capture_id")).alias("resolved_id"),
        F.when(good, F.col("found.payload_sha256")).alias("payload_sha256"),
        F.when(good, merged(old, new)).alias("headers"),
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl over ``pages``: each page is fetched in full, and asked for again twice.

    Page p is fetched at hour p. The first revisit, 90 hours later, sends the
    page's own validators through another form of its URL; the second, a year
    later, has an ETag that is outdated for every seventh page, only a date for
    every fifth and no validators for every eleventh. Later pages with the same
    canonical URL stand between them.
    """
    base = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).select(
        "page_id", "url", F.md5("html").alias("tag"), F.sha2("html", 256).alias("sha"), F.octet_length("html").cast("string").alias("size")
    )
    text = lambda c: c.cast("string")
    day = F.concat(F.lit("day "), text(F.floor(F.col("page_id") / 24)))
    one = base.select(
        (F.col("page_id") * 4).alias("capture_id"), "url", F.col("page_id").alias("hour"), F.lit(200).alias("status"),
        F.create_map(
            F.lit("ETag"), F.concat(F.lit('"'), "tag", F.lit('"')), F.lit("Last-Modified"), day, F.lit("Content-Type"), F.lit("text/html"),
            F.lit("Content-Length"), F.col("size"), F.lit("Cache-Control"), F.lit("max-age=60"),
        ).alias("headers"),
        F.col("sha").alias("payload_sha256"),
    )
    two = base.select(
        (F.col("page_id") * 4 + 1).alias("capture_id"),
        F.concat(F.regexp_replace("url", "^https?://(www\\.|m\\.)?", "HTTP://WWW."), F.when(F.col("url").contains("?"), "&utm_id=7").otherwise("?utm_id=7"), F.lit("#top")).alias("url"),
        (F.col("page_id") + 90).alias("hour"), F.lit(304).alias("status"),
        F.create_map(F.lit("etag"), F.concat(F.lit('W/"'), "tag", F.lit('"')), F.lit("Date"), day, F.lit("Cache-Control"), F.lit("max-age=600"), F.lit("Set-Cookie"), F.lit("a=b")).alias("headers"),
        F.lit(None).cast("string").alias("payload_sha256"),
    )
    p = F.col("page_id")
    three = base.select(
        (p * 4 + 2).alias("capture_id"), "url", (p + 8760).alias("hour"), F.lit(304).alias("status"),
        F.when(p % 11 == 0, F.create_map(F.lit("Vary"), F.lit("Accept")))
        .when(p % 5 == 0, F.create_map(F.lit("Last-Modified"), day))
        .otherwise(F.create_map(F.lit("ETag"), F.concat(F.lit('"'), F.when(p % 7 == 0, "old").otherwise(F.col("tag")), F.lit('"')), F.lit("Expires"), day)).alias("headers"),
        F.lit(None).cast("string").alias("payload_sha256"),
    )
    return one.unionByName(two).unionByName(three).withColumn("time", F.timestamp_seconds(F.lit(1_600_000_000) + F.col("hour") * 3600)).drop("hour")


def op10_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All revisits of the crawl over ``pages``; merged headers as sorted ``name: value`` lines."""
    found = resolve_revisits(captures_of(table(spark, sf_dir, "pages")))
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws(": ", e["key"], e["value"])))
    return found.withColumn("headers", F.array_join(lines, "\n"))


SQL = r"""
WITH base AS (
  SELECT page_id AS p, url, md5(coalesce(html, '')) AS tag, sha256(coalesce(html, '')) AS sha,
         strlen(coalesce(html, ''))::VARCHAR AS size, 'day ' || (page_id // 24)::VARCHAR AS day
  FROM pages
), cap AS (
  SELECT p * 4 AS capture_id, url, p AS hour, 200 AS status, '"' || tag || '"' AS etag, day AS modified,
         size, 'max-age=60' AS cache, NULL AS date, NULL AS vary, NULL AS expires, sha FROM base
  UNION ALL
  SELECT p * 4 + 1, regexp_replace(url, '^https?://(www\.|m\.)?', 'HTTP://WWW.') || CASE WHEN contains(url, '?') THEN '&utm_id=7' ELSE '?utm_id=7' END || '#top',
         p + 90, 304, 'W/"' || tag || '"', NULL, NULL, 'max-age=600', day, NULL, NULL, NULL FROM base
  UNION ALL
  SELECT p * 4 + 2, url, p + 8760, 304,
         CASE WHEN p % 11 = 0 OR p % 5 = 0 THEN NULL WHEN p % 7 = 0 THEN '"old"' ELSE '"' || tag || '"' END,
         CASE WHEN p % 11 <> 0 AND p % 5 = 0 THEN day END, NULL, NULL, NULL, CASE WHEN p % 11 = 0 THEN 'Accept' END,
         CASE WHEN p % 11 <> 0 AND p % 5 <> 0 THEN day END, NULL FROM base
), parts AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^(?i:https?)://', '') AS rest FROM cap
), named AS (
  SELECT *, 'https://'
    || regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), ':(80|443)$', ''), '^(www|m)\.', '')
    || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS canonical
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
               lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|gclid|fbclid)(=|$)'))) AS q FROM parts)
), seen AS (
  SELECT *, last_value(CASE WHEN status = 200 THEN struct_pack(id := capture_id, etag := etag, modified := modified, size := size, sha := sha) END IGNORE NULLS)
              OVER (PARTITION BY canonical ORDER BY hour, capture_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r
  FROM named
), judged AS (
  SELECT *, CASE WHEN canonical IS NULL OR r IS NULL THEN 'unresolved'
                 WHEN etag IS NOT NULL THEN CASE WHEN replace(etag, 'W/', '') = r.etag THEN 'etag' ELSE 'mismatch' END
                 WHEN modified IS NOT NULL THEN CASE WHEN modified = r.modified THEN 'last-modified' ELSE 'mismatch' END
                 ELSE 'unverified' END AS verdict
  FROM seen WHERE status = 304
)
SELECT capture_id, canonical, to_timestamp(1600000000 + hour * 3600)::TIMESTAMP AS time, verdict, CASE WHEN canonical IS NOT NULL THEN r.id END AS candidate_id,
       CASE WHEN verdict NOT IN ('unresolved', 'mismatch') THEN r.id END AS resolved_id,
       CASE WHEN verdict NOT IN ('unresolved', 'mismatch') THEN r.sha END AS payload_sha256,
       CASE WHEN verdict NOT IN ('unresolved', 'mismatch') THEN concat_ws(chr(10),
         'cache-control: ' || coalesce(cache, 'max-age=60'), 'content-length: ' || r.size, 'content-type: text/html', 'date: ' || date,
         'etag: ' || coalesce(etag, r.etag), 'expires: ' || expires, 'last-modified: ' || coalesce(modified, r.modified), 'vary: ' || vary) END AS headers
FROM judged
"""
