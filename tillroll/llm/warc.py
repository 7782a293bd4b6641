"""Resolve not-modified captures: a revisit takes its content from the latest earlier full response of its URL.

The as-of join runs over captures in the order of (canonical URL, date, id). Spark deals them out in ranges of this order, so that a URL with a third of all
captures spans many tasks. Within a range the last full response is carried forward; what a range must take over from
earlier ranges is looked up among one row per range and URL. Then validators are compared, and the headers of
the revisit that may replace stored ones are merged in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.runtime import cut

# Fixed lists: parameters that do not name content, and headers that a not-modified answer must not replace (RFC 9110, RFC 9111).
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|sessionid|phpsessid)(=|$)"
NOT_MERGED = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate",
    "proxy-authentication-info", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade",
)


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without a final slash, parameters in order without those that only
    track; no scheme, no fragment. Null if the URL is null or has no scheme and host."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(plain, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def lowered(headers: Column) -> Column:
    """Header names in lower case; of names that fall together the last in the order of entries counts."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    last = F.transform(names, lambda n: F.element_at(F.filter(entries, lambda e: e["key"] == n), -1)["value"])
    return F.coalesce(F.map_from_arrays(names, last), F.create_map().cast("map<string,string>"))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """Stored headers with those of the not-modified answer that may replace them."""
    allowed = F.map_filter(fresh, lambda k, v: ~k.isin(*NOT_MERGED))
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(allowed, k)), allowed)


def as_of(captures: DataFrame) -> DataFrame:
    """Add ``stored`` to captures (url, date, id, is_full, fact, ...): the fact of the latest earlier full capture of the URL."""
    order = ("url", "date", "id")
    ranged = cut(captures.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    before = Window.partitionBy("range", "url").orderBy("date", "id").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("near", F.last(F.when(F.col("is_full"), F.col("fact")), ignorenulls=True).over(before))
    latest = F.max_by(F.when(F.col("is_full"), F.col("fact")), F.when(F.col("is_full"), F.struct("date", "id")))
    ends = ranged.groupBy("range", "url").agg(latest.alias("fact"))
    earlier = Window.partitionBy("url").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("far", F.last("fact", ignorenulls=True).over(earlier)).where("far IS NOT NULL").select("range", "url", "far")
    return local.join(ends, ["range", "url"], "left").withColumn("stored", F.coalesce("near", "far")).drop("near", "far", "range")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """One row per revisit of ``captures`` (record_id, url, date, kind, status, headers, digest).

    ``kind`` is ``response`` or ``revisit``; a full response is a ``response`` of status 200. Returns record_id, canonical_url, resolved_id,
    outcome and headers. The outcome is ``resolved``; ``unchecked`` if there is no validator in common to compare;
    ``changed`` if entity tags (compared weakly), else modification dates, or payload digests differ; ``missing`` without an earlier full response. Only the
    first two have resolved_id and merged headers; the others keep their own headers.
    Nulls: a capture without a usable URL or date is not a response to anything and, as a revisit, is ``missing``; null headers are none; null digests are not
    compared. Of captures with equal dates the one with the smaller id is earlier. Repeated rows are answered each. Other columns are
    not read. Tables without revisits or without rows give no rows.
    """
    own = captures.select(
        F.col("record_id").alias("id"),
        canonical_url(F.col("url")).alias("url"),
        "date",
        F.coalesce((F.col("kind") == "response") & (F.col("status") == 200), F.lit(False)).alias("is_full"),
        F.coalesce(F.col("kind") == "revisit", F.lit(False)).alias("is_revisit"),
        lowered(F.col("headers")).alias("headers"),
        "digest",
    )
    fact = F.struct("id", "headers", "digest")
    usable = F.col("url").isNotNull() & F.col("date").isNotNull()
    placed = own.where(usable & (F.col("is_full") | F.col("is_revisit")))
    found = as_of(placed.withColumn("fact", F.when(F.col("is_full"), fact))).where("is_revisit").drop("fact")
    lost = own.where(~usable & F.col("is_revisit")).withColumn("stored", F.lit(None).cast(found.schema["stored"].dataType))
    rows = found.unionByName(lost.select(*found.columns))

    def pair(name: str) -> tuple[Column, Column]:
        return F.col("headers")[name], F.col("stored.headers")[name]

    tag, stored_tag = (F.regexp_replace(c, r"^W/", "") for c in pair("etag"))
    since, stored_since = pair("last-modified")
    tags, dates = tag.isNotNull() & stored_tag.isNotNull(), since.isNotNull() & stored_since.isNotNull()
    digests = F.col("digest").isNotNull() & F.col("stored.digest").isNotNull()
    changed = F.when(tags, tag != stored_tag).when(dates, since != stored_since).otherwise(False) | (
        F.when(digests, F.col("digest") != F.col("stored.digest")).otherwise(False)
    )
    outcome = (
        F.when(F.col("stored").isNull(), "missing").when(changed, "changed").when(tags | dates | digests, "resolved").otherwise("unchecked")
    )
    good = F.col("outcome").isin("resolved", "unchecked")
    return rows.withColumn("outcome", outcome).select(
        F.col("id").alias("record_id"),
        F.col("url").alias("canonical_url"),
        F.when(good, F.col("stored.id")).alias("resolved_id"),
        "outcome",
        F.when(good, merged_headers(F.col("stored.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"),
    )


def page_captures(pages: DataFrame) -> DataFrame:
    """Captures of ``pages``: every page as a full response, and a later not-modified answer for its URL.

    A page is fetched ten seconds after the one before. Its URL is asked for again after up to two thousand pages, with the page's entity tag
    (every seventh without it, with the date only); every eleventh page is asked for before it was first fetched.
    """
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    page = F.col("page_id")
    wait = F.when(page % 11 == 0, -1).otherwise(page * 7919 % 2000)
    tag = F.concat(F.lit('W/"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 12), F.lit('"'))
    date = start + F.make_dt_interval(secs=(page * 10).cast("decimal(18,6)"))
    again = start + F.make_dt_interval(secs=(page * 10 + 5 + wait * 10).cast("decimal(18,6)"))
    modified = F.concat(F.lit("day "), (page % 3).cast("string"))
    text = F.lit("text/html")
    full = F.create_map(
        F.lit("Content-Type"), text, F.lit("Content-Length"), F.length(F.coalesce("html", F.lit(""))).cast("string"),
        F.lit("ETag"), tag, F.lit("Last-Modified"), modified, F.lit("Cache-Control"), F.lit("max-age=60"),
    )
    short = F.create_map(F.lit("content-length"), F.lit("0"), F.lit("last-modified"), modified, F.lit("cache-control"), F.lit("max-age=600"))
    tagged = F.map_concat(short, F.create_map(F.lit("etag"), F.regexp_replace(tag, "^W/", "")))
    nothing = F.lit(None).cast("string")
    first = pages.select(
        (page * 2).alias("record_id"), "url", date.alias("date"), F.lit("response").alias("kind"), F.lit(200).alias("status"),
        full.alias("headers"), nothing.alias("digest"),
    )
    second = pages.select(
        (page * 2 + 1).alias("record_id"), "url", again.alias("date"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
        F.when(page % 7 == 0, short).otherwise(tagged).alias("headers"), nothing.alias("digest"),
    )
    return first.unionByName(second)


ORACLE = r"""
WITH plain AS (SELECT page_id, coalesce(html, '') AS html, regexp_replace(trim(url), '#.*$', '') AS u FROM pages),
    parts AS (SELECT page_id, html,
        regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^www\.|:(80|443)$', '', 'g') AS host,
        regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '') AS path,
        list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'),
            lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(utm_[^=]*|ref|fbclid|gclid|sessionid|phpsessid)(=|$)'))) AS kept
        FROM plain),
    named AS (SELECT page_id, html, substr(md5(html), 1, 12) AS tag, 'day ' || (page_id % 3) AS modified,
        CASE WHEN host <> '' THEN host || path || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS curl
        FROM parts),
    asked AS (SELECT *, page_id * 10 + 5 + 10 * CASE WHEN page_id % 11 = 0 THEN -1 ELSE page_id * 7919 % 2000 END AS s FROM named),
    met AS (SELECT a.page_id, a.curl, a.tag, a.modified, b.page_id AS other, b.tag AS other_tag, b.modified AS other_modified,
            length(b.html) AS size, row_number() OVER (PARTITION BY a.page_id ORDER BY b.page_id DESC) AS n
        FROM asked AS a LEFT JOIN named AS b ON a.curl = b.curl AND b.page_id * 10 < a.s),
    judged AS (SELECT *, CASE WHEN other IS NULL THEN 'missing'
            WHEN page_id % 7 <> 0 THEN CASE WHEN tag = other_tag THEN 'resolved' ELSE 'changed' END
            WHEN modified = other_modified THEN 'resolved' ELSE 'changed' END AS outcome
        FROM met WHERE n = 1)
SELECT page_id * 2 + 1 AS record_id, curl AS canonical_url,
    CASE WHEN outcome = 'resolved' THEN other * 2 END AS resolved_id, outcome,
    CASE WHEN outcome = 'resolved' THEN 'cache-control=max-age=600;content-length=' || size || ';content-type=text/html;etag='
            || CASE WHEN page_id % 7 = 0 THEN 'W/"' || other_tag || '"' ELSE '"' || tag || '"' END || ';last-modified=' || modified
        ELSE 'cache-control=max-age=600;content-length=0;' || CASE WHEN page_id % 7 = 0 THEN '' ELSE 'etag="' || tag || '";' END
            || 'last-modified=' || modified END AS headers
FROM judged
"""
