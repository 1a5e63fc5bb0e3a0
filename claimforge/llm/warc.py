"""WARC: not-modified revisits resolved to the full responses they refer to. DataFrame functions only.

A revisit record of a not-modified answer (304) has no payload. It refers to the latest earlier full response
of the same canonical URL, if the validators agree; the answer's permitted headers then replace the stored ones.
Revisits of another status (those that found an identical payload) name their own response and are not resolved
here; their outcome says so.

As-of join: time is cut into chunks. Within (URL, chunk) a window carries the latest full response forward; for
revisits with none earlier in their chunk, the last response of each (URL, chunk) is carried over chunks and
joined. So no window holds more than the captures of one URL in one chunk, or one row for each chunk of a URL,
however often a URL was captured; payloads take no part.

Validators: equal entity tags (weak comparison) agree; where either side has none, equal modification dates
agree; anything else does not. A null URL or time never resolves. Records with equal times are ordered by
record id. Repeated rows give repeated results. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Headers that a 304 answer may renew.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that don't name another resource.
TRACKING = r"(utm_[a-z]+|ref|fbclid|gclid|sessionid)"
CHUNK_SECONDS = 86_400

#: Records: record_id long, kind ('response' or 'revisit'), status int, url, ts long (seconds), headers map<string,string> with lower-case names, digest (of the payload; null in revisits).
COLUMNS = ("record_id", "kind", "status", "url", "ts", "headers", "digest")


def canonical(url: Column) -> Column:
    """No scheme, fragment, default port, www. or tracking parameters; host in lower case; parameters sorted; no final slash."""
    bare = F.regexp_replace(F.trim(url), r"(?s)#.*$", "")
    rest = F.regexp_replace(bare, r"(?i)^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1)), r":(80|443)$", "")
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"(?s)\?(.*)$", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(f"^{TRACKING}="))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def tag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], "^W/", "")


def agree(asked: Column, stored: Column) -> Column:
    """Whether the validators of a 304's headers and of a stored response agree."""
    both = tag(asked).isNotNull() & tag(stored).isNotNull()
    return F.coalesce(F.when(both, tag(asked) == tag(stored)).otherwise(asked["last-modified"] == stored["last-modified"]), F.lit(False))


def merged(stored: Column, asked: Column, permitted: tuple[str, ...]) -> Column:
    """The stored headers, renewed by the permitted ones of the answer."""
    new = F.map_filter(asked, lambda k, v: k.isin(*permitted) & v.isNotNull())
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(new), k)), new)


def resolve(records: DataFrame, permitted: tuple[str, ...] = PERMITTED, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """One row per revisit: record_id, canonical_url, ts, refers_to, refers_ts, outcome (resolved, no_response, validators_differ, not_304), digest, headers."""
    rows = records.select(*COLUMNS)
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    held = F.struct(F.col("ts").alias("ts"), F.col("record_id").alias("record_id"), F.col("headers").alias("headers"), F.col("digest").alias("digest"))
    rows = rows.select("record_id", "kind", "status", "ts", "headers", canonical(F.col("url")).alias("canonical_url"), F.floor(F.col("ts") / chunk_seconds).alias("chunk"), F.when(full, held).alias("full"))
    rows = rows.filter("full is not null or kind = 'revisit'")
    # rows without URL or time match nothing: they keep out of the windows
    whole = rows.filter("canonical_url is not null and ts is not null")
    broken = rows.filter("(canonical_url is null or ts is null) and kind = 'revisit'").withColumn("found", F.lit(None).cast(rows.schema["full"].dataType))
    before = W.partitionBy("canonical_url", "chunk").orderBy("ts", "record_id").rowsBetween(W.unboundedPreceding, -1)
    near = whole.withColumn("found", F.last("full", ignorenulls=True).over(before)).filter("kind = 'revisit'")
    # the last response of a chunk: only times and ids are compared, so headers may be a map
    key = F.when(F.col("full").isNotNull(), F.struct("ts", "record_id"))
    last = whole.groupBy("canonical_url", "chunk").agg(F.max_by("full", key).alias("last"))
    over = W.partitionBy("canonical_url").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = last.select("canonical_url", "chunk", F.last("last", ignorenulls=True).over(over).alias("carried")).filter("carried is not null")
    found = near.join(carried, ["canonical_url", "chunk"], "left").withColumn("found", F.coalesce("found", "carried")).drop("carried")
    found = found.unionByName(broken)
    asked = F.coalesce(F.col("status") == 304, F.lit(False))
    ok = asked & F.col("found").isNotNull() & agree(F.col("headers"), F.col("found.headers"))
    return found.select(
        "record_id", "canonical_url", "ts",
        F.when(ok, F.col("found.record_id")).alias("refers_to"),
        F.when(ok, F.col("found.ts")).alias("refers_ts"),
        F.when(ok, "resolved").when(~asked, "not_304").when(F.col("found").isNull(), "no_response").otherwise("validators_differ").alias("outcome"),
        F.when(ok, F.col("found.digest")).alias("digest"),
        F.when(ok, merged(F.col("found.headers"), F.coalesce("headers", F.create_map().cast("map<string,string>")), permitted)).otherwise(F.col("headers")).alias("headers"),
    )


def with_payload(resolved: DataFrame, payloads: DataFrame) -> DataFrame:
    """The resolved revisits with the payload of (record_id, payload) rows they refer to."""
    own = payloads.select(F.col("record_id").alias("refers_to"), "payload")
    return resolved.join(own, "refers_to", "left")


def captures(pages: DataFrame) -> DataFrame:
    """Records made from ``pages``: a full response of each page, and a revisit some days later.

    By page_id, every fourth revisit carries a modification date only, every fifth a stale entity tag, every
    seventh comes before the page's own response, and every eleventh is one of an identical payload (status 200).
    """
    rows = pages.select(pages["page_id"].cast("long").alias("p"), pages["url"].cast("string").alias("url"), F.md5(F.coalesce(pages["html"], F.lit(""))).alias("digest"))
    at = F.col("p") * 600
    date = lambda t: t.cast("string")
    etag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))
    response = rows.select(
        (F.col("p") * 2).alias("record_id"), F.lit("response").alias("kind"), F.lit(200).alias("status"), "url", at.alias("ts"),
        F.create_map(F.lit("etag"), etag, F.lit("last-modified"), date(at - 3600), F.lit("date"), date(at), F.lit("content-type"), F.lit("text/html"), F.lit("cache-control"), F.lit("max-age=60")).alias("headers"), "digest",
    )
    later = F.when(F.col("p") % 7 == 6, at - 300).otherwise(at + 86_400 * (1 + F.col("p") % 5))
    stale = F.when(F.col("p") % 5 == 4, F.lit('W/"stale"')).otherwise(F.concat(F.lit("W/"), etag))
    tagged = F.create_map(F.lit("etag"), stale, F.lit("date"), date(later), F.lit("expires"), date(later + 60), F.lit("content-type"), F.lit("ignored"))
    dated = F.create_map(F.lit("last-modified"), date(at - 3600), F.lit("date"), date(later))
    revisit = rows.select(
        (F.col("p") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), F.when(F.col("p") % 11 == 10, 200).otherwise(304).alias("status"), "url", later.alias("ts"),
        F.when(F.col("p") % 4 == 3, dated).otherwise(tagged).alias("headers"), F.lit(None).cast("string").alias("digest"),
    )
    return response.unionByName(revisit)


def digest(resolved: DataFrame) -> DataFrame:
    """The result with its headers as text, sorted by name."""
    text = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws("=", e.key, e.value)), ";")
    return resolved.withColumn("headers", text)


ORACLE_SQL = rf"""
WITH r AS (SELECT page_id AS p, url, md5(coalesce(html, '')) AS digest, page_id * 600 AS t0 FROM pages),
c AS (
SELECT p * 2 AS record_id, 'response' AS kind, 200 AS status, url, t0 AS ts, '"' || substr(digest, 1, 16) || '"' AS etag, (t0 - 3600)::VARCHAR AS modified, t0::VARCHAR AS date, NULL AS expires, digest FROM r
UNION ALL
SELECT p * 2 + 1, 'revisit', CASE WHEN p % 11 = 10 THEN 200 ELSE 304 END, url, later, CASE WHEN p % 4 = 3 THEN NULL WHEN p % 5 = 4 THEN 'W/"stale"' ELSE 'W/"' || substr(digest, 1, 16) || '"' END, CASE WHEN p % 4 = 3 THEN (t0 - 3600)::VARCHAR END, later::VARCHAR, CASE WHEN p % 4 = 3 THEN NULL ELSE (later + 60)::VARCHAR END, NULL
FROM (SELECT *, CASE WHEN p % 7 = 6 THEN t0 - 300 ELSE t0 + 86400 * (1 + p % 5) END AS later FROM r)),
s AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM c),
h AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '') || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS page,
array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^{TRACKING}='))), '&') AS query FROM s),
u AS (SELECT *, page || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canonical_url FROM h),
f AS (SELECT *, last_value(CASE WHEN kind = 'response' THEN {{'id': record_id, 'ts': ts, 'etag': etag, 'modified': modified, 'date': date, 'digest': digest}} END IGNORE NULLS)
OVER (PARTITION BY canonical_url ORDER BY ts, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS x FROM u),
v AS (SELECT *, status = 304 AND x IS NOT NULL AND CASE WHEN etag IS NULL THEN coalesce(modified = x.modified, false) ELSE regexp_replace(etag, '^W/', '') = x.etag END AS ok FROM f WHERE kind = 'revisit')
SELECT record_id, canonical_url, ts, CASE WHEN ok THEN x.id END AS refers_to, CASE WHEN ok THEN x.ts END AS refers_ts,
CASE WHEN ok THEN 'resolved' WHEN status <> 304 THEN 'not_304' WHEN x IS NULL THEN 'no_response' ELSE 'validators_differ' END AS outcome, CASE WHEN ok THEN x.digest END AS digest,
CASE WHEN ok THEN 'cache-control=max-age=60;content-type=text/html;date=' || date || ';etag=' || coalesce(etag, x.etag) || coalesce(';expires=' || expires, '') || ';last-modified=' || coalesce(modified, x.modified)
ELSE coalesce('content-type=ignored;date=' || date || ';etag=' || etag || ';expires=' || expires, 'date=' || date || ';last-modified=' || modified) END AS headers
FROM v
"""
