"""Resolving not-modified revisits of a web archive.

A revisit record says that a server answered "not modified": its body is that
of the latest earlier full response of the same canonical URL.  The join is
as-of; afterwards the validators are compared and the headers that a
not-modified answer may carry replace those of the full response.

One URL may hold a large part of all records.  Distinct (URL, time) pairs are
matched in time buckets: within a bucket by a window, across buckets by each
bucket's last response, so no task sees a URL's whole history.

Defined cases
* null or empty URL, or null time: nothing matches, status ``no_prior``;
* two responses at the same time: the one with the greater record id counts;
* a response at the time of the revisit is not earlier;
* validators: the entity tags decide where the revisit has one (a weak tag equals the strong one),
  else the modification dates; a revisit with neither is accepted;
* null record ids of revisits are carried; long URLs and headers are taken whole;
* null headers count as none; repeated revisits are resolved each; empty tables give no rows;
* extra columns are not carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers that a not-modified answer may replace (fixed values).
PERMITTED = ("age", "cache-control", "date", "etag", "expires", "last-modified", "vary")
#: Width of a time bucket, in seconds.
BUCKET_S = 86_400


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``, default port, fragment and closing slash dropped; host in lower case; query parameters sorted."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    bare = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, "^([^/?]*)", 1)), "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, "[?](.*)$", 1)
    out = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), F.array_join(F.array_sort(F.split(query, "&")), "&"))).otherwise(F.lit("")))
    return F.when(out != "", out)


def _tag(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), '^W/', "")


def latest_before(keys: DataFrame, responses: DataFrame, bucket_s: int = BUCKET_S) -> DataFrame:
    """As-of join: ``url, ts, response`` for each distinct (url, ts), the struct of the last earlier response.

    ``responses`` has ``url, ts, response``.
    """
    bucket = F.floor(F.col("ts") / bucket_s).alias("bucket")
    one = responses.groupBy("url", "ts").agg(F.max_by("response", "response.record_id").alias("response"))
    asked = keys.select("url", "ts").distinct()
    kind = responses.schema["response"].dataType
    events = one.select("url", bucket, "ts", "response").unionByName(
        asked.select("url", bucket, "ts", F.lit(None).cast(kind).alias("response"), F.lit(True).alias("asked")), allowMissingColumns=True
    )
    carried = events.groupBy("url", "bucket").agg(F.max_by(F.col("response"), F.when(F.col("response").isNotNull(), F.col("ts"))).alias("last"))
    earlier = Window.partitionBy("url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = carried.select("url", "bucket", F.last("last", ignorenulls=True).over(earlier).alias("before"))
    inside = Window.partitionBy("url", "bucket").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    within = events.select("url", "bucket", "ts", "asked", F.last("response", ignorenulls=True).over(inside).alias("within")).filter("asked")
    return within.join(carried, ["url", "bucket"]).select("url", "ts", F.coalesce("within", "before").alias("response"))


def resolve(revisits: DataFrame, responses: DataFrame, bucket_s: int = BUCKET_S) -> DataFrame:
    """Every revisit with the response it repeats.

    Both frames have ``record_id, url, ts`` (seconds) ``, etag, last_modified,
    headers`` (a map with names in lower case); responses have ``payload_digest``.

    Result: ``record_id, url_key, status`` (``resolved``, ``validator_mismatch``
    or ``no_prior``) ``, response_id, payload_digest, headers`` (merged; of a
    revisit that is not resolved its own).
    """
    full = responses.select(
        canonical_url(F.col("url")).alias("url"), "ts",
        F.struct("record_id", "etag", "last_modified", "headers", "payload_digest").alias("response"),
    ).filter("url IS NOT NULL AND ts IS NOT NULL")
    asked = revisits.select(
        F.col("record_id"), canonical_url(F.col("url")).alias("url"), "ts", "etag", "last_modified",
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"),
    )
    found = latest_before(asked.filter("url IS NOT NULL AND ts IS NOT NULL"), full, bucket_s)
    same = (
        F.when(F.col("etag").isNotNull(), F.coalesce(_tag(F.col("etag")) == _tag(F.col("response.etag")), F.lit(False)))
        .when(F.col("last_modified").isNotNull(), F.coalesce(F.col("last_modified") == F.col("response.last_modified"), F.lit(False)))
        .otherwise(F.lit(True))
    )
    status = F.when(F.col("response").isNull(), "no_prior").when(same, "resolved").otherwise("validator_mismatch")
    replaced = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    theirs = F.coalesce(F.col("response.headers"), F.create_map().cast("map<string,string>"))
    merged = F.map_concat(F.map_filter(theirs, lambda k, _: ~F.map_contains_key(replaced, k)), replaced)
    return asked.join(found, ["url", "ts"], "left").withColumn("status", status).select(
        "record_id", F.col("url").alias("url_key"), "status",
        F.when(F.col("status") == "resolved", F.col("response.record_id")).alias("response_id"),
        F.when(F.col("status") == "resolved", F.col("response.payload_digest")).alias("payload_digest"),
        F.when(F.col("status") == "resolved", merged).otherwise(F.col("headers")).alias("headers"),
    )


#: How ``captures`` derives records of a page: suffix of the record id, seconds after the page's first capture,
#: text added to the body, and the validator that a revisit sends.
FIRST_CAPTURE = 1_700_000_000
PAGE_STEP_S = 600
RESPONSES = ((0, 0, ""), (1, 172_800, "2"))
REVISITS = ((2, 3_600, "weak"), (3, 259_200, "tag"), (4, -60, "tag"), (5, 200_000, "date"))


def captures(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Revisits and responses derived from the table of pages, which has no capture times of its own.

    Every page gets a full response, every other one a second with a changed
    body; four revisits follow, one of them before any response.
    """
    ts = (F.lit(FIRST_CAPTURE) + F.col("page_id") * PAGE_STEP_S).cast("long")

    def tag(added: str) -> Column:
        return F.concat(F.lit('"'), F.md5(F.concat("html", F.lit(added)).cast("binary")), F.lit('"'))

    def record(suffix: int, shift: int) -> list[Column]:
        return [(F.col("page_id") * 10 + suffix).alias("record_id"), "url", (ts + shift).alias("ts")]

    responses = None
    for suffix, shift, added in RESPONSES:
        when = (ts + shift).cast("string")
        one = pages.filter(F.lit(True) if not suffix else F.col("page_id") % 2 == 0).select(
            *record(suffix, shift), tag(added).alias("etag"), when.alias("last_modified"),
            F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("date"), when, F.lit("server"), F.lit("origin")).alias("headers"),
            F.sha2(F.concat("html", F.lit(added)).cast("binary"), 256).alias("payload_digest"),
        )
        responses = one if responses is None else responses.unionByName(one)
    revisits = None
    for suffix, shift, kind in REVISITS:
        etag = F.lit(None).cast("string") if kind == "date" else F.concat(F.lit("W/" if kind == "weak" else ""), tag(""))
        one = pages.select(
            (F.col("page_id") * 10 + suffix).alias("record_id"),
            F.concat(F.regexp_replace("url", "^http://(www[.])?", "HTTPS://www."), F.lit("#again")).alias("url"), (ts + shift).alias("ts"),
            etag.alias("etag"), (ts.cast("string") if kind == "date" else F.lit(None).cast("string")).alias("last_modified"),
            F.create_map(F.lit("date"), (ts + shift).cast("string"), F.lit("content-length"), F.lit("0"), F.lit("age"), F.lit("1")).alias("headers"),
        )
        revisits = one if revisits is None else revisits.unionByName(one)
    return revisits, responses


def header_text(headers: Column) -> Column:
    """Headers as sorted lines."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")


def _url_sql(url: str) -> str:
    return f"""(SELECT CASE WHEN u <> '' THEN u END FROM (SELECT
      regexp_replace(regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), '^www[.]', ''), ':(80|443)$', '')
      || regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '')
      || CASE WHEN regexp_extract(b, '[?](.*)$', 1) <> ''
              THEN '?' || array_to_string(list_sort(string_split(regexp_extract(b, '[?](.*)$', 1), '&')), '&') ELSE '' END AS u
      FROM (SELECT regexp_replace(regexp_replace(trim({url}, ' '), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b)))"""


#: DuckDB SQL for ``resolve(*captures(pages))`` with ``header_text``.
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, url, html, 1700000000 + page_id * 600 AS t FROM pages),
resp AS (
  SELECT page_id * 10 AS id, {_url_sql('url')} AS k, t AS ts, '"' || md5(html) || '"' AS etag, t::VARCHAR AS lm, sha256(html) AS digest FROM p
  UNION ALL
  SELECT page_id * 10 + 1, {_url_sql('url')}, t + 172800, '"' || md5(html || '2') || '"', (t + 172800)::VARCHAR, sha256(html || '2') FROM p WHERE page_id % 2 = 0
), one AS (
  SELECT * FROM resp QUALIFY row_number() OVER (PARTITION BY k, ts ORDER BY id DESC) = 1
), rev AS (
  SELECT page_id * 10 + s AS id, {_url_sql("url")} AS k, t + d AS ts,
         CASE WHEN s = 5 THEN NULL ELSE '"' || md5(html) || '"' END AS etag, CASE WHEN s = 5 THEN t::VARCHAR END AS lm
  FROM p, (VALUES (2, 3600), (3, 259200), (4, -60), (5, 200000)) AS v(s, d)
), j AS (
  SELECT rev.*, one.id AS rid, one.digest, one.ts AS rts,
         CASE WHEN one.id IS NULL THEN 'no_prior'
              WHEN coalesce(CASE WHEN rev.etag IS NOT NULL THEN rev.etag = one.etag ELSE rev.lm = one.lm END, FALSE) THEN 'resolved'
              ELSE 'validator_mismatch' END AS status
  FROM rev ASOF LEFT JOIN one ON rev.k = one.k AND rev.ts > one.ts
)
SELECT id AS record_id, k AS url_key, status, CASE WHEN status = 'resolved' THEN rid END AS response_id,
       CASE WHEN status = 'resolved' THEN digest END AS payload_digest,
       CASE WHEN status = 'resolved' THEN 'age: 1' || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || ts || chr(10) || 'server: origin'
            ELSE 'age: 1' || chr(10) || 'content-length: 0' || chr(10) || 'date: ' || ts END AS headers
FROM j
"""
