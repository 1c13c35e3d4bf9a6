"""WARC: resolution of revisit records whose server said "not modified".

Such a record has no payload. It is joined as of its time, by canonical url, to the latest earlier full response; if
its validators agree with the response's (entity tags by weak comparison, else the dates of the last change), the
two make one resolved record: the response's payload, and its headers with those of the revisit that a "not modified"
answer may update.

The as-of join has levels, so that a url with any share of all records gathers in no task: records are dealt by url and
stretch of time (a day, a minute on days on which the url has HOT records or more, a second in minutes that have as many),
each stretch brings forward its latest response, and only these are carried on in order of time: the stretches of a day
within it, and days from one to the next. Payloads don't move; they are found by the response's record_id.

Names of headers have no case: they are lower-cased, and of names that are then equal the last one counts. Urls are
compared without what doesn't tell resources apart: escapes of letters, digits and -._~ are decoded, those of others
written in upper case, and segments . and .. resolved.

Defined cases: a record without url or time is resolved to nothing, and joins nothing; at equal times a response is
not earlier; of responses of one time the largest record_id counts, and of those that share that as well the one whose
headers sort last; without validators on either side the status is `no-validator`, with none earlier `no-response`,
with validators that differ `changed`. Equal rows each get a row. Other columns are kept apart by the names of the
structs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm import common
from ledgerloom.llm.common import bitmap, stash, table, tag

#: Headers that a 304 answer carries and that replace the stored ones.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def _unescaped(text: Column) -> Column:
    """Escapes of unreserved characters decoded, all others in upper case; a % that begins no escape stays."""
    code = lambda x: F.conv(F.substring(x, 1, 2), 16, 10).cast("int")
    plain = lambda x: F.char(code(x)).rlike(r"^[A-Za-z0-9._~-]$")
    one = lambda x: F.when(plain(x), F.concat(F.char(code(x)), F.substring(x, 3, 1 << 30))).otherwise(F.concat(F.lit("%"), F.upper(F.substring(x, 1, 2)), F.substring(x, 3, 1 << 30)))
    parts = F.transform(F.split(text, "%"), lambda x, i: F.when(i == 0, x).when(x.rlike("^[0-9A-Fa-f]{2}"), one(x)).otherwise(F.concat(F.lit("%"), x)))
    return F.when(F.contains(text, F.lit("%")), F.array_join(parts, "")).otherwise(text)


def _resolved(path: Column) -> Column:
    """Without segments . and .., each of which takes the one before with it."""
    step = lambda acc, x: F.when(x == ".", acc).when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))).otherwise(F.concat(acc, F.array(x)))
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), F.array_join(F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step), "/")).otherwise(path)


def folded(headers: Column) -> Column:
    """Entries with names in lower case, the last one of each name, in order."""
    low = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    later = lambda e, i: F.exists(F.slice(low, i + 2, F.size(low)), lambda o: o["key"] == e["key"])
    return F.map_from_entries(F.filter(low, lambda e, i: ~later(e, i)))


def canonical_url(url: str | Column) -> Column:
    """Without scheme, www., default port, fragment, tracking parameters and a last slash; A-Z of the host folded, needless
    escapes decoded, segments . and .. resolved."""
    u = F.col(url) if isinstance(url, str) else url
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    u = F.regexp_replace(u, "#.*$", "")
    host = F.lower(F.regexp_extract(u, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^(www\.)+", ""), r":(80|443)$", "")
    path = _resolved(_unescaped(F.regexp_extract(u, r"^[^/?]*([^?]*)", 1)))
    query = _unescaped(F.regexp_extract(u, r"^[^?]*\??(.*)$", 1))
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike("^(utm_[a-z]+|ref)=")))
    return F.concat(host, F.regexp_replace(path, "/+$", ""), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _opaque(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Of records (record_id, kind `response` or `revisit`, url, ts, headers map): a row for each revisit, with
    canonical_url, response_id, status and the merged headers (null unless the status is `resolved`)."""
    r = records.select("record_id", "kind", "ts", canonical_url("url").alias("canonical_url"), folded(F.col("headers")).alias("headers"))
    r = stash(r, "records")  # urls and names are read several times, and made once
    placed = r.where("canonical_url IS NOT NULL AND ts IS NOT NULL").withColumn("day", F.to_date("ts"))
    per_minute = placed.groupBy("canonical_url", "day", F.date_trunc("minute", "ts").alias("minute")).agg(F.count("*").alias("n"))
    per_minute = stash(per_minute, "minutes")
    busy = per_minute.groupBy("canonical_url", "day").agg(F.sum("n").alias("n")).where(F.col("n") >= common.HOT)
    full = per_minute.where(F.col("n") >= common.HOT)
    placed = tag(placed, bitmap(busy, ["canonical_url", "day"], common.HOT_BITS), ["canonical_url", "day"], "busy")
    placed = tag(placed.withColumn("minute", F.date_trunc("minute", "ts")), bitmap(full, ["canonical_url", "minute"], common.HOT_BITS), ["canonical_url", "minute"], "full")
    placed = placed.withColumn("stretch", F.when(F.col("busy") & F.col("full"), F.date_trunc("second", "ts")).when(F.col("busy"), F.col("minute")).otherwise(F.date_trunc("day", "ts")))
    response = F.struct("ts", "record_id", F.array_sort(F.map_entries("headers")).alias("entries"))
    placed = placed.withColumn("response", F.when(F.col("kind") == "response", response))
    stretch = W.partitionBy("canonical_url", "stretch")
    # at one time, revisits come before responses, and responses in order of their ids
    inside = stretch.orderBy("ts", F.col("response").isNotNull(), "response").rowsBetween(W.unboundedPreceding, -1)
    latest = F.last("response", ignorenulls=True).over(inside)
    tops = placed.groupBy("canonical_url", "day", "stretch").agg(F.max(F.struct("response.ts", "response.record_id")).alias("top"), F.max(F.col("response").isNotNull()).alias("any"))
    tops = tops.withColumn("top", F.when(F.col("any"), F.col("top")))
    before = lambda w: F.last("top", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    days = tops.groupBy("canonical_url", "day").agg(F.max("top").alias("top")).withColumn("yesterday", before(W.partitionBy("canonical_url").orderBy("day"))).drop("top")
    today = tops.withColumn("today", before(W.partitionBy("canonical_url", "day").orderBy("stretch"))).join(days, ["canonical_url", "day"])
    carried = today.select("canonical_url", "stretch", F.coalesce("today", "yesterday").alias("carried")).where("carried IS NOT NULL")
    stored = placed.where("response IS NOT NULL").select(F.col("canonical_url").alias("u"), F.col("record_id").alias("i"), F.col("ts").alias("t"), F.col("response.entries").alias("entries"))
    carried = carried.join(
        stored, (F.col("canonical_url") == F.col("u")) & F.col("carried.record_id").eqNullSafe(F.col("i")) & (F.col("carried.ts") == F.col("t"))
    ).groupBy("canonical_url", "stretch").agg(F.max(F.struct(F.col("i").alias("record_id"), "entries")).alias("carried"))
    revisits = placed.withColumn("latest", latest).where("kind = 'revisit'").join(carried, ["canonical_url", "stretch"], "left")
    found = revisits.select(
        "record_id", "canonical_url", "ts", "headers",
        F.coalesce("latest.record_id", "carried.record_id").alias("response_id"),
        F.map_from_entries(F.coalesce("latest.entries", "carried.entries")).alias("stored"),
    )
    lost = r.where("kind = 'revisit' AND (canonical_url IS NULL OR ts IS NULL)").select("record_id", "canonical_url", "ts", "headers")
    found = found.unionByName(lost, allowMissingColumns=True)
    known = F.col("canonical_url").isNotNull() & F.col("ts").isNotNull() & F.col("response_id").isNotNull()
    own, old = F.col("headers"), F.col("stored")
    tags, dates = (own["etag"].isNotNull() & old["etag"].isNotNull()), (own["last-modified"].isNotNull() & old["last-modified"].isNotNull())
    same = F.when(tags, _opaque(own["etag"]) == _opaque(old["etag"])).when(dates, own["last-modified"] == old["last-modified"])
    status = F.when(~known, "no-response").when(same.isNull(), "no-validator").when(same, "resolved").otherwise("changed")
    new = F.map_filter(F.coalesce(own, F.create_map().cast("map<string,string>")), lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k))
    return found.withColumn("status", status).select(
        "record_id", "canonical_url", "ts", F.when(known, F.col("response_id")).alias("response_id"), "status",
        F.when(F.col("status") == "resolved", F.map_concat(kept, new)).alias("headers"),
    )


def capture_records(pages: DataFrame) -> DataFrame:
    """Two records of each page: its capture, and a later visit by another spelling of its url at which the server
    said "not modified". The tables hold no records of their own, so times and headers follow from id and content."""
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 600)
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 12), F.lit('"'))
    http = lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss")
    later = F.timestamp_seconds(F.lit(1_700_000_300) + F.col("page_id") * 600 + (F.col("page_id") % 11) * 43_200)
    size = F.octet_length(F.coalesce("html", F.lit(""))).cast("string")
    response = F.create_map(
        F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), size, F.lit("date"), http(at), F.lit("etag"), tag, F.lit("last-modified"), http(at)
    )
    seen = F.when(F.col("page_id") % 7 == 3, F.lit('"other"')).when(F.col("page_id") % 5 == 0, F.concat(F.lit("W/"), tag)).when(F.col("page_id") % 5 == 1, F.lit(None)).otherwise(tag)
    changed = F.when(F.col("page_id") % 3 > 0, http(at))
    revisit = F.map_filter(
        F.create_map(F.lit("content-length"), F.lit("0"), F.lit("date"), http(later), F.lit("etag"), seen, F.lit("last-modified"), changed, F.lit("cache-control"), F.lit("max-age=60")),
        lambda _, v: v.isNotNull(),
    )
    url = F.regexp_replace("url", "^(https?://)", "$1www.")
    one = pages.select((F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("kind"), "url", at.alias("ts"), response.alias("headers"))
    two = pages.select((F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), url.alias("url"), later.alias("ts"), revisit.alias("headers"))
    return one.union(two)


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resolve_revisits(capture_records(table(spark, sf_dir, "pages")))
    return out.select(
        "record_id", "canonical_url", "response_id", "status",
        F.col("headers")["etag"].alias("etag"), F.col("headers")["date"].alias("date"),
        F.col("headers")["content-length"].alias("content_length"), F.col("headers")["cache-control"].alias("cache_control"),
    )


OP2_SQL = r"""
WITH base AS (
  SELECT page_id, url, make_timestamp((1700000000 + page_id * 600) * 1000000) AS t0,
    make_timestamp((1700000300 + page_id * 600 + (page_id % 11) * 43200) * 1000000) AS later,
    '"' || substr(md5(coalesce(html, '')), 1, 12) || '"' AS tag, octet_length(encode(coalesce(html, '')))::VARCHAR AS size
  FROM pages),
records AS (
  SELECT page_id * 2 AS record_id, 'response' AS kind, url, t0 AS ts, tag AS etag, strftime(t0, '%Y-%m-%d %H:%M:%S') AS modified,
    strftime(t0, '%Y-%m-%d %H:%M:%S') AS date, size FROM base
  UNION ALL
  SELECT page_id * 2 + 1, 'revisit', regexp_replace(url, '^(https?://)', '\1www.'), later,
    CASE WHEN page_id % 7 = 3 THEN '"other"' WHEN page_id % 5 = 0 THEN 'W/' || tag WHEN page_id % 5 = 1 THEN NULL ELSE tag END,
    CASE WHEN page_id % 3 > 0 THEN strftime(t0, '%Y-%m-%d %H:%M:%S') END, strftime(later, '%Y-%m-%d %H:%M:%S'), '0' FROM base),
bare AS (SELECT *, regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '') AS u FROM records),
parts AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^([^/?]*)', 1)), '^(www\.)+', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
  list_sort(list_filter(string_split(regexp_extract(u, '^[^?]*\??(.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref)='))) AS kept FROM bare),
urls AS (SELECT *, CASE WHEN url IS NULL THEN NULL ELSE place || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical_url FROM parts),
pairs AS (
  SELECT v.record_id, v.canonical_url, v.etag, v.modified, v.date, r.record_id AS response_id, r.etag AS old_etag, r.modified AS old_modified, r.size AS old_size,
    row_number() OVER (PARTITION BY v.record_id ORDER BY r.ts DESC NULLS LAST, r.record_id DESC NULLS LAST) AS k
  FROM urls v LEFT JOIN urls r ON r.kind = 'response' AND r.canonical_url = v.canonical_url AND r.ts < v.ts
  WHERE v.kind = 'revisit'),
said AS (SELECT *, CASE WHEN response_id IS NULL THEN 'no-response'
    WHEN etag IS NOT NULL AND old_etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(old_etag, '^W/', '') THEN 'resolved' ELSE 'changed' END
    WHEN modified IS NOT NULL AND old_modified IS NOT NULL THEN CASE WHEN modified = old_modified THEN 'resolved' ELSE 'changed' END
    ELSE 'no-validator' END AS status FROM pairs WHERE k = 1)
SELECT record_id, canonical_url, response_id, status,
  CASE WHEN status = 'resolved' THEN coalesce(etag, old_etag) END AS etag, CASE WHEN status = 'resolved' THEN date END AS date,
  CASE WHEN status = 'resolved' THEN old_size END AS content_length, CASE WHEN status = 'resolved' THEN 'max-age=60' END AS cache_control
FROM said
"""
