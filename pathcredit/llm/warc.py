"""Web-archive records: "not modified" revisits resolved to the full response they confirm.

A revisit is joined as-of: by canonical URL to the latest full response earlier
in (date, record id). Its validators must agree with that response's (ETag by
weak comparison if both have one, else Last-Modified if both have it), and then
its permitted headers replace the stored ones of the same name.

A URL may have any number of captures, so no window holds a whole URL: records
are range-partitioned by (URL, date, record id), a window finds the latest
response inside each (partition, URL), and what a partition's first URL inherits
from earlier partitions comes from a table with at most one row per partition.

Records have ``record_id long, warc_type string, uri string, date timestamp,
http string, payload string``; ``http`` is the status line and header lines.

Defined results: a null URL or date never resolves and is never resolved to;
repeated records answer one by one; header names compare without case, a header
line without a colon is dropped; a null ``http`` has no headers; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pathcredit.llm.common import ascii_lower, materialize

#: Headers a 304 response must not or need not change (hop-by-hop ones, and those on the body).
KEPT_FROM_RESPONSE = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade")


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no default port, no fragment, ``/`` for an empty path; others unchanged."""
    parts = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^#]*)"
    scheme = ascii_lower(F.regexp_extract(url, parts, 1))
    host = ascii_lower(F.regexp_extract(url, parts, 2))
    port = F.when(scheme == "http", ":80").when(scheme == "https", ":443").otherwise(F.lit("\n"))
    host = F.when(host.endswith(port), host.substr(F.lit(1), F.length(host) - F.length(port))).otherwise(host)
    rest = F.regexp_extract(url, parts, 3)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(scheme == "", url).otherwise(F.concat(scheme, F.lit("://"), host, rest))


def header_lines(http: Column) -> Column:
    """array<struct<name, line>> of the header lines after the status line; ``name`` in lower case."""
    every = F.split(F.coalesce(http, F.lit("")), "\r?\n")
    lines = F.slice(every, F.lit(2), F.size(every))
    return F.transform(F.filter(lines, lambda x: F.instr(x, ":") > 1), lambda x: F.struct(
        F.lower(F.trim(F.substring_index(x, ":", 1))).alias("name"), F.trim(x).alias("line")))


def header(headers: Column, name: str) -> Column:
    """Value of the first header of that name, or null."""
    line = F.get(F.filter(headers, lambda h: h["name"] == name), F.lit(0))["line"]
    return F.trim(line.substr(F.instr(line, ":") + 1, F.length(line)))


def _same_validators(stored: Column, etag: Column, modified: Column) -> Column:
    def opaque(tag: Column) -> Column:
        return F.regexp_replace(tag, "^W/", "")

    old_tag, old_modified = stored["etag"], stored["modified"]
    return (F.when(etag.isNotNull() & old_tag.isNotNull(), opaque(etag) == opaque(old_tag))
            .when(modified.isNotNull() & old_modified.isNotNull(), modified == old_modified).otherwise(F.lit(False)))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per record: (record_id, warc_type, url, status, resolved_from, headers, payload_bytes, payload_crc32).

    ``status``: ``full`` (a response), ``resolved``, ``changed`` (the validators
    disagree or are missing) or ``missing`` (no earlier response). ``headers``
    are the merged header lines joined by newlines, and the payload columns
    those of the response; both null unless full or resolved.
    """
    spark = records.sparkSession
    headers = header_lines(F.col("http"))
    payload = F.coalesce("payload", F.lit(""))
    rows = records.select(
        "record_id", "warc_type", canonical_url(F.col("uri")).alias("url"), "date", headers.alias("headers"),
        header(headers, "etag").alias("etag"), header(headers, "last-modified").alias("modified"),
        F.octet_length(payload).cast("long").alias("bytes"), F.crc32(payload.cast("binary")).alias("crc"),
        F.monotonically_increasing_id().alias("tie"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["date", "record_id", "tie"]
    # Written, so that every reader sees the same sampled range bounds.
    ranges = materialize(rows.repartitionByRange(n, "url", *order).withColumn("pid", F.spark_partition_id()))

    usable = (F.col("warc_type") == "response") & F.col("url").isNotNull() & F.col("date").isNotNull()
    response = F.when(usable, F.struct("record_id", "headers", "etag", "modified", "bytes", "crc"))
    earlier = W.partitionBy("pid", "url").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    inside = ranges.withColumn("inside", F.last(response, ignorenulls=True).over(earlier))

    tails = ranges.where(usable).groupBy("url", "pid").agg(F.max_by(response, F.struct(*order)).alias("tail"))
    ends = ranges.groupBy("url").agg(F.min("pid").alias("first"), F.max("pid").alias("last")).where("first < last")
    # URLs that lie in several partitions: in each of these they are the first or the last URL.
    spanning = ends.select("url", F.explode(F.sequence("first", "last")).alias("pid")).join(tails, ["url", "pid"], "left")
    before = W.partitionBy("url").orderBy("pid").rowsBetween(W.unboundedPreceding, -1)
    carried = (spanning.withColumn("carried", F.last("tail", ignorenulls=True).over(before))
               .where("carried is not null").select("url", "pid", "carried"))
    joined = inside.join(F.broadcast(carried), ["url", "pid"], "left")  # at most one row per range partition

    stored = F.when(F.col("date").isNotNull() & F.col("url").isNotNull(), F.coalesce("inside", "carried"))
    full = F.col("warc_type") == "response"
    joined = joined.withColumn("stored", stored).withColumn(
        "status", F.when(full, "full").when(F.col("stored").isNull(), "missing")
        .when(_same_validators(F.col("stored"), F.col("etag"), F.col("modified")), "resolved").otherwise("changed"))
    permitted = F.filter("headers", lambda h: ~h["name"].isin(*KEPT_FROM_RESPONSE))
    names = F.transform(permitted, lambda h: h["name"])
    merged = F.concat(F.filter(F.col("stored.headers"), lambda h: ~F.array_contains(names, h["name"])), permitted)
    good = F.col("status") == "resolved"
    lines = F.when(full, F.col("headers")).when(good, merged)
    return joined.select(
        "record_id", "warc_type", "url", "status", F.when(good, F.col("stored.record_id")).alias("resolved_from"),
        F.array_join(F.transform(lines, lambda h: h["line"]), "\n").alias("headers"),
        F.when(full, F.col("bytes")).when(good, F.col("stored.bytes")).alias("payload_bytes"),
        F.when(full, F.col("crc")).when(good, F.col("stored.crc")).alias("payload_crc32"))


def with_payload(resolved: DataFrame, records: DataFrame) -> DataFrame:
    """``resolved`` with the ``payload`` of the response each record stands for (null where there is none), row by row.

    Repeated records, and records of one id with several payloads, are told apart by the payload's length and
    checksum: each row finds one body.
    """
    payload = F.coalesce("payload", F.lit(""))
    bodies = (records.where("warc_type = 'response'")
              .groupBy(F.col("record_id").alias("_of"), F.octet_length(payload).cast("long").alias("_bytes"),
                       F.crc32(payload.cast("binary")).alias("_crc")).agg(F.max("payload").alias("payload")))
    of = F.when(F.col("status") == "full", F.col("record_id")).otherwise(F.col("resolved_from"))
    same = (F.col("_at") == F.col("_of")) & (F.col("payload_bytes") == F.col("_bytes")) & (F.col("payload_crc32") == F.col("_crc"))
    return resolved.withColumn("_at", of).join(bodies, same, "left").drop("_at", "_of", "_bytes", "_crc")


def records_of_pages(pages: DataFrame) -> DataFrame:
    """A crawl's records derived from every row of ``pages`` by a rule that SQL can repeat.

    Each page is a response. Every third page has a revisit, at another spelling
    of its URL, confirming it, with a changed ETag (page_id % 9 = 0), or dated
    before it (page_id % 15 = 0). Every second page revisits its host's
    robots.txt, of which every 50th page holds a response: a URL with as many
    captures as its host has pages.
    """
    page = F.col("page_id")
    html = F.coalesce("html", F.lit(""))
    scheme, host = (F.regexp_extract("url", r"^([a-z]+)://([^/?#]*)", i) for i in (1, 2))
    at = F.lit(1700000000) + page * 60

    def stamp(seconds: Column) -> Column:
        return F.timestamp_seconds(seconds)

    def http_date(seconds: Column) -> Column:
        return F.concat(F.date_format(stamp(seconds), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))

    def block(status: str, *lines: Column) -> Column:
        return F.concat_ws("\r\n", F.lit(f"HTTP/1.1 {status}"), *lines)

    def line(name: str, *value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), *value)

    def record(number: int, kind: str, uri: Column, seconds: Column, http: Column, payload: Column) -> Column:
        return F.struct((page * 4 + number).alias("record_id"), F.lit(kind).alias("warc_type"), uri.alias("uri"),
                        stamp(seconds).alias("date"), http.alias("http"), payload.alias("payload"))

    tag = F.concat(F.lit('"'), F.substring(F.md5(html), 1, 16), F.lit('"'))
    robots = F.concat(scheme, F.lit("://"), host, F.lit("/robots.txt"))
    rules = F.concat(F.lit("User-agent: *\nCrawl-delay: "), (F.floor(page / 50) % 7).cast("string"))
    response = record(0, "response", F.col("url"), at, block(
        "200 OK", F.lit("Content-Type: text/html; charset=utf-8"), line("Content-Length", F.octet_length(html).cast("string")),
        line("ETag", tag), line("Last-Modified", http_date(at - 86400)), F.lit("Cache-Control: max-age=60"),
        F.lit("X-Cache: MISS")), html)
    other_spelling = F.concat(F.upper(scheme), F.lit("://"), F.upper(host), F.when(scheme == "https", ":443").otherwise(":80"),
                              F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^#]*)", 1), F.lit("#again"))
    seen = F.when(page % 15 == 0, at - 7200).otherwise(at + 3600 * (1 + page % 5))
    revisit = F.when(page % 3 == 0, record(1, "revisit", other_spelling, seen, block(
        "304 Not Modified", line("Date", http_date(seen)),
        line("etag", F.when(page % 9 == 0, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), tag))),
        F.lit("Cache-Control: max-age=120"), F.lit("Content-Length: 0"), F.lit("Connection: close")), F.lit(None).cast("string")))
    robots_response = F.when(page % 50 == 0, record(2, "response", robots, at, block(
        "200 OK", F.lit("Content-Type: text/plain"), line("Last-Modified", http_date(at - at % 86400))), rules))
    robots_revisit = F.when(page % 2 == 1, record(3, "revisit", robots, at, block(
        "304 Not Modified", line("Last-Modified", http_date(at - at % 86400)), line("Date", http_date(at))),
        F.lit(None).cast("string")))
    return pages.select(F.explode(F.array_compact(F.array(response, revisit, robots_response, robots_revisit)))
                        .alias("r")).select("r.*")
