"""Not-modified revisits of a crawl: the response that each of them stands for.

A WARC revisit record says that a server answered "not modified" and has no payload.
It is resolved by an as-of join: the latest earlier full response with the same
canonical URL, if the validators agree, with the headers that a 304 may update.

The join is a range-partitioned order of (URL, time, record), in which a URL with very
many captures spans as many partitions as it needs. Within a partition the last
response is carried forward, and from one partition to the next by a table with one row
for each. Payloads do not move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tricycle.plans import materialize

# Query parameters that do not tell pages apart.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)"
# Headers that a 304 response must not update: those of the payload and of the connection.
FIXED = (
    "connection content-encoding content-length content-md5 content-range content-type keep-alive "
    "proxy-authenticate proxy-connection te trailer transfer-encoding upgrade"
).split()
SCHEME = "(?:[A-Za-z][A-Za-z0-9+.-]*://)?"


def canonical_url(url: str) -> Column:
    """The URL in the column ``url`` in one spelling: host, path and telling query
    parameters in order; no scheme, user, ``www``, default port, fragment, tracking
    parameters or closing slash. Null stays null.
    """
    bare = f"regexp_replace(trim({url}), '#.*$', '')"
    host = f"lower(regexp_extract({bare}, r'^{SCHEME}([^/?]*)', 1))"
    host = f"regexp_replace(regexp_replace({host}, r'^([^@]*@)?(www[0-9]*[.])?', ''), r':(80|443)$', '')"
    path = f"regexp_replace(regexp_extract({bare}, r'^{SCHEME}[^/?]*([^?]*)', 1), '/+$', '')"
    query = f"split(regexp_extract({bare}, r'[?](.*)$', 1), '&')"
    query = f"array_join(array_sort(filter({query}, p -> p <> '' AND NOT p RLIKE r'{TRACKING}')), '&')"
    return F.expr(f"concat({host}, {path}, transform(array({query}), q -> if(q = '', '', concat('?', q)))[0])")


def lower_headers(headers: str) -> Column:
    """A header map with lower-case names; of names that differ in case the last counts."""
    entries = f"transform(map_entries({headers}), e -> struct(lower(e.key) AS key, e.value AS value))"
    last = "filter(x, (e, i) -> NOT exists(slice(x, i + 2, size(x)), later -> later.key = e.key))"
    return F.expr(f"coalesce(map_from_entries(transform(array({entries}), x -> {last})[0]), map())").cast("map<string,string>")


def resolved_revisits(records: DataFrame) -> DataFrame:
    """``(record_id, canonical, original_id, outcome, headers)`` for each revisit among the
    rows ``(record_id, type, url, ts, headers)``; ``type`` is ``response`` or ``revisit``,
    ``headers`` a map of strings.

    The original is the latest response with the same canonical URL that is earlier by
    ``ts``, then by ``record_id``. The outcome is ``resolved`` if the entity tags agree
    (weak ones like strong ones), or, where one has none, the modification dates;
    ``changed`` if they differ, ``unchecked`` if there is nothing to compare, and
    ``missing`` without an original. Headers are the original's, updated by those of the
    revisit that a 304 may change; without an original, or if it changed, the revisit's.

    Rows of other types or with a null type, URL, time or id are no captures and left
    out. Null headers are none. Repeated rows are resolved one by one. Other columns are
    ignored; an empty table gives an empty result.
    """
    rows = records.where("type IN ('response', 'revisit')").select(
        "record_id",
        (F.col("type") == "response").alias("full"),
        canonical_url("url").alias("canonical"),
        "ts",
        lower_headers("headers").alias("headers"),
    )
    rows = rows.where("record_id IS NOT NULL AND canonical IS NOT NULL AND ts IS NOT NULL")
    order = ["ts", "record_id"]
    placed = rows.repartitionByRange("canonical", *order).withColumn("part", F.spark_partition_id())
    placed = materialize(placed, "captures")
    one = F.when(F.col("full"), F.struct("record_id", "headers"))
    before = Window.partitionBy("part", "canonical").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    carried = placed.withColumn("original", F.last(one, ignorenulls=True).over(before))

    # The last response of each partition's last URL, for the partitions that go on with it.
    ends = placed.groupBy("part").agg(F.min("canonical").alias("first"), F.max("canonical").alias("canonical"))
    latest = F.max_by(F.struct("record_id", "headers"), F.struct(*order))
    closing = (
        placed.where("full").join(F.broadcast(ends.select("part", "canonical")), ["part", "canonical"])
        .groupBy("part").agg(latest.alias("response"))
    )
    # At most one row for each partition, here and below.
    ends = ends.join(closing, "part", "left")
    whole = Window.partitionBy("canonical").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    into = (
        ends.select("part", "canonical", "response")
        .union(ends.where("first <> canonical").select("part", F.col("first").alias("canonical"), F.lit(None)))
        .withColumn("incoming", F.last("response", ignorenulls=True).over(whole))
        .where("incoming IS NOT NULL").select("part", "canonical", "incoming")
    )
    found = (
        carried.where("NOT full").join(F.broadcast(into), ["part", "canonical"], "left")
        .withColumn("original", F.coalesce("original", "incoming"))
    )
    tag = "regexp_replace({}.etag, '^W/', '')".format
    dates = "headers['last-modified'] IS NOT NULL AND original.headers['last-modified'] IS NOT NULL"
    outcome = f"""CASE WHEN original IS NULL THEN 'missing'
        WHEN {tag('headers')} IS NOT NULL AND {tag('original.headers')} IS NOT NULL
            THEN if({tag('headers')} = {tag('original.headers')}, 'resolved', 'changed')
        WHEN {dates} THEN if(headers['last-modified'] = original.headers['last-modified'], 'resolved', 'changed')
        ELSE 'unchecked' END"""
    fixed = ", ".join(f"'{name}'" for name in FIXED)
    updates = f"map_filter(headers, (k, v) -> k NOT IN ({fixed}))"
    merged = f"map_concat(map_filter(original.headers, (k, v) -> NOT map_contains_key({updates}, k)), {updates})"
    return (
        found.withColumn("outcome", F.expr(outcome))
        .select(
            "record_id",
            "canonical",
            F.col("original.record_id").alias("original_id"),
            "outcome",
            F.expr(f"if(outcome IN ('missing', 'changed'), headers, {merged})").alias("headers"),
        )
    )


def header_text(headers: str) -> Column:
    """A header map as lines ``name: value``, by name."""
    return F.expr(
        f"array_join(transform(array_sort(map_entries({headers})), e -> concat(e.key, ': ', coalesce(e.value, ''))), '\\n')"
    )


# ---------------------------------------------------------------- captures of given pages

CAPTURES = 4  # of each page


def captures(pages: DataFrame) -> DataFrame:
    """A crawl log of the pages ``(page_id, url, html)``: a first full response each, then
    revisits or, now and then, another full response. Times, kinds and validators follow
    from hashes of the page and the capture, so every run gives the same log.
    """
    number = "CAST(conv(substr(md5({}), 1, 8), 16, 10) AS LONG)".format
    rows = pages.where("page_id IS NOT NULL").select(
        "page_id", "url", F.md5(F.coalesce("html", F.lit(""))).alias("digest"),
        F.octet_length(F.coalesce("html", F.lit(""))).alias("n_bytes"),
        F.explode(F.sequence(F.lit(0), F.lit(CAPTURES - 1))).alias("visit"),
    )
    rows = rows.withColumn("h", F.expr(number("concat(page_id, ':', visit)"))).withColumn(
        "start", F.expr(f"1700000000 + {number('cast(page_id AS string)')} % 2592000")
    )
    rows = rows.withColumns(
        {
            "full": F.expr("(visit = 0 AND h % 16 > 0) OR (visit > 0 AND h % 8 = 0)"),
            "ts": F.expr("start + visit * (3600 + h % 7200)"),
            "etag": F.expr("concat('\"', if(h % 8 = 5, 'x', ''), substr(digest, 1, 16), '\"')"),
        }
    )
    length = "cast(n_bytes AS string)"
    full = f"""map('Content-Type', 'text/html', 'Content-Length', {length}, 'ETag', etag, 'Date', cast(ts AS string),
        'Last-Modified', cast(start AS string), 'Cache-Control', 'max-age=60')"""
    seen = f"""map_filter(map('content-length', '0', 'date', cast(ts AS string), 'connection', 'close', 'x-cache', cast(h % 3 AS string),
        'etag', if(h % 8 < 6, concat('W/', etag), NULL), 'last-modified', if(h % 8 < 7, cast(start AS string), NULL)),
        (k, v) -> v IS NOT NULL)"""
    return rows.select(
        F.expr(f"page_id * {CAPTURES} + visit").alias("record_id"),
        F.expr("if(full, 'response', 'revisit')").alias("type"),
        "url",
        "ts",
        F.expr(f"if(full, {full}, {seen})").alias("headers"),
    )
