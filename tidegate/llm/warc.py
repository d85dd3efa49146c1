"""Not-modified revisits of a web archive, resolved to the response they refer to.

A revisit record says that a page had not changed since it was fetched before. It is joined as of its time, by canonical
URL, to the latest earlier full response. The validators of both must agree: entity tags if both have one, else times of
last modification. The resolved headers are those of the response, updated by those that a not-modified answer may carry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Headers of a not-modified answer that update the stored ones.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Parameters that don't select a page.
TRACKING = r"(?:utm_[^=&]*|ref|fbclid|gclid)"
#: Records between two borders of time, about; a URL's records are put in order between borders only.
CHUNK_ROWS = 50_000
MOST_CHUNKS = 10_000


def canonical_url(url: Column) -> Column:
    """Scheme, user, default port, www. or m., tracking parameters, fragment and final slashes go; the host is in lower
    case; parameters are sorted. A null URL stays null."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^(?:www|m)\.|:(?:80|443)?$", "")
    host = F.regexp_replace(host, r":(?:80|443)?$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"),
                                  lambda p: (p != "") & ~p.rlike(f"^{TRACKING}(?:=|$)")))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))


def lower_headers(headers: Column) -> Column:
    """Names in lower case; of names that differ in case only the last counts. Null headers are none."""
    entries = F.map_entries(F.coalesce(headers, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))))
    named = F.transform(entries, lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value")))
    kept = F.filter(named, lambda e, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(kept)


def _as_of(rows: DataFrame) -> DataFrame:
    """rows (url, at, record_id, full) → the revisits with ``found``: (at, record_id) of the latest earlier response.

    Borders of time are counted quantiles of all records, so that between two of them a URL has few records even if most
    belong to it; a response from before the border comes from one row per URL and chunk.
    """
    chunks = max(1, min(MOST_CHUNKS, rows.count() // CHUNK_ROWS))
    borders = []
    if chunks > 1:
        seconds = F.unix_micros("at")
        borders = sorted(set(rows.agg(F.percentile_approx(seconds, [i / chunks for i in range(1, chunks)], 100 * chunks)).first()[0] or []))
    chunk = F.lit(0)
    if borders:
        known = F.array(*(F.lit(b).cast("long") for b in borders))
        chunk = F.size(F.filter(known, lambda b: b < F.unix_micros("at")))
    rows = rows.withColumn("chunk", chunk)
    own = F.when(F.col("full"), F.struct("at", "record_id"))
    latest = rows.filter("full").groupBy("url", "chunk").agg(F.max("at").alias("at"), F.max_by("record_id", F.struct("at", "record_id")).alias("record_id"))
    # A chunk without responses still hands on those before it.
    places = rows.select("url", "chunk").distinct().join(latest, ["url", "chunk"], "left")
    earlier = Window.partitionBy("url").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = places.select("url", "chunk", F.last(F.when(F.col("at").isNotNull(), F.struct("at", "record_id")), True).over(earlier).alias("before"))
    # Of records of the same time none is earlier than another.
    inside = Window.partitionBy("url", "chunk").orderBy(F.unix_micros("at")).rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.max(own).over(inside))
    return (rows.filter("NOT full").join(before, ["url", "chunk"], "left")
            .select("url", "at", "record_id", F.coalesce("inside", "before").alias("found")))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """records (record_id, url, at, type, headers, payload, ...) → one row per revisit:
    (record_id, url, response_id, outcome, headers, payload_sha256, payload_bytes).

    ``type`` is 'response' or 'revisit'; other types, and rows without record_id, URL or time, take no part. Outcomes:
    'resolved', 'unverified' (no validator on both sides; resolved all the same), 'changed' (validators differ; headers
    are the revisit's own and there is no payload) and 'missing' (no earlier response; likewise). Records of equal time
    don't answer each other; of equally late responses the greater record_id counts. Repeated rows are one record. Other
    columns are ignored. The payload itself is not moved: ``response_id`` says where it is.
    """
    base = records.filter("record_id IS NOT NULL AND url IS NOT NULL AND at IS NOT NULL AND type IN ('response', 'revisit')")
    rows = base.select(canonical_url(F.col("url")).alias("url"), "at", F.col("record_id").cast("long").alias("record_id"),
                       (F.col("type") == "response").alias("full"), lower_headers(F.col("headers")).alias("headers"), "payload")
    responses = rows.filter("full").select(
        F.col("record_id").alias("response_id"), F.col("headers").alias("stored"),
        F.sha2(F.coalesce(F.col("payload"), F.lit("")).cast("binary"), 256).alias("payload_sha256"),
        F.octet_length(F.coalesce("payload", F.lit(""))).cast("long").alias("payload_bytes")).dropDuplicates(["response_id"])
    revisits = rows.filter("NOT full").select(F.col("record_id").alias("id"), F.col("headers").alias("own")).dropDuplicates(["id"])
    found = _as_of(rows.select("url", "at", "record_id", "full").distinct())
    joined = (found.select("record_id", "url", F.col("found.record_id").alias("response_id"))
              .dropDuplicates(["record_id"])
              .join(revisits, F.col("record_id") == F.col("id")).join(responses, "response_id", "left"))

    def tag(headers):
        return F.regexp_replace(F.trim(F.try_element_at(headers, F.lit("etag"))), r"^W/", "")

    def modified(headers):
        return F.trim(F.try_element_at(headers, F.lit("last-modified")))

    own, stored = F.col("own"), F.col("stored")
    same = F.coalesce(tag(own) == tag(stored), modified(own) == modified(stored))
    outcome = (F.when(F.col("response_id").isNull(), "missing").when(same.isNull(), "unverified")
               .when(same, "resolved").otherwise("changed"))
    news = F.map_filter(own, lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(news), k)), news)
    good = F.col("outcome").isin("resolved", "unverified")
    return (joined.withColumn("outcome", outcome)
            .select("record_id", "url", "response_id", "outcome", F.when(good, merged).otherwise(own).alias("headers"),
                    F.when(good, F.col("payload_sha256")).alias("payload_sha256"),
                    F.when(good, F.col("payload_bytes")).alias("payload_bytes")))


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """A web archive made of a table of pages: each page is fetched once, in the order of its id, and visited again later.

    Every third page is visited with a spelling of its URL in http and with a fragment; every seventh had changed; every
    eleventh answered without validators; every thirteenth was first visited before it was fetched.
    """
    start = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id"))
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"'))
    when = F.date_format(start, "yyyy-MM-dd HH:mm:ss")
    pages = pages.filter("page_id IS NOT NULL")
    response = pages.select(
        (F.col("page_id") * 2).alias("record_id"), "url", start.alias("at"), F.lit("response").alias("type"),
        F.create_map(F.lit("ETag"), tag, F.lit("Last-Modified"), when, F.lit("Content-Type"), F.lit("text/html"),
                     F.lit("Date"), when).alias("headers"), F.col("html").alias("payload"))
    third, seventh, eleventh, thirteenth = (F.pmod("page_id", F.lit(k)) == 0 for k in (3, 7, 11, 13))
    spelled = F.when(third, F.concat(F.regexp_replace("url", "^https?://", "http://"), F.lit("#again"))).otherwise(F.col("url"))
    again = F.date_format(start + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss")
    bare = F.create_map(F.lit("date"), again, F.lit("server"), F.lit("archive"))
    revisit = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), spelled.alias("url"),
        F.when(thirteenth, start - F.expr("INTERVAL 30 DAYS")).otherwise(start + F.expr("INTERVAL 1 DAY")).alias("at"),
        F.lit("revisit").alias("type"), F.when(eleventh, bare).otherwise(F.map_concat(bare, F.create_map(
            F.lit("etag"), F.when(seventh, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag))))).alias("headers"),
        F.lit(None).cast("string").alias("payload"))
    return response.unionByName(revisit)


def revisit_digest(records: DataFrame) -> DataFrame:
    """The resolved revisits with their headers as one text of sorted lines."""
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return resolve_revisits(records).withColumn("headers", F.array_join(lines, "\n"))
