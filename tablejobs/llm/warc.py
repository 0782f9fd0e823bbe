"""Not-modified revisits of a web archive, resolved to the full responses they stand for.

A revisit record has no payload: the server said that nothing changed since an earlier response. It is resolved by an
as-of join on the canonical URL to the latest full response before it; validators are compared, and the headers that a
not-modified answer may change are merged into those of the response.

The as-of join carries ids and times only. Time is cut into slices of like numbers of records, and windows run over
(URL, slice), so a URL with very many captures is spread over its slices; what an earlier slice ended with comes from one
row for each URL and slice. Payloads are joined by the id found.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_RECORDS = 1_000_000
# Headers that a not-modified answer may change, and parameters that name no resource.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "warning")
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid", "ref")


def canonical_url(url: Column, tracking: tuple[str, ...] = TRACKING) -> Column:
    """Host in lower case without `www.` and default ports, path without a last slash, other parameters in order.

    Scheme, fragment and tracking parameters go. NULL stays NULL.
    """
    rest = F.regexp_replace(F.trim(url), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    plain = F.substring_index(rest, "#", 1)
    base = F.substring_index(plain, "?", 1)
    raw_host = F.substring_index(base, "/", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(raw_host), "^www\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.substr(base, F.length(raw_host) + 1), "/+$", "")
    query = F.when(F.contains(plain, F.lit("?")), F.substr(plain, F.length(base) + 2)).otherwise("")
    fields = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).isin(*tracking))
    kept = F.array_join(F.array_sort(fields), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def _same(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), a == b)


def earlier_response(records: DataFrame, slice_records: int = SLICE_RECORDS) -> DataFrame:
    """(record_id, response_id) of every revisit with a URL and a time: the latest response of a smaller time, or NULL.

    Of several responses at one time the one with the largest id counts.
    """
    known = records.filter("canonical is not null and time is not null")
    ticks = F.unix_micros(F.col("time").cast("timestamp"))
    responses = known.filter("warc_type = 'response'").groupBy("canonical", ticks.alias("at")).agg(F.max("record_id").alias("response_id"))
    revisits = known.filter("warc_type = 'revisit'").select("canonical", ticks.alias("at"), "record_id")
    none = F.lit(None).cast(known.schema["record_id"].dataType)
    both = responses.select("canonical", "at", none.alias("record_id"), "response_id").unionByName(
        revisits.withColumn("response_id", none)
    )
    n = max(1, math.ceil(known.count() / slice_records))
    bounds = None
    if n > 1:
        bounds = known.agg(F.percentile_approx(ticks, [i / n for i in range(1, n)], 10 * n)).first()[0]
    cut = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("at"))) if bounds else F.lit(0)
    mark = F.when(F.col("response_id").isNotNull(), F.struct("at", "response_id"))
    both = both.withColumns({"slice": cut, "mark": mark})
    # At one time revisits come first: only a smaller time is earlier.
    order = [F.col("at"), F.col("response_id").isNotNull()]
    inside = Window.partitionBy("canonical", "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    here = both.withColumn("here", F.last("mark", ignorenulls=True).over(inside)).filter("record_id is not null")
    before = Window.partitionBy("canonical").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = both.groupBy("canonical", "slice").agg(F.max("mark").alias("end"))
    ends = ends.withColumn("before", F.last("end", ignorenulls=True).over(before)).drop("end")
    found = here.join(ends, ["canonical", "slice"], "left")
    return found.select("record_id", F.coalesce("here", "before")["response_id"].alias("response_id"))


def resolve(records: DataFrame, slice_records: int = SLICE_RECORDS) -> DataFrame:
    """Every record as (record_id, canonical, warc_type, time, status, resolved_from, headers, payload).

    `records` has record_id (unique), url, warc_type, time, etag, last_modified, digest, headers (a map with names in lower case)
    and payload; other columns are left out. A response has status `full`. A revisit is

    * `missing` without an earlier response (or without a URL or a time), with its own headers and no payload;
    * `mismatch` if validators differ, likewise: entity tags if both records have them (weak ones count like strong ones),
      else times of the last change, else digests;
    * `unchecked` if no validator is in both records, `resolved` if it is the same: payload and headers of the response,
      with PERMITTED headers of the revisit put over them.

    Records of other types are left out. NULL headers count as none; of repeated responses one row is taken.
    """
    columns = ["record_id", "url", "warc_type", "time", "etag", "last_modified", "digest", "headers", "payload"]
    own = records.select(*columns).withColumn("canonical", canonical_url(F.col("url")))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    own = own.withColumn("headers", F.coalesce("headers", empty))
    responses = own.filter("warc_type = 'response'")
    names = ("record_id", "etag", "last_modified", "digest", "headers", "payload")
    targets = responses.select(*[F.col(c).alias(f"of_{c}") for c in names]).dropDuplicates(["of_record_id"])
    pairs = earlier_response(own, slice_records).dropDuplicates(["record_id"])
    revisits = own.filter("warc_type = 'revisit'").drop("payload").join(pairs, "record_id", "left")
    joined = revisits.join(targets, F.col("response_id") == F.col("of_record_id"), "left")
    strong = lambda c: F.regexp_replace(c, "^W/", "")
    agree = F.coalesce(
        _same(strong("etag"), strong("of_etag")),
        _same(F.col("last_modified"), F.col("of_last_modified")),
        _same(F.col("digest"), F.col("of_digest")),
    )
    status = (
        F.when(F.col("of_record_id").isNull(), "missing").when(agree.isNull(), "unchecked").when(agree, "resolved").otherwise("mismatch")
    )
    good = F.col("status").isin("unchecked", "resolved")
    new = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    old = F.map_filter("of_headers", lambda k, _: ~F.array_contains(F.map_keys(new), k))
    resolved = joined.withColumn("status", status).select(
        "record_id",
        "canonical",
        "warc_type",
        "time",
        "status",
        F.when(good, F.col("of_record_id")).alias("resolved_from"),
        F.when(good, F.map_concat(old, new)).otherwise(F.col("headers")).alias("headers"),
        F.when(good, F.col("of_payload")).alias("payload"),
    )
    full = responses.select(
        "record_id",
        "canonical",
        "warc_type",
        "time",
        F.lit("full").alias("status"),
        F.lit(None).cast(own.schema["record_id"].dataType).alias("resolved_from"),
        "headers",
        "payload",
    )
    return full.unionByName(resolved)
