"""Resolution of not-modified revisits in web archive records.

A revisit record (status 304) has no body of its own.  It is resolved to the
latest full response with the same canonical URL that is strictly earlier,
if the validators agree, and gets that response's body reference and its
headers updated by the revisit's permitted ones.

The as-of join is one sorted sweep per (URL, time slice): responses and
revisits together, the last response carried forward.  Slices are cut at
quantiles of the capture times, so a URL with a third of all records is
spread over ``slices`` tasks; the last response of every earlier slice enters
a slice as its first event, from a table with one row per (URL, slice).

Validators: entity tags are compared without the weakness mark; without an
entity tag in the revisit, Last-Modified must be equal; a revisit with
neither is resolved only if the response has neither.  Headers that a 304 may
not update (length, type, encoding and range of the content, hop-by-hop
fields) stay as stored.

Status of a revisit: ``resolved``, ``validator_mismatch`` or ``no_earlier``.

Defined cases: several responses of one URL and time: the largest record_id
counts; a response at the revisit's own time is not earlier; records with a
null URL or null time are no sources, and as revisits are ``no_earlier``;
null headers count as none; header names are compared in lower case; other
record types and other columns are ignored; repeated rows are resolved each;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fields of a 304 that do not update a stored response (fixed values).
NOT_UPDATED = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade",
)
#: Query parameters that do not change the resource.
TRACKING = r"^(utm_[a-z]+|gclid|fbclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without a
    trailing slash, query sorted and without tracking parameters; no scheme,
    no fragment."""
    rest = F.regexp_replace(F.regexp_replace(url, r"(?s)#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"(?s)^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"(?s)\?(.*)$", 1)
    parts = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.array_join(F.sort_array(parts), "&")
    return F.concat(host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def _lower_keys(headers: Column) -> Column:
    # names that differ in case only: the first in order wins
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    entries = F.coalesce(entries, F.array().cast("array<struct<key:string,value:string>>"))
    first = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, F.lit(1), i), lambda x: x["key"] == e["key"]))
    return F.map_from_entries(first)


def merged_headers(stored: Column, update: Column) -> Column:
    """Stored headers updated by the permitted ones of a 304."""
    allowed = F.map_filter(update, lambda k, v: ~k.isin(*NOT_UPDATED))
    kept = F.map_filter(stored, lambda k, v: ~F.map_contains_key(allowed, k))
    return F.map_concat(kept, allowed)


def validators_agree(stored: Column, revisit: Column) -> Column:
    def field(headers: Column, name: str) -> Column:
        return F.try_element_at(headers, F.lit(name))

    def tag(headers: Column) -> Column:
        return F.regexp_replace(field(headers, "etag"), "^W/", "")

    same_tag = F.coalesce(tag(revisit) == tag(stored), F.lit(False))
    same_date = F.coalesce(field(revisit, "last-modified") == field(stored, "last-modified"), F.lit(False))
    neither = field(stored, "etag").isNull() & field(stored, "last-modified").isNull()
    return F.when(tag(revisit).isNotNull(), same_tag).when(field(revisit, "last-modified").isNotNull(), same_date).otherwise(neither)


def resolve_revisits(records: DataFrame, slices: int = 128) -> DataFrame:
    """One row per revisit: record_id, url (canonical), time, status,
    source_id, payload_digest, headers.

    ``records`` has record_id, uri, time (long), record_type, http_status,
    headers (map) and payload_digest.
    """
    r = records.select(
        "record_id",
        canonical_url(F.col("uri")).alias("url"),
        F.col("time").cast("long").alias("time"),
        ((F.col("record_type") == "response") & (F.col("http_status") == 200)).alias("full"),
        ((F.col("record_type") == "revisit") & (F.col("http_status") == 304)).alias("revisit"),
        _lower_keys(F.col("headers")).alias("headers"),
        "payload_digest",
    ).filter("full OR revisit")
    placed = r.filter("url IS NOT NULL AND time IS NOT NULL")
    cuts = placed.agg(F.percentile_approx("time", [i / slices for i in range(1, slices)], 10_000)).first()[0] or []
    bounds = F.array(*[F.lit(int(c)) for c in sorted(set(cuts))]).cast("array<bigint>")  # at most `slices` numbers
    placed = placed.withColumn("slice", F.size(F.filter(bounds, lambda c: c <= F.col("time"))))
    source = F.when(F.col("full"), F.struct("record_id", "headers", "payload_digest"))
    events = placed.select(
        "url", "slice", "time", F.col("full").cast("int").alias("kind"), "record_id", "headers", source.alias("source")
    )
    lasts = events.filter("kind = 1").groupBy("url", "slice").agg(F.max_by("source", F.struct("time", "record_id")).alias("last"))
    seen = events.select("url", "slice").distinct().join(lasts, ["url", "slice"], "left")
    before = Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = seen.select(
        "url",
        "slice",
        F.lit(None).cast("long").alias("time"),
        F.lit(1).alias("kind"),
        F.lit(None).cast(r.schema["record_id"].dataType).alias("record_id"),
        F.lit(None).cast(r.schema["headers"].dataType).alias("headers"),
        F.last("last", ignorenulls=True).over(before).alias("source"),
    ).filter(F.col("source").isNotNull())
    # at one time revisits stand before responses, so a source is earlier
    sweep = Window.partitionBy("url", "slice").orderBy(F.col("time").asc_nulls_first(), "kind", "record_id")
    swept = events.unionByName(carried).withColumn(
        "found", F.last("source", ignorenulls=True).over(sweep.rowsBetween(Window.unboundedPreceding, 0))
    )
    out = swept.filter("kind = 0").select("record_id", "url", "time", "headers", "found")
    lost = r.filter("revisit AND (url IS NULL OR time IS NULL)").select(
        "record_id", "url", "time", "headers", F.lit(None).cast(out.schema["found"].dataType).alias("found")
    )
    out = out.unionByName(lost).withColumn("_ok", F.col("found").isNotNull() & validators_agree(F.col("found.headers"), F.col("headers")))
    status = F.when(F.col("found").isNull(), "no_earlier").when(F.col("_ok"), "resolved").otherwise("validator_mismatch")
    return out.select(
        "record_id",
        "url",
        "time",
        status.alias("status"),
        F.when(F.col("_ok"), F.col("found.record_id")).alias("source_id"),
        F.when(F.col("_ok"), F.col("found.payload_digest")).alias("payload_digest"),
        F.when(F.col("_ok"), merged_headers(F.col("found.headers"), F.col("headers"))).alias("headers"),
    )
