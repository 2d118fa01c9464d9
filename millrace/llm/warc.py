"""Resolution of not-modified revisits in web archives.

A revisit record says that a page had not changed; its content is that of the latest earlier full
response for the same canonical URL. Records are sorted by (URL, time) into ranges of bounded size, each
range looks back within itself, and the URL that a range begins with also looks at the ranges before, so
a URL with a third of all records is no single sort. The validators of the revisit must agree with
those of the response found; the headers that a not-modified reply may renew are then merged over it.

Defined cases: a record without URL is ``no_url``; a revisit without earlier full response is
``no_earlier_response``; one whose validators disagree is ``validator_mismatch``; one that has none is
``no_validator``. Only responses that are strictly earlier count; of several at the same time the greatest
record id wins. A response with null payload is no full response (``no_payload``). Null time sorts first and
finds nothing. Header names compare without case, the last of equal names counts, a null map is empty. Repeated records
resolve each for themselves. Payloads of any length are hashed whole and not carried on. An empty table gives no rows. Columns other
than those named are not read. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialize

SLICE_ROWS = 16_384
# Beyond so many slices they get longer instead; a slice is sorted and read through, never held.
MAX_SLICES = 20_000
# The headers that a not-modified reply carries for the stored response, by the HTTP standard.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
# Query parameters that do not select content.
TRACKING = "utm_source utm_medium utm_campaign utm_term utm_content gclid fbclid".split()


def canonical_url(url: Column) -> Column:
    """Host in lower case without www and default port, path without trailing slash, sorted parameters; no scheme, no fragment."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), "^[A-Za-z][A-Za-z0-9+.-]*://", ""), "#.*$", "")
    host = F.lower(F.regexp_extract(rest, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, "^www[0-9]*[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(rest, "^[^?]*[?](.*)$", 1)
    kept = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(F.split_part(p, F.lit("="), F.lit(1))).isin(TRACKING))
    )
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def plain_headers(headers: Column) -> Column:
    """Header names in lower case; of equal names the last counts."""
    entries = F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>"))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    return F.map_from_arrays(
        names, F.transform(names, lambda n: F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == n), -1)["value"])
    )


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored headers, with those that may be renewed taken from the revisit."""
    renewed = F.map_filter(fresh, lambda k, v: k.isin(PERMITTED) & v.isNotNull())
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(renewed, k)), renewed)


def _tag(headers: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(headers["etag"], "^W/", "")


def resolve_revisits(records: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """record_id, url, captured_at, outcome, response_id, payload_digest, payload_bytes, headers.

    ``records``: record_id, kind ('response' or 'revisit'), url, captured_at (ordered type), status, headers (map of
    strings), payload. The payload itself stays where it is: ``response_id`` names the record that has it.
    """
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("payload").isNotNull()
    slim = records.select(
        "record_id",
        F.coalesce(F.col("kind") == "revisit", F.lit(False)).alias("revisit"),
        F.coalesce(full, F.lit(False)).alias("full"),
        canonical_url(F.col("url")).alias("url"),
        "captured_at",
        plain_headers(F.col("headers")).alias("headers"),
        F.md5("payload").alias("payload_digest"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
    )
    rows = materialize(slim, "captures")
    slices = min(MAX_SLICES, max(1, -(-rows.count() // slice_rows)))
    order = ["url", "captured_at", F.col("revisit").desc(), "record_id"]
    ranged = rows.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    seen = F.when(F.col("full"), F.struct("record_id", "captured_at", "headers", "payload_digest", "payload_bytes"))
    ranged = ranged.withColumn("_seen", seen)
    # What a slice hands on: the last full response of the URL it ends with. One row per slice.
    ends = ranged.groupBy("_slice").agg(F.min("url").alias("_first"), F.max("url").alias("_last"))
    last = ranged.where("full").groupBy("_slice", "url").agg(F.max_by("_seen", F.struct("captured_at", "record_id")).alias("_end"))
    ends = ends.join(last.withColumnsRenamed({"_slice": "_s", "url": "_u"}), (F.col("_slice") == F.col("_s")) & (F.col("_last") == F.col("_u")), "left")
    ends = materialize(ends.select("_slice", "_first", "_last", "_end"), "ends")
    # A URL reaches a slice from earlier ones only if it is the first there and the last of each of those.
    handed = ends.where("_last is not null").select(F.col("_last").alias("_u"), F.col("_slice").alias("_from"), "_end", F.lit(0).alias("_ask"))
    asked = ends.where("_first is not null").select(
        F.col("_first").alias("_u"), F.col("_slice").alias("_from"), F.lit(None).cast(ends.schema["_end"].dataType).alias("_end"), F.lit(1).alias("_ask")
    )
    before = Window.partitionBy("_u").orderBy("_from", F.col("_ask").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = handed.unionByName(asked).withColumn("_carried", F.last("_end", ignorenulls=True).over(before))
    carried = carried.where((F.col("_ask") == 1) & F.col("_carried").isNotNull()).select("_u", F.col("_from").alias("_s"), "_carried")
    within = Window.partitionBy("_slice", "url").orderBy("captured_at", F.col("revisit").desc(), "record_id").rowsBetween(Window.unboundedPreceding, -1)
    found = ranged.withColumn("_here", F.last("_seen", ignorenulls=True).over(within))
    found = found.join(carried, (F.col("_slice") == F.col("_s")) & (F.col("url") == F.col("_u")), "left")
    old = F.coalesce("_here", "_carried")
    fresh, stored = F.col("headers"), old["headers"]
    by_tag = _tag(fresh) == _tag(stored)
    by_time = fresh["last-modified"] == stored["last-modified"]
    agrees = F.when(fresh["etag"].isNotNull(), F.coalesce(by_tag, F.lit(False))).when(
        fresh["last-modified"].isNotNull(), F.coalesce(by_time, F.lit(False))
    )
    outcome = (
        F.when(F.col("url").isNull(), "no_url")
        .when(~F.col("revisit"), F.when(F.col("full"), "full").otherwise("no_payload"))
        .when(old.isNull() | F.col("captured_at").isNull(), "no_earlier_response")
        .when(agrees.isNull(), "no_validator")
        .when(~agrees, "validator_mismatch")
        .otherwise("resolved")
    )
    found = found.withColumn("_old", old).withColumn("outcome", outcome)
    resolved, own = F.col("outcome") == "resolved", F.col("outcome") == "full"
    return found.select(
        "record_id",
        "url",
        "captured_at",
        "outcome",
        F.when(resolved, F.col("_old.record_id")).when(own, F.col("record_id")).alias("response_id"),
        F.when(resolved, F.col("_old.payload_digest")).when(own, F.col("payload_digest")).alias("payload_digest"),
        F.when(resolved, F.col("_old.payload_bytes")).when(own, F.col("payload_bytes")).alias("payload_bytes"),
        F.when(resolved, merged_headers(F.col("_old.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"),
    )
