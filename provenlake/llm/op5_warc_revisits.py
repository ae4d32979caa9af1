"""Not-modified revisits resolved by an as-of join on the canonical URL.

A revisit (a 304 answer) stands for the latest earlier full response of its
canonical URL.  It is resolved when its validators agree with that response, and
then carries the response's headers with those replaced that a 304 may change.

Responses and revisits are sorted together by range of (URL, time), so the captures
of one URL may span many tasks; each task carries its last response inside the range,
and one summary row per range carries it across.  Bodies take no part: a resolved
revisit names the record that holds its body.

Defined cases: a revisit without a URL or a time is ``no_url`` or ``no_time``; without
an earlier full response ``no_response``.  A response at the very time of the revisit is
not earlier; of responses at one time the largest record id counts.  An entity tag decides
alone when both sides have one (weak comparison); else the modification dates must be
equal; without a common validator the revisit is ``no_validator``, on difference
``changed``.  Repeated rows are resolved each by itself.  Header names are compared in lower
case; null headers count as none.  An empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged

#: The headers that a 304 answer carries for the stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that do not change the resource.
TRACKING = r"^(utm_[a-z]+|ref|gclid|fbclid|sessionid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without closing slashes, sorted query without tracking, no fragment."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    rest = F.regexp_replace(plain, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.array_join(
        F.array_sort(F.filter(F.split(F.regexp_extract(rest, "^[^?]*[?](.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&"
    )
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def _lower_keys(headers: Column) -> Column:
    """Headers by lower-case name; of names that differ in case only the smallest spelling stands."""
    entries = F.array_sort(F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>")))
    names = F.transform(entries, lambda e: F.lower(e["key"]))
    first = F.filter(entries, lambda e, i: F.array_position(names, F.lower(e["key"])) == i + 1)
    return F.map_from_entries(F.transform(first, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))


def _strong(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def merged_headers(stored: Column, answer: Column) -> Column:
    """The stored headers with those of ``PERMITTED`` that the answer has, sorted by name."""
    fresh = F.map_filter(answer, lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter(stored, lambda k, v: ~F.coalesce(F.map_contains_key(fresh, k), F.lit(False)))
    return F.map_from_entries(F.array_sort(F.concat(F.map_entries(kept), F.map_entries(fresh))))


def _captures(records: DataFrame) -> DataFrame:
    revisit = F.col("warc_type") == "revisit"
    headers = _lower_keys(F.col("headers"))
    return records.where(revisit | ((F.col("warc_type") == "response") & (F.col("status") == 200))).select(
        F.col("record_id"), F.col("ts"), canonical_url(F.col("url")).alias("url"), F.when(revisit, 0).otherwise(1).alias("kind"), headers.alias("headers")
    )


def _last_before(captures: DataFrame) -> DataFrame:
    """Revisits with ``found``: the latest response of the same URL before them."""
    order = ["url", "ts", "kind", "record_id"]
    response = F.when(F.col("kind") == 1, F.struct("ts", "record_id", "headers"))
    placed = captures.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    placed = staged(placed, "captures")
    inside = Window.partitionBy("_part", "url").orderBy("ts", "kind", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    seen = placed.withColumn("_own", F.last(response, ignorenulls=True).over(inside)).where("kind = 0")

    # Only the first and last URL of a range can continue elsewhere, so both broadcasts hold at most two rows per range.
    edges = placed.groupBy("_part").agg(F.min("url").alias("a"), F.max("url").alias("b"))
    shared = edges.select(F.explode(F.array("a", "b")).alias("url")).groupBy("url").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("url")
    pieces = placed.where("kind = 1").join(F.broadcast(shared), "url").groupBy("_part", "url").agg(
        F.max_by(F.struct("ts", "record_id", "headers"), F.struct("ts", "record_id")).alias("_piece")
    )
    ends = edges.select("_part", F.explode(F.array_distinct(F.array("a", "b"))).alias("url")).join(F.broadcast(shared), "url")
    earlier = Window.partitionBy("url").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ends.join(pieces, ["_part", "url"], "left").withColumn("_carry", F.last("_piece", ignorenulls=True).over(earlier))
        .where("_carry IS NOT NULL").select("_part", "url", "_carry")
    )
    return seen.join(F.broadcast(carried), ["_part", "url"], "left").select(
        "record_id", "url", "ts", "headers", F.coalesce("_own", "_carry").alias("found")
    )


def resolve_revisits(records: DataFrame) -> DataFrame:
    """(record_id, url, ts, state, refers_to, headers) of every revisit of ``records``.

    ``records`` has record_id, warc_type, url, ts, status and headers (a string map);
    record ids and times are of any ordered type.
    """
    captures = _captures(records)
    usable = F.col("url").isNotNull() & F.col("ts").isNotNull()
    judged = _last_before(captures.where(usable))
    stored, answer = F.col("found.headers"), F.col("headers")
    tag, stored_tag = _strong(F.get(F.array(answer["etag"]), 0)), _strong(F.get(F.array(stored["etag"]), 0))
    date, stored_date = answer["last-modified"], stored["last-modified"]
    by_tag, by_date = tag.isNotNull() & stored_tag.isNotNull(), date.isNotNull() & stored_date.isNotNull()
    state = (
        F.when(F.col("found").isNull(), "no_response")
        .when(by_tag, F.when(tag == stored_tag, "resolved").otherwise("changed"))
        .when(by_date, F.when(date == stored_date, "resolved").otherwise("changed"))
        .otherwise("no_validator")
    )
    done = F.col("state") == "resolved"
    resolved = judged.withColumn("state", state).select(
        "record_id", "url", "ts", "state", F.when(done, F.col("found.record_id")).alias("refers_to"),
        F.when(done, merged_headers(stored, answer)).otherwise(answer).alias("headers"),
    )
    lost = captures.where((F.col("kind") == 0) & ~usable).select(
        "record_id", "url", "ts", F.when(F.col("url").isNull(), "no_url").otherwise("no_time").alias("state"),
        F.lit(None).cast(captures.schema["record_id"].dataType).alias("refers_to"), "headers",
    )
    return resolved.unionByName(lost)
