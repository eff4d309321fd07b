"""Resolution of not-modified revisit records in web archives (operator 5).

A revisit with status 304 has no body. It is joined as of its time to the latest earlier full
response (status 200) for the same canonical URL; validators decide whether that response may
stand in: equal entity tags if both have one, else equal modification dates if both have one.
The headers that a 304 may update are merged over those of the response.

The as-of join is split in time: inside a slot of `SLOT_SECONDS` a window looks back; where the
slot has no earlier response, the latest one of an earlier slot is carried in from a summary with
one row per URL and slot. A URL with a third of all records thus spreads over its slots. Bodies
take no part in it; they are joined by record id at the end.

Defined cases: a revisit without URL, time or id, or without an earlier response, is returned
unresolved; a null header map is an empty one, header names are compared in lower case and blank
values count as missing; of responses at one time the one with the largest id is latest, and a
response at the very time of the revisit is not earlier; repeated revisits are each returned; an
empty table gives an empty result; other columns are ignored. Record ids of responses must be
unique; of repeated ones the first body by its bytes is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SLOT_SECONDS = 86_400
FULL, NOT_MODIFIED = 200, 304
# The header fields that a 304 response may update.
UPDATABLE = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_url(url: Column) -> Column:
    """Host in lower case without default port, path, and query parameters in order; no scheme or fragment."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    rest = F.regexp_replace(plain, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^([^/?]*)", 1))
    host = F.regexp_replace(host, ":(80|443)$", "")
    path = F.regexp_extract(rest, "^[^/?]*([^?]*)", 1)
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    ordered = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda part: part != "")), "&")
    return F.concat(host, F.when(path == "", "/").otherwise(path), F.when(ordered == "", "").otherwise(F.concat(F.lit("?"), ordered)))


def lower_headers(headers: Column) -> Column:
    """Header names in lower case; of two names that become equal, the last one counts."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value")))
    merged = F.aggregate(
        entries, F.create_map().cast("map<string,string>"),
        lambda found, e: F.map_concat(F.map_filter(found, lambda k, v: k != e["key"]), F.create_map(e["key"], e["value"])))
    return F.coalesce(merged, F.create_map().cast("map<string,string>"))


def validator(headers: Column, name: str) -> Column:
    value = F.trim(headers[name])
    if name == "etag":
        value = F.regexp_replace(value, "^W/", "")  # tags are compared weakly
    return F.when(value != "", value)


def match_revisits(records: DataFrame, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """One row per 304 revisit: its id, URL, time, the response found, an outcome and merged headers.

    `records` has record_id, kind ('response' or 'revisit'), url, at (seconds), status and headers.
    """
    named = records.select(
        F.col("record_id").cast("long").alias("record_id"), "kind", "url", F.col("at").cast("long").alias("at"), "status",
        lower_headers(F.col("headers")).alias("headers"), canonical_url(F.col("url")).alias("canonical"))
    response = (F.col("kind") == "response") & (F.col("status") == FULL)
    revisit = (F.col("kind") == "revisit") & (F.col("status") == NOT_MODIFIED)
    usable = F.col("canonical").isNotNull() & F.col("at").isNotNull() & F.col("record_id").isNotNull()
    known = named.where((response | revisit) & usable).withColumn("slot", F.floor(F.col("at") / slot_seconds))
    full = F.when(response, F.struct("at", "record_id", "headers"))

    inside = Window.partitionBy("canonical", "slot").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    # a map cannot be ordered, so the latest is taken by (time, id)
    here = known.withColumn("found", F.max_by(full, F.when(response, F.struct("at", "record_id"))).over(inside)).where(revisit)
    latest = known.where(response).groupBy("canonical", "slot").agg(F.max_by(full, F.struct("at", "record_id")).alias("latest"))
    slots = known.select("canonical", "slot").distinct().join(latest, ["canonical", "slot"], "left")
    earlier = Window.partitionBy("canonical").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.select("canonical", "slot", F.last("latest", ignorenulls=True).over(earlier).alias("carried"))
    found = here.join(carried, ["canonical", "slot"], "left").withColumn("found", F.coalesce("found", "carried"))

    old, new = F.col("found.headers"), F.col("headers")
    tags = [validator(h, "etag") for h in (old, new)]
    dates = [validator(h, "last-modified") for h in (old, new)]
    outcome = (
        F.when(F.col("found").isNull(), "no_response")
        .when(tags[0].isNotNull() & tags[1].isNotNull(), F.when(tags[0] == tags[1], "resolved").otherwise("changed"))
        .when(dates[0].isNotNull() & dates[1].isNotNull(), F.when(dates[0] == dates[1], "resolved").otherwise("changed"))
        .otherwise("unverified")
    )
    updates = F.map_filter(new, lambda k, v: k.isin(*UPDATABLE) & v.isNotNull())
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(updates, k)), updates)
    done = found.withColumn("outcome", outcome).select(
        "record_id", "url", "canonical", "at", F.col("found.record_id").alias("response_id"), F.col("found.at").alias("response_at"),
        "outcome", F.when(F.col("outcome") == "resolved", merged).alias("headers"))
    lost = named.where(revisit & ~usable).select("record_id", "url", "canonical", "at", F.lit(None).cast("long").alias("response_id"),
                             F.lit(None).cast("long").alias("response_at"), F.lit("no_response").alias("outcome"),
                             F.lit(None).cast("map<string,string>").alias("headers"))
    return done.unionByName(lost)


def resolve_revisits(records: DataFrame, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """`match_revisits` with the body of the response where the revisit is resolved."""
    matched = match_revisits(records, slot_seconds)
    bodies = records.where((F.col("kind") == "response") & (F.col("status") == FULL)).groupBy(
        F.col("record_id").cast("long").alias("response_id")).agg(F.min("body").alias("body"))
    return matched.join(bodies, "response_id", "left").withColumn("body", F.when(F.col("outcome") == "resolved", F.col("body")))


def records_from_pages(pages: DataFrame) -> DataFrame:
    """Archive records of a table of pages: a full response per page, and two later revisits.

    The first revisit spells the URL differently; every fifth page changed in between, every
    seventh sends no tag but a date. Times repeat over pages of one URL.
    """
    at = F.lit(1_700_000_000) + F.pmod(F.col("page_id") * 7_919, F.lit(2_592_000))
    tag = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 16), F.lit('"'))
    date = F.concat(F.lit("day "), F.pmod("page_id", F.lit(400)).cast("string"))
    no_tag = F.pmod("page_id", F.lit(7)) == 0
    full = pages.select(
        (F.col("page_id") * 3).alias("record_id"), F.lit("response").alias("kind"), "url", at.alias("at"), F.lit(FULL).alias("status"),
        F.create_map(F.lit("ETag"), F.when(no_tag, "").otherwise(tag), F.lit("Last-Modified"), date, F.lit("Content-Type"),
                     F.lit("text/html"), F.lit("Expires"), F.lit("never")).alias("headers"), F.col("html").alias("body"))
    out = full
    for k in (1, 2):
        changed = (F.pmod("page_id", F.lit(5)) == 0) & F.lit(k == 2)
        spelled = F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again")) if k == 1 else F.col("url")
        sent = F.when(no_tag, "").when(changed, '"new"').otherwise(F.concat(F.lit("W/"), tag))
        out = out.unionByName(pages.select(
            (F.col("page_id") * 3 + k).alias("record_id"), F.lit("revisit").alias("kind"), spelled.alias("url"),
            (at + k * 3_600 * (1 + F.pmod("page_id", F.lit(48)))).alias("at"), F.lit(NOT_MODIFIED).alias("status"),
            F.create_map(F.lit("etag"), sent, F.lit("Last-Modified"), F.when(changed, "later").otherwise(date), F.lit("Content-Type"),
                         F.lit("none"), F.lit("EXPIRES"), F.lit("soon")).alias("headers"), F.lit(None).cast("string").alias("body")))
    return out
