"""Not-modified revisits: each gets the latest earlier full response of its canonical URL.

The as-of join works on (key, time, kind, id) rows alone. They are dealt out by
ranges of that order, so that a URL with very many captures spans several
blocks. Within a block a running maximum finds the latest response; one row per
URL and block carries it on to the URL's later blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.store import stored

#: Headers that a 304 response may update in the stored one.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that do not name another page.
TRACKING = r"utm_[^=]*|gclid|fbclid|ref"


def canonical_url(url: Column) -> Column:
    """One form of the URLs of a page; null stays null.

    Scheme, fragment, a leading ``www.``, default ports, slashes at the end and
    tracking parameters go, the host is lower-cased, parameters are sorted.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"(?s)#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"(?s)^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"(?s)^[^?]*\?(.*)$", 1)
    parts = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(rf"^({TRACKING})(=|$)"))
    tail = F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(parts), "&")))
    return F.concat(host, path, F.coalesce(tail, F.lit("")))


def latest_earlier(records: DataFrame) -> DataFrame:
    """``id, response``: for each revisit the latest response with an earlier time, null if none.

    ``records`` has ``key, time (long), id (long), full (boolean)``. Of responses
    of one time the greatest id counts; one of the revisit's own time is not
    earlier. Null keys or times match nothing. Repeated rows are repeated.
    """
    order = ["key", "time", "full", "id"]
    ranged = records.where("key is not null and time is not null").repartitionByRange(*order)
    dealt = stored(ranged.withColumn("block", F.spark_partition_id()))
    response = F.when(F.col("full"), F.struct("time", "id"))
    inside = Window.partitionBy("key", "block").orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = dealt.groupBy("key", "block").agg(F.max(response).alias("last"))
    carried = (
        ends.withColumn("carried", F.max("last").over(before)).where("carried is not null").drop("last")
    )
    found = (
        dealt.withColumn("own", F.max(response).over(inside))
        .where(~F.col("full"))
        .join(carried, ["key", "block"], "left")
        .select("id", F.coalesce("own.id", "carried.id").alias("response"))
    )
    lost = records.where("not full and (key is null or time is null)").select(
        "id", F.lit(None).cast("long").alias("response")
    )
    return found.union(lost)


def _weak(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), r"^W/", "")


def validators_agree(revisit: Column, response: Column) -> Column:
    """Whether a 304's validators fit the stored headers.

    Entity tags are compared where both have one (as weak ones if either is
    weak), otherwise modification dates; a 304 or a response without a
    validator in common has nothing that speaks against it.
    """
    tag, stored_tag = F.try_element_at(revisit, F.lit("etag")), F.try_element_at(response, F.lit("etag"))
    date = F.try_element_at(revisit, F.lit("last-modified"))
    stored_date = F.try_element_at(response, F.lit("last-modified"))
    return (
        F.when(tag.isNotNull() & stored_tag.isNotNull(), _weak(tag) == _weak(stored_tag))
        .when(date.isNotNull() & stored_date.isNotNull(), date == stored_date)
        .otherwise(True)
    )


def merged_headers(revisit: Column, response: Column) -> Column:
    """The response's headers, updated by those that a 304 may change."""
    permitted = F.array(*map(F.lit, PERMITTED))
    fresh = F.map_filter(revisit, lambda k, v: F.array_contains(permitted, k) & v.isNotNull())
    kept = F.map_filter(response, lambda k, v: ~F.array_contains(F.map_keys(fresh), k))
    return F.map_concat(kept, fresh)


def resolve_revisits(
    records: DataFrame,
    identity: str = "record_id",
    url: str = "url",
    time: str = "time",
    kind: str = "kind",
    headers: str = "headers",
) -> DataFrame:
    """Per revisit: ``record_id, key, time, response_id, verdict, headers``.

    ``kind`` is ``response`` or ``revisit`` (other and null kinds are not
    looked at), ``time`` a long or a timestamp, ``headers`` a map with names in
    lower case (null: none). ``verdict`` is ``resolved``, ``no_response`` or
    ``mismatch``; only resolved rows have the merged headers, the others
    their own. Ids are unique among responses. Extra columns are not read, so
    payloads stay where they are: join ``response_id`` with them. An empty
    table gives an empty one.
    """
    clock = F.unix_micros(time) if records.schema[time].dataType.typeName() == "timestamp" else F.col(time).cast("long")
    rows = stored(
        records.where(F.col(kind).isin("response", "revisit")).select(
            F.col(identity).cast("long").alias("id"),
            canonical_url(F.col(url)).alias("key"),
            clock.alias("time"),
            (F.col(kind) == "response").alias("full"),
            F.coalesce(F.col(headers), F.create_map().cast("map<string,string>")).alias("headers"),
        )
    )
    found = latest_earlier(rows.select("key", "time", "id", "full")).distinct()
    responses = rows.where("full").select(F.col("id").alias("response"), F.col("headers").alias("stored"))
    joined = rows.where("not full").join(found, "id", "left").join(responses, "response", "left")
    agrees = validators_agree(F.col("headers"), F.col("stored"))
    verdict = (
        F.when(F.col("response").isNull(), "no_response").when(agrees, "resolved").otherwise("mismatch")
    )
    merged = F.when(verdict == "resolved", merged_headers(F.col("headers"), F.col("stored")))
    return joined.select(
        F.col("id").alias("record_id"),
        "key",
        "time",
        F.col("response").alias("response_id"),
        verdict.alias("verdict"),
        F.coalesce(merged, F.col("headers")).alias("headers"),
    )
