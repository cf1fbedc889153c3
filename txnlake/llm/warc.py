"""Not-modified revisits of web archives, resolved to earlier full responses.

A revisit record says that a page had not changed and carries headers but no body. It is
resolved by an as-of join: the latest full response with the same canonical URL
before it. The validators decide whether the response is the one meant: if both have an
ETag these must be equal (weakly), else if both have a Last-Modified date these must be
equal, else the match is unchecked. Headers of the revisit that a not-modified answer may renew
are merged over those of the response.

Captures are range-partitioned by URL, time and id, so captures of one very
frequent URL are spread over many tasks; each task fills forward inside its own
range, and what a range needs from the ranges before it comes from a table with one row
per range.

Order: time, then responses before revisits of the same time, then record_id; so of
responses at one time that with the larger id counts. Captures with a null URL or
time, and revisits without an earlier response, stay unresolved. Null header
maps are empty. Repeated rows are resolved alike. Header names are compared in lower case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlake.llm.tables import written

#: Headers that a not-modified answer renews.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical(url: Column) -> Column:
    """Scheme, a leading www., default ports, fragment, tracking parameters and a last slash do not matter; nor does letter case of the host."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[^/?]*", 0)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    asked = F.filter(F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|ref|fbclid|gclid)="))
    query = F.array_join(F.array_sort(asked), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def _lower(headers: Column) -> Column:
    pairs = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    # names that differ in letter case only: the last one counts
    return F.coalesce(F.aggregate(pairs, F.expr("cast(map() as map<string,string>)"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, v: k != e["key"]), F.map_from_entries(F.array(e)))), F.expr("cast(map() as map<string,string>)"))


def _etag(headers: Column) -> Column:
    return F.regexp_replace(F.trim(F.try_element_at(headers, F.lit("etag"))), "^W/", "")


def resolve(captures: DataFrame) -> DataFrame:
    """Revisits of captures (record_id, url, ts, kind, headers), each with its response.

    kind is 'response' or 'revisit'. Returns record_id, canonical_url, ts, response_id (null if none), response_ts,
    verdict ('etag', 'last-modified', 'unchecked', 'mismatch' or 'none') and headers: merged if the response
    holds, else the revisit's own.
    """
    rows = captures.where("kind in ('response', 'revisit')").select(
        "record_id", canonical(F.col("url")).alias("key"), "ts", (F.col("kind") == "revisit").alias("revisit"), _lower(F.col("headers")).alias("headers")
    )
    lone = rows.where("revisit and (key is null or ts is null)")
    order = ("key", "ts", "revisit", "record_id")
    ranged = rows.where("key is not null and ts is not null").repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "captures")

    found = F.struct(F.col("record_id").alias("id"), F.col("ts").alias("at"), F.col("headers").alias("headers"))
    own = F.when(~F.col("revisit"), found)
    place = F.struct("ts", "record_id")
    ends = written(
        ranged.groupBy("part").agg(F.min("key").alias("first_key"), F.max("key").alias("last_key")), "ends"
    )
    last = (
        ranged.join(ends.select("part", F.col("last_key").alias("key")), ["part", "key"])
        .where("not revisit").groupBy("part", "key").agg(F.max_by(found, place).alias("carried"))
    )
    # one row per range, not per capture: what the ranges before this one leave to its first URL
    carried = (
        ends.join(last.withColumnRenamed("key", "last_key"), ["part", "last_key"], "left")
        .withColumn("_left", F.last(F.struct("last_key", "carried"), ignorenulls=True).over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_full", F.last(F.when(F.col("carried").isNotNull(), F.struct("last_key", "carried")), ignorenulls=True).over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
        .where("_full.last_key = first_key and _left.last_key = first_key")
        .select("part", F.col("first_key").alias("key"), F.col("_full.carried").alias("carried"))
    )
    before = Window.partitionBy("part", "key").orderBy("ts", "revisit", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    filled = ranged.withColumn("inside", F.last(own, ignorenulls=True).over(before)).where("revisit")
    joined = filled.join(carried, ["part", "key"], "left").withColumn("response", F.coalesce("inside", "carried"))
    joined = joined.select("record_id", "key", "ts", "headers", "response").unionByName(
        lone.select("record_id", "key", "ts", "headers"), allowMissingColumns=True
    )

    theirs = F.col("response.headers")
    date = lambda h: F.try_element_at(h, F.lit("last-modified"))
    both = lambda f: f(F.col("headers")).isNotNull() & f(theirs).isNotNull()
    same = lambda f: f(F.col("headers")) == f(theirs)
    verdict = (
        F.when(F.col("response").isNull(), "none")
        .when(both(_etag), F.when(same(_etag), "etag").otherwise("mismatch"))
        .when(both(date), F.when(same(date), "last-modified").otherwise("mismatch"))
        .otherwise("unchecked")
    )
    renewed = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(theirs, lambda k, v: ~F.map_contains_key(renewed, k)), renewed)
    joined = joined.withColumn("verdict", verdict)
    holds = ~F.col("verdict").isin("none", "mismatch")
    return joined.select(
        "record_id",
        F.col("key").alias("canonical_url"),
        "ts",
        F.col("response.id").alias("response_id"),
        F.col("response.at").alias("response_ts"),
        "verdict",
        F.when(holds, merged).otherwise(F.col("headers")).alias("headers"),
    )
