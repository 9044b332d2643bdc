"""Not-modified revisits of web archives: an as-of join by canonical URL.

A revisit is matched with the latest earlier full response (status 200) of the
same canonical URL. Its validators are checked against that response: entity
tags by weak comparison if both have one, else Last-Modified if both have one,
and payload digests if both have one. If they agree, the record gets the
response's headers, updated by those headers a 304 may change.

The join is a forward fill: all records are range-partitioned by (URL, time), so
that one URL's records may lie in many partitions; each partition fills from its
own records, and what precedes a partition comes from one row per partition. No
URL, however frequent, is gathered in one task.

Records of other types, responses that are not full, and rows without a URL or
a time give no match; revisits among the latter are reported as ``no_response``.
Of responses at the same time the one with the largest id is the latest; a
response at the revisit's own time is not earlier. Null headers count as none;
names are compared without case, and the last of equal names holds. Repeated
rows are reported each. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Headers that a 304 response may update, and query parameters that name no page (fixed values).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
TRACKING = r"(?i)(^|&)(utm_[a-z]+|ref|fbclid|gclid|sessionid)=[^&]*"


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``, default port, fragment, tracking parameters and a last slash do not tell pages apart."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_replace(F.regexp_extract(bare, r"\?(.*)$", 1), TRACKING, "")
    query = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: p != "")), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def lower_names(headers: Column) -> Column:
    """A header map with lower-case names; of equal names the last holds."""
    entries = F.transform(
        F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x["key"] == e["key"]))
    return F.map_from_entries(last)


def agreement(revisit: str, response: str) -> Column:
    """True or false as the first kind of validator that both sides have says; null if there is none."""
    def tag(side):
        return F.regexp_replace(F.col(f"{side}.headers")["etag"], r"^W/", "")

    def when(side):
        return F.col(f"{side}.headers")["last-modified"]

    by_validator = F.coalesce(tag(revisit) == tag(response), when(revisit) == when(response))
    digest = F.col(f"{revisit}.digest") == F.col(f"{response}.digest")
    return F.when(by_validator.isNull(), digest).otherwise(by_validator & F.coalesce(digest, F.lit(True)))


def merged_headers(response: Column, revisit: Column) -> Column:
    new = F.map_filter(revisit, lambda k, v: k.isin(PERMITTED) & v.isNotNull())
    return F.map_concat(F.map_filter(response, lambda k, v: ~F.map_contains_key(new, k)), new)


def resolved(records: DataFrame, record_id="record_id", url="url", kind="warc_type", time="ts", status="status",
             headers="headers", digest="digest") -> DataFrame:
    """record_id, canonical_url, ts, outcome, refers_to, refers_ts, digest and headers of every revisit.

    ``outcome`` is ``resolved``, ``unvalidated`` (nothing to compare; taken as
    it is), ``mismatch`` (headers stay the revisit's own) or ``no_response``.
    """
    col = lambda c: F.col(f"`{c}`")
    rec = F.struct(
        col(record_id).cast("string").alias("id"), col(time).cast("timestamp").alias("ts"),
        lower_names(col(headers)).alias("headers"), col(digest).cast("string").alias("digest"),
    )
    is_revisit = col(kind) == "revisit"
    is_full = (col(kind) == "response") & (col(status) == 200) & col(url).isNotNull() & col(time).isNotNull()
    rows = records.where(is_revisit | is_full).select(
        F.coalesce(canonical_url(col(url)), F.lit("")).alias("u"), rec.alias("r"),
        F.when(is_revisit, 0).otherwise(1).alias("side"),  # a revisit comes before responses of its own time
        (col(url).isNull() | col(time).isNull()).alias("lost"),
    )
    order = ["u", F.col("r.ts"), "side", F.col("r.id")]
    n = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("salt", F.monotonically_increasing_id())
    rows = stored(rows.repartitionByRange(n, *order, "salt").withColumn("pid", F.spark_partition_id()))

    here = Window.partitionBy("pid", "u").orderBy(F.col("r.ts"), "side", F.col("r.id"), "salt")
    full = F.when(F.col("side") == 1, F.col("r"))
    filled = rows.withColumn("own", F.last(full, ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, 0)))

    # only a partition's first and last URL can lie in others as well: at most two per partition
    edges = stored(rows.groupBy("pid").agg(F.min("u").alias("a"), F.max("u").alias("b")))
    split = edges.select("pid", F.explode(F.array_distinct(F.array("a", "b"))).alias("u")).groupBy("u")
    split = split.agg(F.count("*").alias("n")).where("n > 1").select("u")
    key = F.struct(F.col("r.ts"), F.col("r.id"), F.col("salt"))
    ends = rows.join(F.broadcast(split), "u").groupBy("u", "pid").agg(F.max_by(full, F.when(F.col("side") == 1, key)).alias("end"))
    earlier = Window.partitionBy("u").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select("u", "pid", F.last("end", ignorenulls=True).over(earlier).alias("carried"))
    filled = filled.where("side = 0").join(F.broadcast(stored(carry)), ["u", "pid"], "left")

    got = filled.select("u", "r", F.when(~F.col("lost"), F.coalesce("own", "carried")).alias("m"))
    agree = agreement("r", "m")
    outcome = F.when(F.col("m").isNull(), "no_response").when(agree.isNull(), "unvalidated").when(agree, "resolved").otherwise("mismatch")
    got = got.withColumn("outcome", outcome)
    taken = F.col("outcome").isin("resolved", "unvalidated")
    return got.select(
        F.col("r.id").alias("record_id"), F.col("u").alias("canonical_url"), F.col("r.ts").alias("ts"), "outcome",
        F.col("m.id").alias("refers_to"), F.col("m.ts").alias("refers_ts"),
        F.when(taken, F.coalesce("m.digest", "r.digest")).alias("digest"),
        F.when(taken, merged_headers(F.col("m.headers"), F.col("r.headers"))).otherwise(F.col("r.headers")).alias("headers"),
    )


def with_payload(resolutions: DataFrame, payloads: DataFrame, record_id="record_id", payload="payload") -> DataFrame:
    """Resolved revisits with the payload of the response they refer to."""
    body = payloads.select(F.col(f"`{record_id}`").cast("string").alias("refers_to"), F.col(f"`{payload}`").alias("payload"))
    return resolutions.where("outcome IN ('resolved', 'unvalidated')").join(body, "refers_to")
