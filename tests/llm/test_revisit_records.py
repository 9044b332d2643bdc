"""Revisits of a few addresses, one of them in most records and thus over many partitions, against a plain search."""

from __future__ import annotations

import random

from layerlake.llm import queries, revisits


def plain(rows):
    """(id, outcome, referred id, headers) of every revisit."""
    def low(headers):
        return {k.lower(): v for k, v in (headers or {}).items()}

    full = [r for r in rows if r[2] == "response" and r[4] == 200 and r[1] is not None and r[3] is not None]
    out = []
    for i, url, kind, t, _, headers, digest in rows:
        if kind != "revisit":
            continue
        own = low(headers)
        earlier = [r for r in full if url is not None and t is not None and r[1] == url and r[3] < t]
        if not earlier:
            out.append((i, "no_response", None, tuple(sorted(own.items()))))
            continue
        m = max(earlier, key=lambda r: (r[3], r[0]))
        theirs = low(m[5])
        votes = []
        if own.get("etag") is not None and theirs.get("etag") is not None:
            votes.append(own["etag"].removeprefix("W/") == theirs["etag"].removeprefix("W/"))
        elif own.get("last-modified") is not None and theirs.get("last-modified") is not None:
            votes.append(own["last-modified"] == theirs["last-modified"])
        if digest is not None and m[6] is not None:
            votes.append(digest == m[6])
        outcome = "unvalidated" if not votes else "resolved" if all(votes) else "mismatch"
        merged = theirs | {k: v for k, v in own.items() if k in revisits.PERMITTED and v is not None}
        out.append((i, outcome, m[0], tuple(sorted((own if outcome == "mismatch" else merged).items()))))
    return sorted(out, key=str)


def test_hot_address_over_many_partitions(uncoalesced):
    rnd = random.Random(9)
    pick = lambda *v: rnd.choice(v)
    rows = []
    for n in range(900):
        url = pick("hot.org/a?x=1", "hot.org/a?x=1", "hot.org/a?x=1", "b.org/b", "c.org", None)
        kind = pick("response", "revisit", "revisit", "request")
        headers = {k: v for k, v in ((pick("ETag", "etag"), pick('"1"', 'W/"1"', '"2"', None)), ("Last-Modified", pick("m1", "m2", None)),
                                     ("Content-Length", str(n)), ("Date", f"d{n}")) if v is not None}
        rows.append((f"{n:04}", url, kind, pick(None, *range(0, 400)), pick(200, 200, 404) if kind == "response" else 304,
                     pick(headers, headers, None), pick("a", "b", None)))
    rows += rows[:40]  # repeated
    schema = "record_id string, url string, warc_type string, t long, status int, headers map<string,string>, digest string"
    df = uncoalesced.createDataFrame(rows, schema).selectExpr("*", "timestamp_seconds(t) AS ts", "'x' AS u", "1 AS side").repartition(6)
    got = [(r.record_id, r.outcome, r.refers_to, tuple(sorted((r.headers or {}).items()))) for r in revisits.resolved(df).collect()]
    assert sorted(got, key=str) == plain(rows)
    assert len({r[1] for r in got}) == 4


def test_derived_crawl_is_varied(spark, small):
    records = queries.crawl(spark.read.parquet(f"{small}/pages.parquet"))
    outcomes = {r.outcome for r in revisits.resolved(records).select("outcome").distinct().collect()}
    assert outcomes == {"resolved", "unvalidated", "mismatch", "no_response"}
    most = records.groupBy("url").count().agg({"count": "max"}).first()[0]
    assert most > records.count() / 10
