"""Order statistics without sorts, profiles, sketches, check suites in one pass, and text indexes."""

from __future__ import annotations

import math
import random
from collections import Counter
from decimal import Decimal as D

import pytest
from conftest import as_dicts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerlake.operators import aggregates as agg
from layerlake.operators import checks, profile, selection, terms
from layerlake.plans import marts

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def by_hand(values, share):
    """Numbers that are none come last, as in Spark's order."""
    kept = sorted((v for v in values if v is not None), key=lambda v: (v != v, v))
    return kept[math.ceil(D(share) * len(kept)) - 1]


def same(a, b):
    return (a != a and b != b) or a == b


SHARES = ["0.000000000000001", "0.1", "0.25", "0.5", "0.75", "0.999", "1"]


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("bigint", [-(2**63), 2**63 - 1, 0, 1, None, 2**63 - 2, 2**62, 2**62 + 1, -(2**63) + 1]),
        ("int", [5] * 50 + [None] * 9 + [7]),
        ("decimal(38,2)", [D("9" * 36 + ".99"), D("-" + "9" * 36 + ".99"), D("0.01"), D("0.02"), None, D("0.01")]),
        ("double", [1e308, -1e308, 5e-324, -5e-324, 0.0, -0.0, 1.0, 1.0 + 2**-52, float("inf"), float("-inf"), float("nan"), None]),
        ("float", [0.1, 0.1, 0.2, None]),
        ("double", [float("nan"), float("nan"), float("inf")]),
    ],
)
def test_quantiles_of_extremes(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    values = [r.v for r in df.collect()]
    got = selection.quantiles(df, "v", SHARES)
    assert dict(got.dtypes)["v"] == kind
    rows = [(str(r.share.normalize()), r.v) for r in got.collect()]
    assert len(rows) == len(SHARES)
    for share, (_, v) in zip(SHARES, rows, strict=True):
        assert same(v, by_hand(values, share)), share


@FEW
@given(st.lists(st.one_of(st.none(), st.floats(width=64), st.integers(-9, 9).map(float)), min_size=1, max_size=60), st.sampled_from([2, 3, 1024]))
def test_quantiles_of_any_numbers(spark, values, buckets):
    """With few buckets many passes are needed; ties and nulls are common."""
    values = [*values, 0.5]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    was, selection.BUCKETS = selection.BUCKETS, buckets
    try:
        rows = selection.quantiles(df, "v", SHARES).collect()
    finally:
        selection.BUCKETS = was
    for share, r in zip(SHARES, rows, strict=True):
        assert same(r.v, by_hand(values, share)), share


def test_quantiles_by_group_and_of_nothing(spark):
    rnd = random.Random(2)
    rows = [(g, rnd.choice([None, rnd.randrange(10**9), 3])) for g in "abc" for _ in range(400)] + [("only nulls", None), (None, 1)]
    df = spark.createDataFrame(rows, "g string, v bigint").repartition(5)
    got = {(r.g, str(r.share.normalize())): r.v for r in selection.quantiles(df, "v", ["0.2", "0.5", "0.9"], "g").collect()}
    want = {(g, s): by_hand([v for h, v in rows if h == g], s) for g in "abc" for s in ("0.2", "0.5", "0.9")}
    assert got == want
    assert selection.quantiles(df.limit(0), "v", ["0.5"]).collect() == []
    assert selection.quantiles(df.limit(0), "v", ["0.5"], "g").columns == ["g", "share", "v"]
    for share in ("0", "1.2", "0.0000000000000001"):
        with pytest.raises(ValueError):
            selection.quantiles(df, "v", [share])


def test_quantiles_sort_nothing(spark, capsys):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5_003).alias("v"))
    selection.quantiles(df, "v", ["0.5"]).collect()
    shown = "rangepartitioning"
    for plan in _plans_of(spark, df):
        assert shown not in plan.lower() and "Sort " not in plan


def _plans_of(spark, df):
    """The plans that the passes run."""
    values = df.select(F.lit("").alias("_group"), F.col("v").cast("decimal(20,0)").alias("_x"))
    kind = selection._working_type(df.schema["v"].dataType)
    span = selection.Range("", D(0), D(5_002), 0, False, [(D("0.5"), 2_500)])
    yield selection._histogram(selection._in_ranges(values, [span], kind), [span], kind)._jdf.queryExecution().executedPlan().toString()


def test_profile_counts_and_fences(spark):
    rows = [(i % 7, float(i), None if i % 3 else "x", D(i)) for i in range(1, 60)] + [(None, 1e6, "y", None), (0, -0.0, "y", D(-1000)), (0, 0.0, "", None)]
    df = spark.createDataFrame(rows, "a int, b double, c string, `d.e` decimal(9,2)").repartition(4)
    got = {r.column_name: r for r in profile.profile_columns(df).collect()}
    assert {c: r.n_distinct for c, r in got.items()} == {"a": 7, "b": 61, "c": 3, "d.e": 60}
    for c, values in (("b", [r[1] for r in rows]), ("d.e", [float(r[3]) for r in rows if r[3] is not None])):
        q1, q3 = by_hand(values, "0.25"), by_hand(values, "0.75")
        low, high = q1 - (q3 - q1) * 1.5, q3 + (q3 - q1) * 1.5
        assert (got[c].low_fence, got[c].high_fence) == (low, high)
        assert got[c].n_outliers == sum(v < low or v > high for v in values) == 1
    assert (got["c"].n_outliers, got["c"].low_fence, got["a"].n_nulls) == (0, None, 1)
    assert {r.column_name: r.n_outliers for r in profile.profile_columns(df.select("c")).collect()} == {"c": 0}
    none = {r.column_name: (r.n_rows, r.n_distinct, r.n_outliers, r.low_fence) for r in profile.profile_columns(df.limit(0)).collect()}
    assert none == {c: (0, 0, 0, None) for c in df.columns}


def test_profile_copies_no_rows_per_column(spark, small):
    part = spark.read.parquet(f"{small}/part.parquet")
    plan = profile.distinct_values(part, part.columns)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_sketches_roll_up(spark):
    sales = spark.range(60_000).select(
        F.col("id"), (F.col("id") * 31 % 500).alias("customer_id"), F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("sale_date"),
        F.lit("x").alias("weekday"), F.lit(1).alias("weekday_no"), (F.col("id") % 24).cast("int").alias("sale_hour"),
        F.when(F.col("id") % 3 == 0, "web").otherwise("shop").alias("channel"), F.lit(2).alias("quantity"), F.lit("1.50").cast("decimal(10,2)").alias("revenue"),
    )
    fine = marts.sales_over_time(sales, sketches=True)
    plain = marts.sales_over_time(sales)
    assert as_dicts(fine.drop("customer_sketch"), *plain.columns[:5]) == as_dicts(plain, *plain.columns[:5])
    rolled = agg.rolled_up(fine, ["channel"], name="estimate")
    exact = sales.groupBy("channel").agg(F.countDistinct("customer_id").alias("n"))
    rows = rolled.join(exact, "channel").withColumn("ok", agg.is_within_bound("estimate", "n")).collect()
    assert len(rows) == 2 and all(r.ok for r in rows)
    twice = agg.rolled_up(agg.rolled_up(fine, ["sale_date", "channel"]), ["channel"], name="estimate")
    assert all(r.ok for r in twice.join(exact, "channel").withColumn("ok", agg.is_within_bound("estimate", "n")).collect())
    added = fine.groupBy("channel").agg(F.sum("customers").alias("n")).join(exact.withColumnRenamed("n", "m"), "channel")
    assert all(r.n > r.m for r in added.collect())  # counts themselves do not add up


def test_suite_reads_each_table_once(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(10,2)").alias("revenue"))
    lines = spark.read.parquet(f"{small}/lineitem.parquet").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(10,2)").alias("revenue"))
    suite = checks.CheckSuite({"orders": orders, "lines": lines})
    suite.unique("orders", ["o_orderkey"]).unique("lines", ["l_orderkey", "l_linenumber"]).unique("lines", ["l_orderkey"])
    suite.rows("orders", "cheap", F.col("revenue") < 1000).rule("lines", "priced", F.col("revenue") > 0).rows("lines", "null key", checks.any_null("l_orderkey"))
    suite.same_total("orders", "lines").same_count("orders", "lines").same_total("lines", "lines")
    suite.share_below("orders", "few cheap", F.col("revenue") < 1000, D("0.5"))
    got = {r["check"]: r.n_problems for r in suite.results().collect()}
    o, n = orders.collect(), lines.collect()
    keys = [r.l_orderkey for r in n]
    assert got == {
        "orders: unique o_orderkey": 0, "lines: unique l_orderkey, l_linenumber": sum(c > 1 for c in Counter((r.l_orderkey, r.l_linenumber) for r in n).values()),
        "lines: unique l_orderkey": sum(c > 1 for c in Counter(keys).values()), "orders: cheap": sum(r.revenue < 1000 for r in o),
        "lines: priced": 0, "lines: null key": 0, "lines: total revenue equals orders": 1, "lines: row count equals orders": 1,
        "lines: total revenue equals lines": 0, "orders: few cheap": int(2 * sum(r.revenue < 1000 for r in o) >= len(o)),
    }
    plan = suite.results()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("orders.parquet") + plan.count("Relation [o_orderkey") <= 1 or plan.count("Relation") == 3  # lines has two keys


@FEW
@given(
    st.lists(st.tuples(st.text("abcdA #", max_size=9), st.sampled_from(["", "a", "Ab", "abc", "cdab", "bcda", "dd", "#a", "ABC"])), min_size=1, max_size=15)
)
def test_mentions_with_short_and_long_terms(spark, pairs):
    rows = [(i, text, own) for i, (text, own) in enumerate(pairs)] + [(90, None, "zz"), (91, "zz top", None), (92, "zz", "zz")]
    df = spark.createDataFrame(rows, "id int, text string, own string")
    owners = {b for _, _, b in rows if b is not None}
    want = [i for i, t, own in rows if t is not None and own is not None and any(b != own and b.lower() in t.lower() for b in owners)]
    assert sorted(r.id for r in terms.rows_mentioning_other_term(df, "text", "own").collect()) == want


def test_a_text_makes_a_row_per_character_at_most(spark):
    df = spark.createDataFrame([("abcabcabc",), ("",), ("xy",), ("日本語日本語",)], "_low string")
    rows = [(r["_low"], r["_gram"]) for r in terms._grams_at_each_place(df).collect()]
    for text in ("abcabcabc", "", "xy", "日本語日本語"):
        n = sum(t == text for t, _ in rows)
        assert n <= max(1, len(text))
