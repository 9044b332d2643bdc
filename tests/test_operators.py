from __future__ import annotations

import random
from collections import Counter
from decimal import Decimal as D

import pytest
from conftest import as_dicts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from layerlake.operators import aggregates as agg
from layerlake.operators import checks, dedup, joins, pricing, profile, ranking, scorecard, segments, terms


# -- de-duplication ----------------------------------------------------------


def test_dedup_of_one_column_needs_no_sort(spark):
    rows = [(1, 2.0), (1, None), (2, float("nan")), (2, 5.0), (2, 7.0), (None, 3.0), (None, 1.0), (3, None), (4, float("nan"))]
    df = spark.createDataFrame(rows, "k int, x double").repartition(3)
    got = dedup.first_by_key(df.select("x", "k"), ["k"])
    whole = df.groupBy("k").agg(F.min(F.struct("x")).alias("r")).select("r.x", "k")  # null is smallest, NaN largest
    assert got.columns == ["x", "k"] and sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_offers_without_a_time_keep_the_same_prices(spark, small):
    from layerlake.plans.bindings import Tables
    from layerlake.plans.cleaning import clean_offers

    t = Tables(spark, small)
    whole, bare = (clean_offers(raw, t.products()) for raw in (t.raw_offers(), t.raw_offers().drop("collected_at")))
    assert [c for c in whole.columns if c != "collected_at"] == bare.columns
    assert sorted(map(str, whole.drop("collected_at").collect())) == sorted(map(str, bare.collect()))


def test_dedup_is_deterministic_whatever_the_order(spark):
    rows = [(1, "b", None), (1, "a", 9), (1, "a", 3), (2, "z", 1), (2, "z", 1)]
    results = set()
    for _ in range(3):
        random.shuffle(rows)
        df = spark.createDataFrame(rows, "k int, a string, n int").repartition(3)
        results.add(tuple(sorted(dedup.first_by_key(df, ["k"]).collect())))
    assert results == {((1, "a", 3), (2, "z", 1))}


def test_dedup_is_idempotent_and_takes_composite_keys(spark):
    df = spark.createDataFrame([(1, "x", 5), (1, "y", 6), (1, "x", 4)], "p int, c string, v int")
    once = dedup.first_by_key(df, ["p", "c"])
    assert sorted(once.collect()) == sorted(dedup.first_by_key(once, ["p", "c"]).collect()) == [(1, "x", 4), (1, "y", 6)]
    assert once.columns == df.columns


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(0, 3000, 1, 4).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    plan = dedup.first_by_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert dedup.first_by_key(df, ["k"]).count() == 2001


def test_latest_row(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", 2, "w")], "k string, t int, v string")
    assert sorted(dedup.latest_by_key(df, ["k"], "t").collect()) == [("a", 3, "z"), ("b", 2, "w")]


# -- ranking -----------------------------------------------------------------


def _scores(spark, n=4000):
    """A third of the rows share one score and half of them one group."""
    id_ = F.col("id")
    score = F.when(id_ % 3 == 0, 7).otherwise(F.pmod(F.xxhash64(id_), F.lit(50)))
    group = F.when(id_ % 2 == 0, "hot").when(id_ % 11 == 0, None).otherwise(F.concat(F.lit("g"), (id_ % 17).cast("string")))
    return spark.range(0, n, 1, 5).select("id", score.cast("int").alias("score"), group.alias("grp"))


def test_global_rank_equals_plain_window(uncoalesced):
    df = _scores(uncoalesced)
    order = [F.desc("score"), "id"]
    want = df.withColumn("r", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    got = ranking.global_rank(df, order, "r")
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_group_rank_equals_plain_window(uncoalesced):
    df = _scores(uncoalesced)
    order = [F.desc("score"), "id"]
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("grp").orderBy(*order)).cast("bigint"))
    got = ranking.rank_within(df, "grp", order, "r")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_ranks_of_nothing(spark):
    empty = _scores(spark).where("false")
    assert ranking.global_rank(empty, ["score", "id"]).count() == 0
    assert ranking.rank_within(empty, "grp", ["score", "id"]).count() == 0


def test_rank_spreads_over_partitions(uncoalesced):
    placed = ranking._placed(_scores(uncoalesced), [F.desc("score"), "id"])
    sizes = [r["count"] for r in placed.groupBy("_slot").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 4000 * 0.6


def test_top_k_limits_before_the_shuffle(spark):
    top = ranking.top_k_per_group(_scores(spark), ["grp"], [F.desc("score"), "id"], 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert top.groupBy("grp").count().where("count > 2").count() == 0


def test_plain_limit_and_bottom_n(spark):
    df = _scores(spark)
    assert df.limit(7).count() == 7
    assert [r["id"] for r in ranking.top_n(df, ["id"], 3).collect()] == [0, 1, 2]


def test_exact_quantiles(uncoalesced):
    df = uncoalesced.range(1, 101).select("id", (F.col("id") * 10).alias("v"))
    rows = ranking.exact_quantiles(df, "v", "id", ["0.3", "0.8", "0.805"]).collect()
    assert {float(r["share"]): r["v"] for r in rows} == {0.3: 300, 0.8: 800, 0.805: 810}
    rows = ranking.exact_quantiles(df, "v", "id", ["0.99995", "0.00004"]).collect()
    assert {float(r["share"]): r["v"] for r in rows} == {0.99995: 1000, 0.00004: 10}
    for share in ("0", "1.2", "-0.1"):
        with pytest.raises(ValueError):
            ranking.exact_quantiles(df, "v", "id", [share])


# -- joins and flags ---------------------------------------------------------


@pytest.fixture(scope="module")
def star(spark):
    sales = spark.sql(
        """SELECT * FROM VALUES (1, 'a', timestamp'2025-01-05', 10.00BD), (2, 'a', timestamp'2024-12-31', 5.00BD),
           (3, 'zz', timestamp'2025-01-05', 4.00BD), (4, 'n', timestamp'2025-01-05', 1.00BD),
           (5, NULL, timestamp'2025-01-05', 2.00BD) AS t(id, product, at, revenue)"""
    )
    products = spark.sql(
        """SELECT * FROM VALUES ('a', timestamp'2025-01-01', 'A'), ('n', CAST(NULL AS timestamp), 'N'),
           ('never', timestamp'2025-01-01', 'X') AS t(product, created, label)"""
    )
    return sales, products


def test_flags_keep_every_row(star):
    sales, products = star
    rows = as_dicts(joins.with_registration_flags(sales, products, "product", "at", "created", keep=["label"]), "id")
    assert [(r["id"], r["is_registered"], r["is_before_registration"], r["label"]) for r in rows] == [
        (1, True, False, "A"), (2, True, True, "A"), (3, False, False, None), (4, True, False, "N"), (5, False, False, None),
    ]


def test_orphans_and_unsold(star):
    sales, products = star
    assert sorted(r["id"] for r in joins.orphans(sales, products, "product").collect()) == [3, 5]
    assert [r["product"] for r in joins.without_facts(products, sales, "product").collect()] == ["never"]


def test_join_loss(star):
    sales, products = star
    got = {r["variant"]: r["revenue"] for r in joins.join_loss(sales, products, "product", "revenue").collect()}
    assert got == {"without join": D("22.00"), "with join": D("16.00")}


def test_hot_join_key_is_split(spark):
    """Adaptive execution splits the partition of a key holding a third of all rows."""
    settings_ = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in settings_}
    for k, v in settings_.items():
        spark.conf.set(k, v)
    try:
        product = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
        facts = spark.range(0, 200_000, 1, 8).select(
            "id", product.alias("product"), F.lit("2025-01-05").cast("timestamp").alias("at"),
            F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        )
        dims = spark.range(0, 4000).select(F.col("id").alias("product"), F.lit("2025-01-01").cast("timestamp").alias("created"))
        flagged = joins.with_registration_flags(facts, dims, "product", "at", "created")
        assert len(flagged.collect()) == 200_000
        assert "skew=true" in flagged._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# -- aggregates --------------------------------------------------------------


def test_share_sums_and_zero_total(spark):
    df = spark.createDataFrame([("a", D("1.00")), ("b", D("3.00"))], "k string, revenue decimal(20,2)")
    got = {r["k"]: r["share_pct"] for r in agg.share_of_total(df, "revenue").collect()}
    assert got == {"a": D("25.0"), "b": D("75.0")}
    nothing = df.withColumn("revenue", F.lit(D("0.00")))
    assert {r["share_pct"] for r in agg.share_of_total(nothing, "revenue").collect()} == {None}


def test_day_over_day_with_gap_and_zero(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (date'2025-01-01', 100.00BD), (date'2025-01-03', 0.00BD), (date'2025-01-04', 50.00BD) AS t(sale_date, revenue)"
    )
    rows = as_dicts(agg.day_over_day(df), "sale_date")
    assert [r["change_pct"] for r in rows] == [None, D("-100.0"), None]


def test_mean_per_day_counts_days_once(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('x', date'2025-01-01', 1.00BD), ('x', date'2025-01-01', 2.00BD), ('x', date'2025-01-02', 2.00BD) AS t(k, sale_date, revenue)"
    )
    row = agg.mean_per_day(df, ["k"]).first()
    assert (row["revenue"], row["n_days"], row["revenue_per_day"]) == (D("5.00"), 2, D("2.50"))


def test_distinct_customers_are_not_additive(spark):
    rows = [("a", 1, D("1.00"), 7), ("b", 1, D("1.00"), 7)]
    df = spark.createDataFrame(rows, "channel string, quantity bigint, revenue decimal(10,2), customer_id int")
    per_channel = agg.sales_totals(df, ["channel"], customer="customer_id", quantity="quantity")
    assert per_channel.agg(F.sum("customers")).first()[0] == 2
    assert agg.sales_totals(df, customer="customer_id").first()["customers"] == 1


def test_kpis_of_an_empty_table(spark):
    df = spark.createDataFrame([], "sold_at timestamp, customer_id int, revenue decimal(10,2)")
    row = agg.kpis(df).first()
    assert (row["n_sales"], row["revenue"], row["avg_ticket"], row["customers"]) == (0, None, None, 0)


# -- segments and pricing ----------------------------------------------------


def test_segments_keep_customers_without_sales(spark):
    people = spark.createDataFrame([(1,), (2,)], "customer_id int")
    sales = spark.sql("SELECT 1 AS customer_id, date'2025-01-01' AS sale_date, 22000.00BD AS revenue")
    rows = as_dicts(segments.customer_segments(people, sales), "customer_id")
    assert (rows[0]["segment"], rows[0]["n_sales"]) == ("VIP", 1)
    assert (rows[1]["segment"], rows[1]["n_sales"], rows[1]["revenue"]) == ("REGULAR", 0, D("0.00"))
    assert rows[1]["avg_ticket"] is rows[1]["first_purchase"] is rows[1]["last_purchase"] is None


def _market(spark, with_flag):
    products = spark.createDataFrame(
        [("p", D("100.00")), ("q", D("10.00")), ("unwatched", D("1.00"))], "product_id string, list_price decimal(10,2)"
    )
    offers = spark.createDataFrame(
        [("p", "a", D("50.00")), ("p", "b", D("110.00")), ("q", "a", D("10.00")), ("ghost", "a", D("1.00"))],
        "product_id string, competitor string, competitor_price decimal(10,2)",
    )
    if with_flag:
        offers = offers.withColumn("is_suspicious", F.col("competitor_price") == 50)
    totals = spark.createDataFrame([("p", 3, D("300.00"))], "product_id string, items bigint, revenue decimal(20,2)")
    return products, offers, totals


@pytest.mark.parametrize("with_flag", [True, False])
def test_competitiveness(spark, with_flag):
    rows = as_dicts(pricing.price_competitiveness(*_market(spark, with_flag)), "product_id")
    p, q = rows
    assert (p["mean_price"], p["diff_pct_vs_mean"], p["diff_pct_vs_lowest"]) == (D("80.00"), D("25.00"), D("100.00"))
    assert (p["price_position"], p["has_suspicious_price"], p["items"]) == ("ACIMA_DA_MEDIA", True, 3)
    assert (q["price_position"], q["n_offers"], q["revenue"], q["items"]) == ("NA_MEDIA", 1, D("0.00"), 0)
    assert q["has_suspicious_price"] is False


def test_three_differences_differ(spark):
    products = spark.createDataFrame([("p", "c", D("10.00"))], "product_id string, category string, list_price decimal(10,2)")
    offers = spark.createDataFrame(
        [("p", "a", D("3.00")), ("p", "b", D("3.00")), ("p", "d", D("4.01"))],
        "product_id string, competitor string, competitor_price decimal(10,2)",
    )
    none = spark.createDataFrame([], "product_id string, items bigint, revenue decimal(20,2)")
    rounded = pricing.price_competitiveness(products, offers, none).first()["diff_pct_vs_mean"]
    exact = pricing.difference_to_unrounded_mean(products, offers).first()["diff_pct"]
    ratios = pricing.mean_difference_by(products, offers, "category").first()["mean_diff_pct"]
    assert (rounded, exact, ratios) == (D("199.40"), D("199.7"), D("205.3"))


# -- terms -------------------------------------------------------------------


def _mismatch_by_hand(rows):
    owners = {b for _, _, b in rows if b is not None}
    return sorted(
        i for i, text, own in rows
        if text is not None and own is not None and any(b != own and b.lower() in text.lower() for b in owners)
    )


def _mentions(spark, rows):
    df = spark.createDataFrame(rows, "id int, text string, own string")
    return sorted(r["id"] for r in terms.rows_mentioning_other_term(df, "text", "own").collect())


def test_mentions_of_other_terms(spark):
    rows = [
        (1, "Tênis Nike Air", "Adidas"), (2, "tênis NIKE", "Nike"), (3, "plain", "LG"), (4, "Brand#17", "Brand#17"),
        (5, "x", "Brand#1"), (6, None, "LG"), (7, "nike lg", None), (8, "nike", "NIKE"), (9, "100%_off", "a_b"),
    ]
    assert _mentions(spark, rows) == _mismatch_by_hand(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.text("abA ", max_size=6), st.sampled_from(["a", "ab", "bA", "AB", "b "])), min_size=1, max_size=12))
def test_mentions_match_pairwise_search(spark, pairs):
    rows = [(i, text, own) for i, (text, own) in enumerate(pairs)]
    assert _mentions(spark, rows) == _mismatch_by_hand(rows)


# -- profile and scorecard ---------------------------------------------------


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (0, None), (1, "b")], "n int, s string")
    rows = {r["column_name"]: r.asDict() for r in profile.profile_columns(df).collect()}
    assert (rows["n"]["n_distinct"], rows["n"]["n_not_positive"], rows["n"]["smallest"]) == (2, 1, "0")
    assert (rows["s"]["n_nulls"], rows["s"]["n_distinct"], rows["s"]["largest"]) == (1, 2, "b")
    estimate = {r["column_name"]: r["n_distinct"] for r in profile.profile_columns(df, exact_distinct=False).collect()}
    assert estimate == {"n": 2, "s": 2}
    keys = profile.duplicate_key_profile(df, ["n"]).first()
    assert tuple(keys) == (3, 2, 1, 1)


def test_scorecard_rows(spark):
    df = spark.createDataFrame([(True, D("1.50")), (False, D("2.00")), (None, D("4.00"))], "bad boolean, revenue decimal(10,2)")
    rules = [
        scorecard.RowRule("bad", "ALERTA", F.col("bad"), "revenue"),
        scorecard.RowRule("never", "INFORMATIVO", F.lit(False), "revenue"),
        scorecard.RowRule("plain", "CORRIGIDO", F.col("bad").isNull()),
    ]
    rows = {r["rule"]: (r["affected_rows"], r["affected_revenue"]) for r in scorecard.score_rows(df, "t", rules).collect()}
    assert rows == {"bad": (1, D("1.50")), "never": (0, None), "plain": (1, None)}


def test_same_name_counts_every_row_of_the_name(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "name string")
    assert scorecard.same_name_rows(df, "name").first()["n"] == 3


# -- checks ------------------------------------------------------------------


@pytest.fixture
def tables(spark):
    sales = spark.createDataFrame(
        [(1, "e", 2, D("1.00"), D("2.00")), (2, "s", 1, D("3.00"), D("3.00"))],
        "id int, channel string, quantity bigint, unit_price decimal(10,2), revenue decimal(10,2)",
    )
    return {"sales": sales, "gold": sales.select("id", "revenue"), "empty": sales.where("false")}


def test_passing_suite(tables):
    suite = (
        checks.CheckSuite(tables)
        .unique("sales", ["id"])
        .rows("sales", "required", checks.any_null("id", "channel"))
        .rows("sales", "channel", checks.outside("channel", ["e", "s"]))
        .rule("sales", "revenue", F.col("revenue") == F.col("quantity") * F.col("unit_price"))
        .same_total("sales", "gold")
        .same_count("sales", "gold")
        .share_below("sales", "bad share", F.lit(False), D("0.01"))
        .share_below("empty", "bad share", F.lit(True), D("0.01"))
    )
    assert {r["status"] for r in suite.run()} == {"OK"}


def test_failing_suite_names_every_failure(spark, tables):
    sales = tables["sales"]
    broken = {
        "sales": sales.unionByName(sales.limit(1)).withColumn("channel", F.lit(None).cast("string")),
        "gold": sales.select("id", "revenue"),
        "empty": tables["empty"],
    }
    suite = (
        checks.CheckSuite(broken)
        .unique("sales", ["id"])
        .rows("sales", "channel", checks.outside("channel", ["e", "s"]))
        .same_total("sales", "gold")
        .same_total("sales", "empty")
        .same_count("sales", "gold")
        .documented("gold")
    )
    found = {r["check"]: r["n_problems"] for r in suite.results().collect()}
    assert found == {
        "sales: channel": 3,
        "sales: unique id": 1,
        "gold: total revenue equals sales": 1,
        "empty: total revenue equals sales": 1,
        "gold: row count equals sales": 1,
        "gold: every column has a comment": 2,
    }
    with pytest.raises(checks.CheckFailure, match=r"sales: channel \(3\)"):
        suite.run()


def test_two_empty_totals_are_equal(tables):
    suite = checks.CheckSuite({"a": tables["empty"], "b": tables["empty"]}).same_total("a", "b")
    assert suite.run()[0]["n_problems"] == 0


def test_tolerance_flips_with_the_limit(spark):
    df = spark.range(0, 3020).select((F.col("id") < 20).alias("bad"))
    at = lambda limit: checks.share_reaches(df, F.col("bad"), D(limit)).first()[0]
    assert (at("0.01"), at("0.005")) == (0, 1)


# -- previous values and samples ---------------------------------------------


def test_previous_value_over_many_partitions(uncoalesced):
    """Against a plain walk; groups span partitions, some partitions are empty, values and groups may be null."""
    rows = [(g, k, None if k % 5 == 0 else D(k)) for g in ("a", None, "b", "") for k in range(1, 40)] + [("one", 1, D("9.00"))]
    df = uncoalesced.createDataFrame(rows, "g string, k int, v decimal(10,2)").repartition(7)
    key = lambda r: (r[0] is not None, r[0] or "", r[1])
    want, last = [], {}
    for g, k, v in sorted(rows, key=key):
        want.append((g, k, last.get(g)))
        last[g] = v
    got = ranking.previous_value(df, ["k"], "v", "p", "g").select("g", "k", "p")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    numbers = uncoalesced.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).repartition(9)
    got = ranking.previous_value(numbers, ["k"], "v", "p")
    assert sorted((r.k, r.p) for r in got.collect()) == [(i, i * 2 - 2 if i else None) for i in range(500)]
    assert ranking.previous_value(numbers.where("k < 0"), ["k"], "v", "p").collect() == []
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_change_from_the_period_before(spark):
    df = spark.createDataFrame([(1, D("10.00")), (2, D("15.00")), (4, D("0.00")), (5, D("3.00"))], "hour int, revenue decimal(20,2)")
    rows = as_dicts(agg.period_over_period(df, ["hour"]), "hour")
    assert [r["change_pct"] for r in rows] == [None, D("50.0"), D("-100.0"), None]


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(900).select("id", (F.col("id") % 3).alias("g"), F.when(F.col("id") > 4, F.col("id")).alias("k"))
    one = ranking.sampled(df.repartition(1), 20, ["id"], seed=1).collect()
    many = ranking.sampled(df.repartition(13, "k"), 20, ["id"], seed=1).collect()
    assert sorted(one) == sorted(many) and len({r.id for r in one}) == 20
    assert {r.id for r in one} < {r.id for r in ranking.sampled(df, 50, ["id"], seed=1).collect()}
    assert {r.id for r in one} != {r.id for r in ranking.sampled(df, 20, ["id"], seed=2).collect()}
    groups = ranking.sampled(df, 7, ["id"], seed=1, group=["g"]).collect()
    assert sorted(Counter(r.g for r in groups).items()) == [(0, 7), (1, 7), (2, 7)]
    assert ranking.sampled(df, 5, ["k"]).columns == df.columns and ranking.sampled(df.limit(0), 5, ["id"]).collect() == []
