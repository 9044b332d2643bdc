"""Projections, filters and scalar expressions over whole tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from ..functions import columns as cols
from ..functions import fixed_values as fixed
from ..functions import money
from ..operators import aggregates as agg
from ..operators import checks
from ..operators.joins import orphans
from ..plans.bindings import PRICE_BANDS
from .reference_sql import TITLE, big, day, half_up, pct, shown, sql, title_case, ts, weekday_case
from .registry import query


@query(
    "computed_revenue",
    sql(f"""SELECT order_id, line_no, channel, quantity, {shown('unit_cents', 'unit_price')},
               {shown('quantity * unit_cents', 'revenue')} FROM raw_lines"""),
    "PRJ-2", "PRJ-3", "PRJ-5",
)
def _(t):
    priced = t.raw_lines().withColumn("unit_price", money.amount("unit_price"))
    out = priced.withColumn("revenue", money.line_revenue("quantity", "unit_price"))
    return out.drop("supplier_id", "product_id")


@query(
    "customers_above_mean_orders",
    """WITH per_customer AS (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1)
       SELECT o_custkey AS customer_id, n_orders FROM per_customer
       WHERE n_orders * (SELECT count(*) FROM per_customer) > (SELECT sum(n_orders) FROM per_customer)""",
    "PRJ-7",
)
def _(t):
    per_customer = t.raw_orders().groupBy("customer_id").agg(F.count("*").alias("n_orders"))
    whole = per_customer.agg(F.sum("n_orders")).scalar()
    n = per_customer.agg(F.count("*")).scalar()
    return per_customer.where(F.col("n_orders") * n > whole)


@query(
    "filter_comparison",
    sql("SELECT order_id, line_no, quantity FROM raw_lines WHERE channel = 'F' AND quantity > 45"),
    "FLT-1",
)
def _(t):
    lines = t.raw_lines().where((F.col("channel") == "F") & (F.col("quantity") > 45))
    return lines.select("order_id", "line_no", "quantity")


@query(
    "filter_or",
    "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' OR c_acctbal < 0",
    "FLT-2",
)
def _(t):
    df = t.table("customer").where((F.col("c_mktsegment") == "BUILDING") | (F.col("c_acctbal") < 0))
    return df.select("c_custkey", "c_mktsegment", "c_acctbal")


@query(
    "filter_domain",
    """SELECT p_type, count(*) AS n_rows FROM part
       WHERE coalesce(p_type NOT IN ('ECONOMY', 'PROMO', 'SMALL'), true) GROUP BY 1""",
    "FLT-3",
)
def _(t):
    df = t.table("part").where(checks.outside("p_type", ["ECONOMY", "PROMO", "SMALL"]))
    return agg.value_counts(df, "p_type")


@query(
    "filter_missing_lookup",
    sql("""SELECT r.channel, count(*) AS n_rows,
                  count(*) FILTER (WHERE p.category IS NOT NULL) AS n_known,
                  count(*) FILTER (WHERE p.category IS NULL) AS n_missing
           FROM raw_lines r LEFT JOIN products p ON r.product_id = p.product_id GROUP BY 1"""),
    "FLT-4", "AG-8",
)
def _(t):
    per_key = t.raw_lines().groupBy("channel", "product_id").agg(F.count("*").alias("n"))
    joined = per_key.join(t.products().select("product_id", "category"), "product_id", "left")
    return joined.groupBy("channel").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("category").isNotNull(), F.col("n"))), F.lit(0)).alias("n_known"),
        F.coalesce(F.sum(F.when(F.col("category").isNull(), F.col("n"))), F.lit(0)).alias("n_missing"),
    )


@query(
    "filter_flag",
    sql(f"""SELECT order_id, line_no, product_id, {shown('cents', 'revenue')}
            FROM flagged WHERE NOT is_registered"""),
    "FLT-5", "DQ-5",
)
def _(t):
    df = t.flagged_sales().where(~F.col("is_registered"))
    return df.select("order_id", "line_no", "product_id", "revenue")


@query(
    "filter_regex",
    sql(f"SELECT customer_id, original_name FROM customers WHERE regexp_matches(original_name, '{TITLE}')"),
    "FLT-6", "DQ-11",
)
def _(t):
    return t.customers().where(cols.has_title("original_name")).select("customer_id", "original_name")


@query(
    "filter_like",
    """SELECT p_partkey, p_name FROM part
       WHERE lower(p_name) LIKE '%' || lower('RIN') || '%' OR starts_with(p_name, 'hot')""",
    "FLT-7", "SF-3",
)
def _(t):
    name = F.col("p_name")
    hit = F.lower(name).contains(F.lower(F.lit("RIN"))) | name.startswith("hot")
    return t.table("part").where(hit).select("p_partkey", "p_name")


@query(
    "filter_region",
    sql("SELECT state, region FROM states WHERE region = 'ASIA'"),
    "FLT-11",
)
def _(t):
    return t.states().where(F.col("region") == "ASIA").select("state", "region")


@query(
    "clean_names",
    sql(f"""SELECT customer_id, trim(customer_name) AS original_name, upper(trim(state)) AS state,
                   {title_case(f"regexp_replace(trim(customer_name), '{TITLE}', '')")} AS customer_name
            FROM raw_customers"""),
    "SF-1", "SF-2",
)
def _(t):
    return t.raw_customers().select(
        "customer_id",
        F.trim("customer_name").alias("original_name"),
        cols.clean_code("state").alias("state"),
        cols.clean_person_name("customer_name").alias("customer_name"),
    )


@query(
    "parsed_timestamps",
    f"""SELECT l_suppkey AS competitor, {ts('min(l_shipdate)', 'first_seen')}, {ts('max(l_shipdate)', 'last_seen')}
        FROM lineitem GROUP BY 1""",
    "SF-4",
)
def _(t):
    seen = F.to_timestamp("collected_at")
    return t.raw_offers().groupBy("competitor").agg(F.min(seen).alias("first_seen"), F.max(seen).alias("last_seen"))


@query(
    "calendar",
    f"""SELECT event_id, {day('ts', 'sale_date')}, hour(ts) AS sale_hour, dayofweek(ts) + 1 AS weekday_no,
               {weekday_case('dayofweek(ts) + 1')} AS weekday FROM events""",
    "SF-5", "SF-6",
)
def _(t):
    df = cols.with_calendar(t.table("events"), "ts")
    return df.select("event_id", "sale_date", "sale_hour", "weekday_no", "weekday")


@query(
    "day_parts",
    """SELECT CASE WHEN hour(ts) >= 18 THEN 'noite' WHEN hour(ts) >= 12 THEN 'tarde'
                   WHEN hour(ts) >= 6 THEN 'manha' ELSE 'madrugada' END AS part_of_day,
              count(*) AS n_rows FROM events GROUP BY 1""",
    "SF-14",
)
def _(t):
    return agg.value_counts(t.table("events").withColumn("part_of_day", cols.day_part(F.hour("ts"))), "part_of_day")


@query(
    "price_bands",
    """SELECT p_partkey, CASE WHEN p_retailprice > 975 THEN 'PREMIUM' WHEN p_retailprice > 925 THEN 'MEDIO'
                              ELSE 'BASICO' END AS price_band FROM part""",
    "SF-7",
)
def _(t):
    band = cols.banded(money.amount("p_retailprice"), PRICE_BANDS, fixed.LOWEST_PRICE_BAND, inclusive=False)
    return t.table("part").select("p_partkey", band.alias("price_band"))


@query(
    "price_positions",
    sql("SELECT price_position, count(*) AS n_rows FROM competitiveness GROUP BY 1"),
    "SF-8", "QY-25", "AG-16",
)
def _(t):
    from ..operators.pricing import market_profile

    joined = t.products().join(market_profile(t.unflagged_offers()), "product_id")
    position = cols.price_position("list_price", "lowest_price", "mean_price", "highest_price")
    return agg.value_counts(joined.withColumn("price_position", position), "price_position")


@query(
    "filled_labels",
    sql(f"""SELECT coalesce(p.category, '{fixed.UNREGISTERED_GROUP}') AS category, count(*) AS n_rows
            FROM raw_lines r LEFT JOIN products p USING (product_id) GROUP BY 1"""),
    "SF-9",
)
def _(t):
    per_key = t.raw_lines().groupBy("product_id").agg(F.count("*").alias("n"))
    joined = per_key.join(t.products().select("product_id", "category"), "product_id", "left")
    label = F.coalesce("category", F.lit(fixed.UNREGISTERED_GROUP)).alias("category")
    return joined.groupBy(label).agg(F.sum("n").alias("n_rows"))


@query(
    "percent_differences",
    sql(f"""SELECT product_id, {shown('mean_cents', 'mean_price')},
                   {pct('mean_cents - low_cents', 'low_cents', 2, 'mean_vs_lowest_pct')},
                   {pct('low_cents - high_cents', 'high_cents', 2, 'lowest_vs_highest_pct')} FROM market"""),
    "SF-10", "AG-10",
)
def _(t):
    from ..operators.pricing import market_profile

    return market_profile(t.unflagged_offers()).select(
        "product_id",
        "mean_price",
        money.percent_above("mean_price", "lowest_price").alias("mean_vs_lowest_pct"),
        money.percent_above("lowest_price", "highest_price").alias("lowest_vs_highest_pct"),
    )


@query(
    "suspicious_prices",
    sql("""SELECT p.product_id, count(*) AS n_offers, count(*) FILTER (WHERE r.offer_cents * 10 < p.list_cents * 6)
                  AS n_suspicious
           FROM raw_offers r JOIN products p USING (product_id) GROUP BY 1"""),
    "SF-11", "DQ-7",
)
def _(t):
    own = t.products().select("product_id", "list_price")
    cents = money.price_cents("competitor_price").alias("cents")
    prices = t.raw_offers().groupBy("product_id", cents).agg(F.count("*").alias("n"))
    priced = prices.withColumn("competitor_price", money.from_cents("cents", money.AMOUNT))
    low = money.is_below_share("competitor_price", "list_price", Decimal("0.6"))
    return priced.join(own, "product_id").groupBy("product_id").agg(
        F.sum("n").alias("n_offers"), F.sum(F.when(low, F.col("n")).otherwise(0)).alias("n_suspicious")
    )


@query(
    "sales_before_registration",
    sql(f"""SELECT order_id, line_no, product_id, {ts('sold_at', 'sold_at')}, {shown('cents', 'revenue')}
            FROM flagged WHERE is_before_registration"""),
    "SF-12", "DQ-6",
)
def _(t):
    df = t.flagged_sales().where("is_before_registration")
    return df.select("order_id", "line_no", "product_id", "sold_at", "revenue")
