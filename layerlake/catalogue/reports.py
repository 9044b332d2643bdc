"""The business questions of the three departments and the quality page."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import money
from ..operators import aggregates as agg
from ..operators import ranking
from ..operators.joins import without_facts
from ..operators.pricing import market_profile
from ..plans import marts
from ..session import materialize
from .datasets import detailed, scorecard, ticket
from .joins import t_segments
from .reference_sql import big, day, half_up, pct, shown, sql, ts
from .registry import query

RAW_CENTS = "sum(r.quantity * r.unit_cents)"


# -- sales ------------------------------------------------------------------


@query("sale_by_key", sql(f"""SELECT order_id, line_no, product_id, quantity, {shown('unit_cents', 'unit_price')}
                              FROM raw_lines WHERE order_id = 1203"""), "QY-6")
def _(t):
    """Pushed down as an equality on the order key."""
    return t.raw_lines().where(F.col("order_id") == 1203).select(
        "order_id", "line_no", "product_id", "quantity", "unit_price"
    )


@query("product_by_key", sql("""SELECT product_id, product_name, category, brand FROM products
                                WHERE product_id = 77"""), "QY-6")
def _(t):
    return t.products().where("product_id = 77").select("product_id", "product_name", "category", "brand")


@query("offers_by_key", sql(f"""SELECT product_id, competitor, {shown('offer_cents', 'competitor_price')}
                                FROM offers WHERE product_id = 77"""), "QY-6")
def _(t):
    return t.offers().where("product_id = 77").select("product_id", "competitor", "competitor_price")


@query(
    "raw_channel_totals",
    sql(f"""SELECT channel, count(*) AS n_sales, {shown('sum(cents)', 'revenue')},
                   CAST({half_up('sum(cents)', 'count(*)')} AS DOUBLE) / 100 AS avg_ticket
            FROM raw_sales GROUP BY 1"""),
    "QY-4",
)
def _(t):
    return agg.sales_totals(t.raw_priced(), ["channel"]).orderBy(F.desc("revenue"))


@query(
    "top_products_by_name",
    sql(f"""SELECT p.product_name, p.category, {big('sum(r.quantity)', 'items')}, {shown(RAW_CENTS, 'revenue')}
            FROM raw_lines r JOIN products p ON r.product_id = p.product_id
            GROUP BY p.product_name, p.category
            ORDER BY {RAW_CENTS} DESC, p.product_name, p.category LIMIT 10"""),
    "QY-8",
)
def _(t):
    per_id = marts.product_totals(t.raw_priced())
    named = per_id.join(t.products().select("product_id", "product_name", "category"), "product_id")
    totals = named.groupBy("product_name", "category").agg(
        F.sum("items").alias("items"), money.total("revenue").alias("revenue")
    )
    return ranking.top_n(totals, [F.desc("revenue"), "product_name", "category"], 10)


@query(
    "top_categories",
    sql(f"""SELECT category, {shown('sum(cents)', 'revenue')} FROM performance
            GROUP BY category ORDER BY sum(cents) DESC, category LIMIT 3"""),
    "QY-7",
)
def _(t):
    perf = marts.product_performance(t.line_sales(), t.products(), ranked=False)
    totals = perf.groupBy("category").agg(money.total("revenue").alias("revenue"))
    return ranking.top_n(totals, [F.desc("revenue"), "category"], 3)


@query(
    "revenue_by_brand",
    sql(f"""SELECT p.brand, {shown(RAW_CENTS, 'revenue')} FROM raw_lines r
            JOIN products p ON r.product_id = p.product_id GROUP BY 1"""),
    "QY-28",
)
def _(t):
    per_id = marts.product_totals(t.raw_priced())
    named = per_id.join(t.products().select("product_id", "brand"), "product_id")
    return named.groupBy("brand").agg(money.total("revenue").alias("revenue"))


@query(
    "channel_ticket_by_weekday",
    sql(f"""SELECT weekday_no, weekday, CAST({half_up('sum(cents)', 'count(*)')} AS DOUBLE) / 100 AS avg_ticket
            FROM event_sales WHERE channel = 'purchase' GROUP BY ALL"""),
    "QY-28",
)
def _(t):
    shop = t.event_sales().where(F.col("channel") == "purchase")
    return agg.sales_totals(shop, ["weekday_no", "weekday"]).select("weekday_no", "weekday", "avg_ticket")


@query(
    "never_sold_products",
    sql("""SELECT p.product_id, p.product_name FROM products p
           LEFT JOIN raw_lines s ON p.product_id = s.product_id
           WHERE s.product_id IS NULL"""),
    "JN-4", "QY-28",
)
def _(t):
    # repeats of a sale do not matter to the question, so lines are only reduced to their ids
    unsold = without_facts(t.products(), t.raw_lines().select("product_id").distinct(), "product_id")
    return unsold.select("product_id", "product_name")


@query(
    "daily_revenue_by_channel",
    sql(f"""SELECT {day('sale_date', 'sale_date')}, channel, {shown('sum(cents)', 'revenue')}
            FROM over_time GROUP BY ALL"""),
    "QY-29",
)
def _(t):
    return (
        marts.sales_over_time(t.event_sales())
        .groupBy("sale_date", "channel")
        .agg(money.total("revenue").alias("revenue"))
    )


@query("total_revenue", sql(f"SELECT {shown('sum(cents)', 'revenue')} FROM over_time"), "QY-20")
def _(t):
    return marts.sales_over_time(t.event_sales()).agg(money.total("revenue").alias("revenue"))


@query(
    "kpi_tiles",
    sql(f"""SELECT {big('sum(n_sales)', 'n_sales')}, {shown('sum(cents)', 'revenue')},
                   CAST({half_up('sum(cents)', 'CAST(sum(n_sales) AS BIGINT)')} AS DOUBLE) / 100 AS avg_ticket,
                   {day('max(sale_date)', 'as_of')} FROM over_time"""),
    "QY-29", "SF-16",
)
def _(t):
    """``as_of`` is the last day in the data; today's date plays no part."""
    row = marts.sales_over_time(t.event_sales()).agg(
        F.sum("n_sales").alias("n_sales"), money.total("revenue").alias("revenue"), F.max("sale_date").alias("as_of")
    )
    return row.withColumn("avg_ticket", money.mean("revenue", "n_sales"))


@query(
    "latest_hours",
    sql(f"""SELECT {day('sale_date', 'sale_date')}, sale_hour, channel, n_sales FROM over_time
            ORDER BY over_time.sale_date DESC, sale_hour DESC, channel LIMIT 20"""),
    "QY-25", "ST-1",
)
def _(t):
    rows = marts.sales_over_time(t.event_sales())
    order = [F.desc("sale_date"), F.desc("sale_hour"), "channel"]
    return ranking.top_n(rows, order, 20).select("sale_date", "sale_hour", "channel", "n_sales")


# -- customers --------------------------------------------------------------


def _raw_customer_totals(t):
    """Sales and revenue per customer from the raw lines."""
    orders = t.raw_order_totals()
    return orders.groupBy("customer_id").agg(
        F.sum("n_sales").alias("n_sales"), money.total_of(orders, "revenue").alias("revenue")
    )


@query(
    "top_customer_ids",
    sql(f"""SELECT customer_id, {shown('sum(cents)', 'revenue')} FROM raw_sales
            GROUP BY 1 ORDER BY sum(cents) DESC, customer_id LIMIT 10"""),
    "QY-10",
)
def _(t):
    return ranking.top_n(_raw_customer_totals(t), [F.desc("revenue"), "customer_id"], 10).drop("n_sales")


@query(
    "top_customer_names",
    sql(f"""SELECT c.customer_name, c.state, count(*) AS n_sales, {shown('sum(s.cents)', 'revenue')},
                   CAST({half_up('sum(s.cents)', 'count(*)')} AS DOUBLE) / 100 AS avg_ticket
            FROM raw_sales s JOIN customers c ON s.customer_id = c.customer_id
            GROUP BY 1, 2 ORDER BY sum(s.cents) DESC, 1, 2 LIMIT 10"""),
    "QY-10",
)
def _(t):
    per_id = _raw_customer_totals(t)
    named = per_id.join(t.customers().select("customer_id", "customer_name", "state"), "customer_id")
    totals = named.groupBy("customer_name", "state").agg(
        F.sum("n_sales").alias("n_sales"), money.total("revenue").alias("revenue")
    )
    out = ranking.top_n(totals, [F.desc("revenue"), "customer_name", "state"], 10)
    return out.withColumn("avg_ticket", money.mean("revenue", "n_sales"))


@query(
    "top_customers_by_rank",
    sql(f"""SELECT revenue_rank, customer_name, state, {shown('cents', 'revenue')} FROM segments
            WHERE revenue_rank <= 5"""),
    "QY-10", "ST-4",
)
def _(t):
    best = ranking.top_ranked(t_segments(t), [F.desc("revenue"), "customer_id"], 5, "revenue_rank")
    return best.select("revenue_rank", "customer_name", "state", "revenue")


@query(
    "revenue_by_state",
    sql(f"""SELECT c.state, count(DISTINCT c.customer_id) AS customers, {shown('sum(s.cents)', 'revenue')}
            FROM raw_sales s JOIN customers c ON s.customer_id = c.customer_id GROUP BY 1"""),
    "QY-11", "QY-29",
)
def _(t):
    per_id = _raw_customer_totals(t)
    named = per_id.join(t.customers().select("customer_id", "state"), "customer_id")
    return named.groupBy("state").agg(F.count("*").alias("customers"), money.total("revenue").alias("revenue"))


@query(
    "revenue_by_region",
    sql(f"""SELECT region, count(*) AS customers, {shown('sum(cents)', 'revenue')} FROM segments GROUP BY 1"""),
    "QY-11",
)
def _(t):
    return t_segments(t).groupBy("region").agg(
        F.count("*").alias("customers"), money.total("revenue").alias("revenue")
    )


@query(
    "segments_from_raw",
    sql(f"""SELECT c.customer_name, {shown('sum(s.cents)', 'revenue')},
                   CASE WHEN sum(s.cents) >= 210000000 THEN 'VIP' WHEN sum(s.cents) >= 128000000 THEN 'TOP_TIER'
                        ELSE 'REGULAR' END AS segment
            FROM raw_sales s JOIN customers c ON s.customer_id = c.customer_id GROUP BY 1"""),
    "QY-16",
)
def _(t):
    from ..functions.columns import banded
    from ..plans.bindings import SEGMENTS

    per_id = _raw_customer_totals(t)
    named = per_id.join(t.customers().select("customer_id", "customer_name"), "customer_id")
    totals = named.groupBy("customer_name").agg(money.total("revenue").alias("revenue"))
    return totals.withColumn("segment", banded("revenue", SEGMENTS, fixed.LOWEST_SEGMENT, inclusive=True))


@query(
    "revenue_by_region_and_category",
    sql(f"""SELECT region, category, count(*) AS n_sales, {shown('sum(cents)', 'revenue')}
            FROM detailed GROUP BY ALL"""),
    "QY-31",
)
def _(t):
    return agg.sales_totals(detailed(t), ["region", "category"]).drop("avg_ticket")


@query(
    "preferred_channel_per_segment",
    sql(f"""SELECT segment, channel, n_sales, {shown('cents', 'revenue')} FROM
            (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY n_sales DESC, channel) AS rn
             FROM (SELECT segment, channel, count(*) AS n_sales, sum(cents) AS cents
                   FROM detailed GROUP BY ALL)) WHERE rn = 1"""),
    "QY-31", "WN-2",
)
def _(t):
    totals = agg.sales_totals(detailed(t), ["segment", "channel"]).drop("avg_ticket")
    return ranking.top_k_per_group(totals, ["segment"], [F.desc("n_sales"), "channel"], 1).drop("rank")


# -- pricing ----------------------------------------------------------------


@query(
    "own_and_competitor_prices",
    sql(f"""SELECT p.product_name, {shown('p.list_cents', 'list_price')}, o.competitor,
                   {shown('o.offer_cents', 'competitor_price')}
            FROM products p JOIN offers o ON p.product_id = o.product_id WHERE p.product_id = 77"""),
    "QY-12", "JN-10",
)
def _(t):
    """The key filter reaches both scans through the join."""
    both = t.products().join(t.offers(), "product_id").where("product_id = 77")
    return both.select("product_name", "list_price", "competitor", "competitor_price")


@query(
    "dearer_than_all",
    sql(f"""SELECT p.product_id, p.product_name, p.category, {shown('p.list_cents', 'list_price')},
                   {shown('max(o.offer_cents)', 'highest_price')}, count(o.competitor) AS n_offers
            FROM products p JOIN offers o ON p.product_id = o.product_id GROUP BY ALL
            HAVING p.list_cents > max(o.offer_cents)"""),
    "QY-15", "FLT-8", "QY-29",
)
def _(t):
    market = market_profile(t.unflagged_offers()).select("product_id", "highest_price", "n_offers")
    ours = t.products().select("product_id", "product_name", "category", "list_price")
    return ours.join(market, "product_id").where(F.col("list_price") > F.col("highest_price"))


@query(
    "cheaper_position_by_category",
    sql(f"""SELECT category, count(*) AS n_products FROM competitiveness
            WHERE price_position = '{fixed.CHEAPER_THAN_ALL}' GROUP BY ALL"""),
    "QY-15", "QY-25",
)
def _(t):
    out = marts.competitiveness(t.products(), t.unflagged_offers(), t.line_sales())
    cheaper = out.where(F.col("price_position") == fixed.CHEAPER_THAN_ALL)
    return cheaper.groupBy("category").agg(F.count("*").alias("n_products"))


@query(
    "top_sellers_above_market",
    sql(f"""SELECT v.revenue_rank, v.product_name, {shown('p.list_cents', 'list_price')},
                   {shown('p.mean_cents', 'mean_price')}, p.diff_pct_vs_mean
            FROM performance v JOIN competitiveness p ON v.product_id = p.product_id
            WHERE v.revenue_rank <= 50 AND p.diff_pct_vs_mean > 0"""),
    "QY-23", "JN-9",
)
def _(t):
    sales, products = t.line_sales(), t.products()
    best = ranking.top_ranked(marts.product_totals(sales), [F.desc("revenue"), "product_id"], 50, "revenue_rank")
    market = marts.competitiveness(products, t.unflagged_offers(), sales).where(F.col("diff_pct_vs_mean") > 0)
    joined = best.select("product_id", "revenue_rank").join(market, "product_id")
    return joined.select("revenue_rank", "product_name", "list_price", "mean_price", "diff_pct_vs_mean")


@query(
    "cheapest_competitor_on_average",
    sql(f"""SELECT competitor, CAST({half_up('sum(offer_cents)', 'count(*)')} AS DOUBLE) / 100 AS mean_price
            FROM offers GROUP BY 1
            ORDER BY {half_up('sum(offer_cents)', 'count(*)')}, competitor LIMIT 1"""),
    "QY-28",
)
def _(t):
    means = (
        t.unflagged_offers()
        .groupBy("competitor")
        .agg(money.from_cents(F.sum("competitor_price_cents")).alias("s"), F.count("*").alias("n"))
        .select("competitor", money.mean("s", "n").alias("mean_price"))
    )
    return ranking.top_n(means, ["mean_price", "competitor"], 1)


@query(
    "watched_products",
    sql("""SELECT count(DISTINCT product_id) AS n_products, count(DISTINCT CASE WHEN is_suspicious THEN product_id END)
                  AS n_with_suspicious_price FROM offers"""),
    "QY-29",
)
def _(t):
    """Some price of a product is suspicious exactly when its lowest one is."""
    profile = market_profile(t.unflagged_offers())
    own = t.products().select("product_id", "list_price")
    low = money.is_below_share("lowest_price", "list_price", fixed.SUSPICIOUS_SHARE)
    return profile.join(own, "product_id", "left").agg(
        F.count("*").alias("n_products"), F.count_if(low).alias("n_with_suspicious_price")
    )


# -- quality ----------------------------------------------------------------


@query(
    "alerts_by_revenue",
    sql(f"""SELECT rule, affected_rows, {shown('cents', 'affected_revenue')} FROM scorecard
            WHERE severity = 'ALERTA' AND cents IS NOT NULL"""),
    "QY-24", "FLT-4",
)
def _(t):
    alerts = scorecard(t).where((F.col("severity") == fixed.ALERT) & F.col("affected_revenue").isNotNull())
    return alerts.select("rule", "affected_rows", "affected_revenue").orderBy(F.desc("affected_revenue"))


@query(
    "alerts_by_table",
    sql(f"""SELECT table_name, count(*) AS n_alerts, {big('sum(affected_rows)', 'affected_rows')}
            FROM scorecard WHERE severity = 'ALERTA' GROUP BY 1"""),
    "QY-24", "AG-17",
)
def _(t):
    alerts = scorecard(t).where(F.col("severity") == fixed.ALERT)
    return alerts.groupBy("table_name").agg(
        F.count("*").alias("n_alerts"), F.sum("affected_rows").alias("affected_rows")
    )


@query(
    "total_affected_revenue",
    sql(f"""SELECT {shown('sum(cents)', 'affected_revenue')}, count(*) AS n_rules FROM scorecard
            WHERE cents IS NOT NULL"""),
    "QY-24",
)
def _(t):
    with_revenue = scorecard(t).where(F.col("affected_revenue").isNotNull())
    return with_revenue.agg(
        money.total("affected_revenue").alias("affected_revenue"), F.count("*").alias("n_rules")
    )


@query(
    "layer_totals",
    sql(f"""SELECT 'sales' AS layer, {shown('sum(cents)', 'revenue')} FROM sales
            UNION ALL SELECT 'product performance', {shown('sum(cents)', 'revenue')} FROM performance
            UNION ALL SELECT 'customer segments', {shown('sum(cents)', 'revenue')} FROM segments
            UNION ALL SELECT 'region and channel', {shown('sum(cents)', 'revenue')} FROM region_channel
            UNION ALL SELECT 'sales over time', {shown('sum(cents)', 'revenue')}
              FROM (SELECT sum(cents) AS cents FROM sales GROUP BY sale_date, sale_hour, channel)
            UNION ALL SELECT 'detailed sales', {shown('sum(cents)', 'revenue')} FROM detailed"""),
    "QY-26", "SO-3",
)
def _(t):
    sales, people = materialize(t.sales()), t.customers()  # read by every layer
    products, by_customer = t.products(), t_segments(t, sales, people)
    return agg.tagged_totals(
        {
            "sales": sales,
            "product performance": marts.product_performance(sales, products, ranked=False),
            "customer segments": by_customer,
            "region and channel": marts.sales_by_region_and_channel(sales, people),
            "sales over time": marts.sales_over_time(sales),
            "detailed sales": marts.detailed_sales(sales, products, by_customer),
        }
    )
