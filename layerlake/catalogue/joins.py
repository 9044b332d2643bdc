"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import money
from ..operators import aggregates as agg
from ..operators import checks, joins, pricing, ranking, segments, terms
from ..plans import marts
from ..session import materialize
from .reference_sql import big, day, half_up, pct, shown, sql
from .registry import query


@query(
    "inner_join_categories",
    sql(f"""SELECT p.category, count(*) AS n_sales, {shown('sum(r.quantity * r.unit_cents)', 'revenue')}
            FROM raw_lines r JOIN products p USING (product_id) GROUP BY 1"""),
    "JN-1", "QY-7",
)
def _(t):
    per_key = marts.product_totals(t.raw_priced())
    joined = per_key.join(t.products().select("product_id", "category"), "product_id")
    return joined.groupBy("category").agg(F.sum("n_sales").alias("n_sales"), money.total("revenue").alias("revenue"))


@query(
    "left_join_keeps_sales",
    sql(f"""SELECT s.channel, count(*) AS n_sales, count(p.product_id) AS n_registered,
                   {shown('sum(s.cents)', 'revenue')}
            FROM sales s LEFT JOIN products p ON s.product_id = p.product_id GROUP BY 1"""),
    "JN-2", "AG-6",
)
def _(t):
    side = t.products().select("product_id", F.lit(True).alias("known"))
    per_key = t.line_sales().groupBy("channel", "product_id").agg(
        F.count("*").alias("n"), F.sum("revenue_cents").alias("r")
    )
    return per_key.join(side, "product_id", "left").groupBy("channel").agg(
        F.sum("n").alias("n_sales"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("n_registered"),
        money.from_cents(F.sum("r")).alias("revenue"),
    )


@query(
    "customers_with_recent_revenue",
    sql(f"""SELECT c.customer_id, count(s.customer_id) AS n_sales, {shown('coalesce(sum(s.cents), 0)', 'revenue')},
                   CAST({half_up('sum(s.cents)', 'count(s.customer_id)')} AS DOUBLE) / 100 AS avg_ticket,
                   {day('min(s.sale_date)', 'first_purchase')}, {day('max(s.sale_date)', 'last_purchase')},
                   CASE WHEN coalesce(sum(s.cents), 0) >= 30000000 THEN 'VIP'
                        WHEN coalesce(sum(s.cents), 0) >= 10000000 THEN 'TOP_TIER' ELSE 'REGULAR' END AS segment
            FROM customers c
            LEFT JOIN (SELECT * FROM sales WHERE sale_date >= DATE '2001-07-01') s
              ON c.customer_id = s.customer_id
            GROUP BY c.customer_id"""),
    "JN-3",
)
def _(t):
    recent = t.order_sales().where(F.col("sale_date") >= F.lit("2001-07-01").cast("date"))
    bands = [(300000, "VIP"), (100000, "TOP_TIER")]
    return segments.customer_segments(t.customers().select("customer_id"), recent, segments=bands)


@query(
    "orphan_sales",
    sql(f"""SELECT r.order_id, r.line_no, r.product_id, {shown('r.quantity * r.unit_cents', 'revenue')}
            FROM raw_lines r LEFT JOIN products p ON r.product_id = p.product_id
            WHERE p.product_id IS NULL"""),
    "JN-4", "QY-9",
)
def _(t):
    lost = joins.orphans(t.raw_priced(), t.products(), "product_id")
    return lost.select("order_id", "line_no", "product_id", "revenue")


@query(
    "brand_mentions",
    sql("SELECT product_id, product_name, brand FROM brand_mismatch"),
    "JN-5", "DQ-8",
)
def _(t):
    found = terms.rows_mentioning_other_term(t.products(), "product_name", "brand")
    return found.select("product_id", "product_name", "brand")


@query(
    "layer_totals_compared",
    sql(f"""SELECT {shown('s.c', 'left_total')}, {shown('p.c', 'right_total')},
                   s.c IS NOT DISTINCT FROM p.c AS is_equal
            FROM (SELECT sum(cents) AS c FROM sales) s, (SELECT sum(cents) AS c FROM performance) p"""),
    "JN-6", "DQ-18",
)
def _(t):
    sales, products = t.line_sales(), t.products()
    pair = checks.totals_pair(sales, marts.product_performance(sales, products, ranked=False))
    return pair.select(
        F.col("left").alias("left_total"),
        F.col("right").alias("right_total"),
        F.col("left").eqNullSafe(F.col("right")).alias("is_equal"),
    )


@query(
    "sale_to_three_dimensions",
    sql(f"""SELECT c.region, p.category, s.segment, count(*) AS n_sales, {shown('sum(f.cents)', 'revenue')}
            FROM sales f LEFT JOIN products p ON f.product_id = p.product_id
            LEFT JOIN customers c ON f.customer_id = c.customer_id
            LEFT JOIN segments s ON f.customer_id = s.customer_id GROUP BY ALL"""),
    "JN-7",
)
def _(t):
    sales, people = materialize(t.sales()), t.customers()  # read twice
    seg = t_segments(t, sales, people)
    totals = sales.groupBy("customer_id", "product_id").agg(
        F.count("*").alias("n"), money.total_of(sales, "revenue").alias("r")
    )
    joined = totals.join(t.products().select("product_id", "category"), "product_id", "left").join(
        seg.select("customer_id", "region", "segment"), "customer_id", "left"
    )
    return joined.groupBy("region", "category", "segment").agg(
        F.sum("n").alias("n_sales"), money.total("r").alias("revenue")
    )


def t_segments(t, sales=None, customers=None, ranked=False):
    """Customer segments of the test tables with the thresholds that suit them."""
    from ..plans.bindings import SEGMENTS

    return marts.customer_segmentation(
        t.customers() if customers is None else customers,
        t.order_sales() if sales is None else sales,
        segments=SEGMENTS,
        ranked=ranked,
    )


@query(
    "join_of_aggregates",
    sql(f"""SELECT p.product_id, m.n_offers, {shown('m.mean_cents', 'mean_price')},
                   {big('coalesce(t.items, 0)', 'items')}, {shown('coalesce(t.cents, 0)', 'revenue')}
            FROM products p JOIN market m ON p.product_id = m.product_id
            LEFT JOIN product_totals t ON p.product_id = t.product_id"""),
    "JN-8",
)
def _(t):
    return marts.competitiveness(t.products(), t.unflagged_offers(), t.line_sales()).select(
        "product_id", "n_offers", "mean_price", "items", "revenue"
    )


@query(
    "top_sellers_with_market",
    sql(f"""SELECT v.revenue_rank, v.product_id, {shown('c.list_cents', 'list_price')},
                   {shown('c.mean_cents', 'mean_price')}, c.diff_pct_vs_mean
            FROM performance v JOIN competitiveness c ON v.product_id = c.product_id
            WHERE v.revenue_rank <= 100"""),
    "JN-9",
)
def _(t):
    sales, products = t.line_sales(), t.products()
    best = ranking.top_ranked(marts.product_totals(sales), [F.desc("revenue"), "product_id"], 100, "revenue_rank")
    market = marts.competitiveness(products, t.unflagged_offers(), sales)
    return best.select("product_id", "revenue_rank").join(market, "product_id").select(
        "revenue_rank", "product_id", "list_price", "mean_price", "diff_pct_vs_mean"
    )


@query(
    "offers_per_product",
    sql(f"""SELECT p.product_id, p.product_name, {shown('p.list_cents', 'list_price')},
                   count(*) AS n_offers, {shown('min(o.offer_cents)', 'lowest_price')}
            FROM products p JOIN offers o ON p.product_id = o.product_id GROUP BY ALL"""),
    "JN-10",
)
def _(t):
    offers = t.unflagged_offers().groupBy("product_id").agg(
        F.count("*").alias("n_offers"), F.min("competitor_price").alias("lowest_price")
    )
    named = t.products().select("product_id", "product_name", "list_price")
    return named.join(offers, "product_id")


@query(
    "join_loss",
    sql(f"""SELECT 'without join' AS variant, {shown('sum(quantity * unit_cents)', 'revenue')} FROM raw_lines
            UNION ALL
            SELECT 'with join', {shown('sum(r.quantity * r.unit_cents)', 'revenue')}
            FROM raw_lines r JOIN products p USING (product_id)"""),
    "DQ-23", "QY-9", "SO-3",
)
def _(t):
    return joins.join_loss(t.raw_priced(), t.products(), "product_id", "revenue")
