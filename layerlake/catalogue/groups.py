"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import money
from ..operators import aggregates as agg
from ..operators import selection
from ..operators.dedup import first_by_key
from ..operators.pricing import difference_to_unrounded_mean, mean_difference_by
from ..operators.segments import customer_totals
from ..plans import marts
from ..plans.bindings import LINE_KEY
from ..session import materialize
from .joins import t_segments
from .reference_sql import big, day, half_up, pct, shown, sql, ts
from .registry import query

TICKET = f"CAST({half_up('sum(cents)', 'count(*)')} AS DOUBLE) / 100 AS avg_ticket"


@query(
    "kpi_row",
    sql(f"""SELECT count(*) AS n_sales, {shown('sum(cents)', 'revenue')}, {TICKET},
                   count(DISTINCT customer_id) AS customers,
                   {ts('min(sold_at)', 'first_sale')}, {ts('max(sold_at)', 'last_sale')} FROM raw_sales"""),
    "AG-1", "QY-3",
)
def _(t):
    # one narrow row per order before customers and times are joined
    row = t.raw_order_totals().agg(
        F.sum("n_sales").alias("n_sales"),
        money.from_cents(F.sum("revenue_cents")).alias("revenue"),
        F.countDistinct("customer_id").alias("customers"),
        F.min("sold_at").alias("first_sale"),
        F.max("sold_at").alias("last_sale"),
    )
    return row.withColumn("avg_ticket", money.mean("revenue", "n_sales"))


@query(
    "totals_by_status",
    """SELECT l_returnflag, l_linestatus, count(*) AS n_rows, CAST(sum(l_quantity) AS BIGINT) AS items,
              CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS price_total
       FROM lineitem GROUP BY ALL""",
    "AG-2", "AG-3",
)
def _(t):
    cents = money.price_cents("l_extendedprice").alias("price_cents")
    lines = t.table("lineitem").select("l_returnflag", "l_linestatus", "l_quantity", cents)
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("items"),
        money.total_of(lines, "price").alias("price_total"),
    )


@query(
    "grouped_by_all_keys",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders FROM orders GROUP BY ALL""",
    "AG-3",
)
def _(t):
    t.table("orders").createOrReplaceTempView("layerlake_orders")
    return t.spark.sql(
        "SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders FROM layerlake_orders GROUP BY ALL"
    )


@query(
    "daily_revenue",
    sql(f"""SELECT {day('CAST(sold_at AS DATE)', 'sale_date')}, count(*) AS n_sales,
                   {shown('sum(cents)', 'revenue')} FROM event_sales GROUP BY CAST(sold_at AS DATE)"""),
    "AG-4", "QY-5",
)
def _(t):
    return agg.sales_totals(t.event_sales(), [F.to_date("sold_at").alias("sale_date")]).drop("avg_ticket")


@query(
    "distinct_customers",
    sql("""SELECT channel, count(DISTINCT customer_id) AS customers, count(DISTINCT product_id) AS products
           FROM raw_sales GROUP BY 1"""),
    "AG-5",
)
def _(t):
    lines = t.raw_lines()
    buyers = lines.select("channel", "order_id").distinct().join(t.raw_orders(), "order_id")
    buyers = buyers.groupBy("channel").agg(F.countDistinct("customer_id").alias("customers"))
    known = lines.join(t.raw_orders().select("order_id"), "order_id", "left_semi")
    products = known.groupBy("channel").agg(F.countDistinct("product_id").alias("products"))
    return buyers.join(products, "channel")


@query(
    "distinct_channels",
    "SELECT DISTINCT l_linestatus AS channel FROM lineitem",
    "AG-7",
)
def _(t):
    return t.raw_lines().select("channel").distinct()


@query(
    "top_segment_share",
    sql(f"""SELECT count(*) FILTER (WHERE segment = 'VIP') AS vip_customers,
                   {shown("sum(cents) FILTER (WHERE segment = 'VIP')", 'vip_revenue')},
                   {pct("(sum(cents) FILTER (WHERE segment = 'VIP'))", 'sum(cents)', 1, 'vip_share_pct')}
            FROM segments"""),
    "AG-8", "QY-21", "QY-28",
)
def _(t):
    vip = F.col("segment") == "VIP"
    row = t_segments(t).agg(
        F.count_if(vip).alias("vip_customers"),
        money.total_where(vip, "revenue").alias("vip_revenue"),
        money.total("revenue").alias("_all"),
    )
    return row.withColumn("vip_share_pct", money.percent("vip_revenue", "_all")).drop("_all")


@query(
    "any_suspicious_offer",
    sql("SELECT product_id, bool_or(is_suspicious) AS has_suspicious_price FROM offers GROUP BY 1"),
    "AG-9",
)
def _(t):
    return t.offers().groupBy("product_id").agg(F.bool_or("is_suspicious").alias("has_suspicious_price"))


@query(
    "unregistered_share",
    sql("SELECT avg(CASE WHEN is_registered THEN 0 ELSE 1 END) AS share FROM flagged"),
    "AG-11",
)
def _(t):
    return agg.share_where(t.sales_by_registration(), ~F.col("is_registered"), weight="n_sales")


@query(
    "channel_tickets_from_daily",
    sql(f"""SELECT channel, CAST(sum(n_sales) AS BIGINT) AS n_sales, {shown('sum(cents)', 'revenue')},
                   CAST({half_up('sum(cents)', 'CAST(sum(n_sales) AS BIGINT)')} AS DOUBLE) / 100 AS avg_ticket
            FROM over_time GROUP BY 1"""),
    "AG-12", "QY-4",
)
def _(t):
    from ..plans.marts import sales_over_time

    out = (
        sales_over_time(t.event_sales())
        .groupBy("channel")
        .agg(F.sum("n_sales").alias("n_sales"), money.total("revenue").alias("revenue"))
    )
    return out.withColumn("avg_ticket", money.mean("revenue", "n_sales"))


@query(
    "weekday_mean_per_day",
    sql(f"""SELECT weekday, weekday_no, {shown('sum(cents)', 'revenue')}, count(DISTINCT sale_date) AS n_days,
                   CAST({half_up('sum(cents)', 'count(DISTINCT sale_date)')} AS DOUBLE) / 100 AS revenue_per_day
            FROM event_sales GROUP BY ALL ORDER BY weekday_no"""),
    "AG-13", "QY-22", "ST-7",
)
def _(t):
    out = agg.mean_per_day(t.event_sales(), ["weekday", "weekday_no"])
    return out.orderBy("weekday_no")


@query(
    "mean_pair_difference_by_category",
    sql(f"""SELECT category, count(DISTINCT product_id) AS n_products,
                   sign(sum(d)) * ((20 * abs(sum(d)) + 1000000 * count(*)) // (2000000 * count(*))) / 10.0
                     AS mean_diff_pct
            FROM (SELECT p.category, p.product_id, CAST(sign(p.list_cents - o.offer_cents) *
                         ((200000000 * abs(CAST(p.list_cents - o.offer_cents AS HUGEINT)) + o.offer_cents)
                          // (2 * o.offer_cents)) AS HUGEINT) AS d
                  FROM products p JOIN offers o ON p.product_id = o.product_id)
            GROUP BY 1"""),
    "AG-14", "QY-14",
)
def _(t):
    return mean_difference_by(t.products(), t.unflagged_offers(), "category")


@query(
    "difference_to_exact_mean",
    sql(f"""SELECT p.product_id, {shown('p.list_cents', 'list_price')}, {shown('m.mean_cents', 'mean_price')},
                   {shown('m.low_cents', 'lowest_price')}, {shown('m.high_cents', 'highest_price')},
                   {pct('p.list_cents * m.n_offers - m.offer_total', 'm.offer_total', 1, 'diff_pct')}
            FROM products p JOIN market m USING (product_id)"""),
    "AG-10", "QY-13",
)
def _(t):
    out = difference_to_unrounded_mean(t.products().select("product_id", "list_price"), t.unflagged_offers())
    return out.drop("n_offers")


@query(
    "deduplicated_lines",
    sql(f"""SELECT order_id, line_no, product_id, supplier_id, channel, quantity,
                   {shown('unit_cents', 'unit_price')} FROM lines"""),
    "AG-15",
)
def _(t):
    return first_by_key(t.raw_lines(), LINE_KEY)


@query(
    "deduplicated_offers",
    sql(f"""SELECT product_id, competitor, {shown('offer_cents', 'competitor_price')},
                   strftime(collected_at, '%Y-%m-%d %H:%M:%S') AS collected_at
            FROM (SELECT *, row_number() OVER (PARTITION BY product_id, competitor
                     ORDER BY offer_cents, collected_at) AS rn FROM raw_offers)
            WHERE rn = 1"""),
    "AG-15",
)
def _(t):
    return first_by_key(t.raw_offers(), ["product_id", "competitor"])


@query(
    "value_counts_price_band",
    sql("SELECT price_band, count(*) AS n_rows FROM products GROUP BY 1"),
    "AG-16", "QY-27",
)
def _(t):
    return agg.value_counts(t.products(), "price_band").orderBy(F.desc("n_rows"), "price_band")


@query(
    "value_counts_region",
    sql("SELECT region, count(*) AS n_rows FROM customers GROUP BY 1"),
    "AG-16", "QY-27",
)
def _(t):
    return agg.value_counts(t.customers(), "region")


@query(
    "value_counts_registered",
    sql("SELECT is_registered, count(*) AS n_rows FROM flagged GROUP BY 1"),
    "AG-16", "QY-27",
)
def _(t):
    return t.sales_by_registration().groupBy("is_registered").agg(F.sum("n_sales").alias("n_rows"))


@query(
    "largest_daily_totals",
    sql(f"""SELECT channel, count(*) AS n_days, {shown('max(c)', 'best_day')}, {shown('min(c)', 'worst_day')},
                   {shown('sum(c)', 'revenue')}
            FROM (SELECT channel, sale_date, sum(cents) AS c FROM event_sales GROUP BY ALL) GROUP BY 1"""),
    "AG-17",
)
def _(t):
    daily = agg.sales_totals(t.event_sales(), ["channel", "sale_date"])
    return daily.groupBy("channel").agg(
        F.count("*").alias("n_days"),
        F.max("revenue").alias("best_day"),
        F.min("revenue").alias("worst_day"),
        money.total("revenue").alias("revenue"),
    )


@query(
    "segment_thresholds",
    sql("""SELECT CAST(q.share AS DOUBLE) AS share, CAST(r.cents AS DOUBLE) / 100 AS revenue
           FROM (SELECT cents, row_number() OVER (ORDER BY cents, customer_id) AS rn, count(*) OVER () AS n
                 FROM (SELECT customer_id, sum(cents) AS cents FROM sales GROUP BY 1)) r
           JOIN (VALUES (30, 0.3), (50, 0.5), (80, 0.8)) AS q(p, share) ON r.rn = (q.p * r.n + 99) // 100"""),
    "AG-18",
)
def _(t):
    totals = customer_totals(t.order_sales())
    return selection.quantiles(totals, "revenue", ["0.3", "0.5", "0.8"])


@query(
    "customers_rolled_up",
    sql("""SELECT channel, count(DISTINCT customer_id) AS customers, true AS is_within_bound FROM event_sales GROUP BY 1
           UNION ALL SELECT 'all', count(DISTINCT customer_id), true FROM event_sales"""),
    "AG-5", "DS-5",
)
def _(t):
    sales = t.event_sales()
    fine = materialize(marts.sales_over_time(sales, sketches=True))  # day, hour and channel
    per_channel = agg.rolled_up(fine, ["channel"], name="estimate")
    whole = agg.rolled_up(per_channel.withColumn("channel", F.lit("all")), ["channel"], name="estimate")
    estimates = per_channel.unionByName(whole).select("channel", "estimate")
    pairs = sales.select("channel", "customer_id").distinct()
    exact = pairs.unionByName(pairs.select("customer_id").distinct().select(F.lit("all").alias("channel"), "customer_id"))
    exact = exact.groupBy("channel").agg(F.count("customer_id").alias("customers"))
    return exact.join(estimates, "channel").select("channel", "customers", agg.is_within_bound("estimate", "customers").alias("is_within_bound"))


@query(
    "segment_distribution",
    sql(f"""SELECT segment, count(*) AS customers, {shown('sum(cents)', 'revenue')},
                   {pct('count(*)', '(SELECT count(*) FROM segments)', 1, 'share_pct')}
            FROM segments GROUP BY 1"""),
    "AG-18", "QY-16",
)
def _(t):
    grouped = t_segments(t).groupBy("segment").agg(
        F.count("*").alias("customers"), money.total("revenue").alias("revenue")
    )
    return agg.share_of_total(grouped, "customers")
