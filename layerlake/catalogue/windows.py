"""Window, ordering and top-k queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import money
from ..operators import aggregates as agg
from ..operators import ranking
from ..plans import marts
from .reference_sql import big, day, half_up, pct, shown, sql, ts
from .registry import query


@query(
    "global_product_rank",
    sql(f"""SELECT product_id, {shown('cents', 'revenue')},
                   row_number() OVER (ORDER BY cents DESC, product_id) AS revenue_rank FROM product_totals"""),
    "WN-1",
)
def _(t):
    totals = marts.product_totals(t.line_sales()).select("product_id", "revenue")
    return ranking.global_rank(totals, [F.desc("revenue"), "product_id"], "revenue_rank")


@query(
    "rank_in_category",
    sql(f"""SELECT t.product_id, p.category, {shown('t.cents', 'revenue')},
                   row_number() OVER (PARTITION BY p.category ORDER BY t.cents DESC, t.product_id) AS position
            FROM product_totals t JOIN products p ON t.product_id = p.product_id"""),
    "WN-2", "WN-3",
)
def _(t):
    totals = marts.product_totals(t.line_sales()).select("product_id", "revenue")
    joined = totals.join(t.products().select("product_id", "category"), "product_id")
    return ranking.rank_within(joined, "category", [F.desc("revenue"), "product_id"], "position")


@query(
    "channel_share",
    sql(f"""SELECT channel, {shown('sum(quantity * unit_cents)', 'revenue')},
                   {pct('sum(quantity * unit_cents)', '(SELECT sum(quantity * unit_cents) FROM raw_lines)', 1, 'share_pct')}
            FROM raw_lines GROUP BY 1"""),
    "WN-4", "QY-18",
)
def _(t):
    totals = agg.sales_totals(t.raw_priced(), ["channel"]).select("channel", "revenue")
    return agg.share_of_total(totals, "revenue")


@query(
    "day_over_day",
    sql(f"""SELECT {day('sale_date', 'sale_date')}, {shown('c', 'revenue')}, {shown('p', 'previous_revenue')},
                   {pct('c - p', 'p', 1, 'change_pct')}
            FROM (SELECT *, lag(c) OVER (ORDER BY sale_date) AS p
                  FROM (SELECT sale_date, CAST(sum(cents) AS BIGINT) AS c FROM event_sales GROUP BY 1))"""),
    "WN-5", "QY-19",
)
def _(t):
    daily = agg.sales_totals(t.event_sales(), ["sale_date"]).select("sale_date", "revenue")
    return agg.day_over_day(daily)


@query(
    "hour_over_hour",
    sql(f"""SELECT {day('sale_date', 'sale_date')}, sale_hour, {shown('c', 'revenue')}, {shown('p', 'previous_revenue')},
                   {pct('c - p', 'p', 1, 'change_pct')}
            FROM (SELECT *, lag(c) OVER (ORDER BY sale_date, sale_hour) AS p
                  FROM (SELECT sale_date, sale_hour, CAST(sum(cents) AS BIGINT) AS c FROM event_sales GROUP BY ALL))"""),
    "WN-5", "QY-19",
)
def _(t):
    hourly = agg.sales_totals(t.event_sales(), ["sale_date", "sale_hour"]).select("sale_date", "sale_hour", "revenue")
    return agg.period_over_period(hourly, ["sale_date", "sale_hour"])


@query(
    "product_month_over_month",
    sql(f"""SELECT product_id, month, {shown('c', 'revenue')}, {shown('p', 'previous_revenue')}, {pct('c - p', 'p', 1, 'change_pct')}
            FROM (SELECT *, lag(c) OVER (PARTITION BY product_id ORDER BY month) AS p
                  FROM (SELECT product_id, strftime(sale_date, '%Y-%m') AS month, CAST(sum(cents) AS BIGINT) AS c
                        FROM sales GROUP BY ALL))"""),
    "WN-5",
)
def _(t):
    monthly = agg.sales_totals(t.sales(), ["product_id", F.date_format("sale_date", "yyyy-MM").alias("month")])
    return agg.period_over_period(monthly.select("product_id", "month", "revenue"), ["month"], "product_id")


@query(
    "sampled_orders",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders ORDER BY md5('7:' || o_orderkey), o_orderkey LIMIT 25""",
    "ST-6",
)
def _(t):
    orders = t.raw_orders().select("order_id", "customer_id")
    return ranking.sampled(orders, 25, ["order_id"], seed=7)


@query(
    "sampled_lines_per_channel",
    sql("""SELECT channel, order_id, line_no FROM single_lines
           QUALIFY row_number() OVER (PARTITION BY channel ORDER BY md5('3:' || order_id || ':' || line_no), order_id, line_no) <= 10"""),
    "ST-6",
)
def _(t):
    lines = t.single_lines().select("channel", "order_id", "line_no")
    return ranking.sampled(lines, 10, ["order_id", "line_no"], seed=3, group=["channel"])


@query(
    "shared_name_rows",
    sql("""SELECT product_id, product_name, same_name FROM
           (SELECT *, count(*) OVER (PARTITION BY product_name) AS same_name FROM products) WHERE same_name > 1"""),
    "WN-6", "FLT-10", "DQ-9",
)
def _(t):
    products = t.products().select("product_id", "product_name")
    counts = products.groupBy("product_name").agg(F.count("*").alias("same_name")).where("same_name > 1")
    return products.join(counts, "product_name")


@query(
    "latest_order_per_customer",
    f"""SELECT customer_id, order_id, {ts('sold_at', 'sold_at')} FROM
        (SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_orderdate AS sold_at,
                row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
         FROM orders) WHERE rn = 1""",
    "WN-7", "FLT-10",
)
def _(t):
    from ..operators.dedup import latest_by_key

    return latest_by_key(t.raw_orders(), ["customer_id"], "sold_at")


_SALE = f"order_id, line_no, channel, quantity, {shown('unit_cents', 'unit_price')}, {shown('quantity * unit_cents', 'revenue')}"
_ORDER = "ORDER BY quantity * unit_cents DESC, order_id, line_no, product_id, unit_cents"


def _sale_columns(df):
    return df.select("order_id", "line_no", "channel", "quantity", "unit_price", "revenue")


def _largest(df, n):
    order = [F.desc("revenue"), "order_id", "line_no", "product_id", "unit_price"]
    return _sale_columns(ranking.top_n(df, order, n))


@query("largest_sales", sql(f"SELECT {_SALE} FROM raw_lines {_ORDER} LIMIT 10"), "ST-1", "ST-2", "QY-2")
def _(t):
    return _largest(t.raw_priced(), 10)


@query(
    "largest_sales_of_channel",
    sql(f"SELECT {_SALE} FROM raw_lines WHERE channel = 'F' {_ORDER} LIMIT 10"),
    "ST-2", "QY-2",
)
def _(t):
    return _largest(t.raw_priced().where(F.col("channel") == "F"), 10)


@query(
    "largest_sales_of_channel_small_baskets",
    sql(f"SELECT {_SALE} FROM raw_lines WHERE channel = 'F' AND quantity > 1 {_ORDER} LIMIT 10"),
    "ST-2", "QY-2",
)
def _(t):
    return _largest(t.raw_priced().where((F.col("channel") == "F") & (F.col("quantity") > 1)), 10)


@query(
    "smallest_sales",
    sql(f"SELECT {_SALE} FROM raw_lines ORDER BY quantity * unit_cents, order_id, line_no, product_id, unit_cents LIMIT 10"),
    "ST-3",
)
def _(t):
    order = ["revenue", "order_id", "line_no", "product_id", "unit_price"]
    return _sale_columns(ranking.top_n(t.raw_priced(), order, 10))


@query(
    "top_products_by_rank",
    sql(f"""SELECT revenue_rank, product_id, product_name, category, {shown('cents', 'revenue')}
            FROM performance WHERE revenue_rank <= 5"""),
    "ST-4", "QY-8",
)
def _(t):
    products = marts.product_performance(t.line_sales(), t.products(), ranked=False)
    best = ranking.top_ranked(products, [F.desc("revenue"), "product_id"], 5, "revenue_rank")
    return best.select("revenue_rank", "product_id", "product_name", "category", "revenue")


@query(
    "top_three_per_category",
    sql(f"""SELECT * FROM (
              SELECT p.category, p.product_name, {shown('sum(r.quantity * r.unit_cents)', 'revenue')},
                     row_number() OVER (PARTITION BY p.category
                       ORDER BY sum(r.quantity * r.unit_cents) DESC, p.product_name) AS rank_in_category
              FROM raw_lines r JOIN products p ON r.product_id = p.product_id
              GROUP BY p.category, p.product_name) WHERE rank_in_category <= 3"""),
    "ST-5", "WN-3", "FLT-10", "QY-17",
)
def _(t):
    per_id = marts.product_totals(t.raw_priced()).join(
        t.products().select("product_id", "product_name", "category"), "product_id"
    )
    named = per_id.groupBy("category", "product_name").agg(money.total("revenue").alias("revenue"))
    return ranking.top_k_per_group(
        named, ["category"], [F.desc("revenue"), "product_name"], 3, "rank_in_category"
    )
