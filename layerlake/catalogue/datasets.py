"""The cleaned tables and the business datasets, whole."""

from __future__ import annotations

from ..functions import money
from ..operators.joins import with_registration_flags
from ..plans import marts
from ..plans.bindings import MIN_COMPETITORS, SEGMENTS
from ..plans.cleaning import clean_offers
from ..session import materialize
from .reference_sql import big, day, half_up, shown, sql, ts
from .registry import query


def ticket(name: str = "ticket_cents") -> str:
    return f"CAST({name} AS DOUBLE) / 100 AS avg_ticket"


@query(
    "clean_products",
    sql(f"""SELECT product_id, product_name, category, brand, {shown('list_cents', 'list_price')}, price_band,
                   {ts('created_at', 'created_at')} FROM products"""),
    "DS-1",
)
def _(t):
    return t.products()


@query(
    "clean_customers",
    sql("SELECT customer_id, customer_name, original_name, state, state_name, region FROM customers"),
    "DS-2",
)
def _(t):
    return t.customers()


@query(
    "clean_competitor_prices",
    sql(f"""SELECT product_id, competitor, {shown('offer_cents', 'competitor_price')},
                   {ts('collected_at', 'collected_at')}, is_suspicious FROM offers"""),
    "DS-3",
)
def _(t):
    return money.without_cents(t.offers())


@query(
    "clean_sales",
    sql(f"""SELECT order_id, line_no, product_id, supplier_id, channel, quantity, customer_id,
                   {shown('unit_cents', 'unit_price')}, {shown('cents', 'revenue')}, {ts('sold_at', 'sold_at')},
                   {day('sale_date', 'sale_date')}, sale_hour, weekday_no, weekday,
                   is_registered, is_before_registration FROM flagged"""),
    "DS-4", "PRJ-2", "PRJ-5",
)
def _(t):
    return money.without_cents(t.flagged_sales())


@query(
    "sales_over_time",
    sql(f"""SELECT {day('sale_date', 'sale_date')}, weekday, weekday_no, sale_hour, channel, n_sales,
                   {big('items', 'items')}, {shown('cents', 'revenue')}, customers FROM over_time"""),
    "DS-5",
)
def _(t):
    return marts.sales_over_time(t.event_sales())


@query(
    "product_performance",
    sql(f"""SELECT product_id, product_name, category, brand, price_band, is_registered, n_sales,
                   {big('items', 'items')}, {shown('cents', 'revenue')}, {ticket()}, revenue_rank, rank_in_category
            FROM performance"""),
    "DS-6",
)
def _(t):
    return marts.product_performance(t.line_sales(), t.products())


@query(
    "customer_segmentation",
    sql(f"""SELECT customer_id, customer_name, state, state_name, region, n_sales, {shown('cents', 'revenue')},
                   {ticket()}, {day('first_purchase', 'first_purchase')}, {day('last_purchase', 'last_purchase')},
                   segment, revenue_rank FROM segments"""),
    "DS-7",
)
def _(t):
    return marts.customer_segmentation(t.customers(), t.order_sales(), segments=SEGMENTS)


@query(
    "price_competitiveness",
    sql(f"""SELECT product_id, product_name, category, brand, {shown('list_cents', 'list_price')},
                   {shown('mean_cents', 'mean_price')}, {shown('low_cents', 'lowest_price')},
                   {shown('high_cents', 'highest_price')}, n_offers, diff_pct_vs_mean, diff_pct_vs_lowest,
                   price_position, has_suspicious_price, {shown('cents', 'revenue')}, {big('items', 'items')}
            FROM competitiveness"""),
    "DS-8",
)
def _(t):
    return marts.competitiveness(t.products(), t.unflagged_offers(), t.line_sales())


@query(
    "detailed_sales",
    sql(f"""SELECT order_id, line_no, {ts('sold_at', 'sold_at')}, {day('sale_date', 'sale_date')}, weekday, weekday_no,
                   sale_hour, channel, product_id, product_name, category, brand, price_band, customer_id,
                   customer_name, state, region, segment, quantity, {shown('unit_cents', 'unit_price')},
                   {shown('cents', 'revenue')}, is_registered, is_before_registration FROM detailed"""),
    "DS-9", "JN-7",
)
def _(t):
    return money.without_cents(detailed(t)).drop("supplier_id")


def detailed(t):
    sales = materialize(t.sales())  # read for the rows themselves and for the segments
    segments = marts.customer_segmentation(t.customers(), sales, segments=SEGMENTS, ranked=False)
    return marts.detailed_sales(sales, t.products(), segments)


def scorecard(t):
    products = materialize(t.products())  # read by the flags and by the product rules
    offers = materialize(clean_offers(t.raw_offers(), products))  # read by two rules
    sales = with_registration_flags(t.sales(), products, "product_id", "sold_at", "created_at")
    return marts.quality_scorecard(sales, products, t.customers(), offers, min_competitors=MIN_COMPETITORS)


@query(
    "quality_scorecard",
    sql(f"""SELECT rule, table_name, severity, affected_rows, {shown('cents', 'affected_revenue')}
            FROM scorecard"""),
    "DS-10", "DQ-12", "SO-2",
)
def _(t):
    return scorecard(t)


@query(
    "sales_by_region_and_channel",
    sql(f"""SELECT region, channel, n_sales, {shown('cents', 'revenue')}, customers, {ticket()}
            FROM region_channel"""),
    "DS-11",
)
def _(t):
    return marts.sales_by_region_and_channel(t.sales(), t.customers())


@query(
    "revenue_by_channel",
    sql(f"SELECT channel, count(*) AS n_sales, {shown('sum(cents)', 'revenue')} FROM event_sales GROUP BY 1"),
    "DS-12",
)
def _(t):
    return marts.revenue_by_channel(t.event_sales(), revenue_type=money.TOTAL)
