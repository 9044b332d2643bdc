"""Named subqueries for the check SQL. Money is whole cents until it is shown."""

from __future__ import annotations

import re

from ..functions import fixed_values as fixed


def shown(cents: str, name: str) -> str:
    """An amount of cents as a double."""
    return f"CAST({cents} AS DOUBLE) / 100 AS {name}"


def half_up(total: str, n: str) -> str:
    """Half-up integer mean of a non-negative integer total; NULL for no rows."""
    return f"CASE WHEN ({n}) > 0 THEN (2 * CAST({total} AS HUGEINT) + ({n})) // (2 * ({n})) END"


def pct(part: str, whole: str, places: int, name: str) -> str:
    """100 * part / whole rounded half away from zero, for integers."""
    scale = 10**places
    body = f"(abs(CAST({part} AS HUGEINT)) * {200 * scale} + ({whole})) // (2 * ({whole}))"
    return f"CASE WHEN ({whole}) > 0 THEN CAST(sign({part}) * ({body}) AS DOUBLE) / {scale} END AS {name}"


def big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def day(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS {name}"


def ts(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"


def weekday_case(number: str) -> str:
    return "CASE " + number + "".join(f" WHEN {n} THEN '{w}'" for n, w in fixed.WEEKDAYS.items()) + " END"


def title_case(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({text}, ' '), "
        "lambda w: upper(w[1:1]) || lower(w[2:])), ' ')"
    )


TITLE = "^(" + "|".join(fixed.TITLES) + r")\.\s+"

PARTS = {
    "single_lines": """
        SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_no,
               CASE WHEN l_partkey % 150 = 7 THEN l_partkey + 10000000 ELSE l_partkey END AS product_id,
               l_suppkey AS supplier_id, l_linestatus AS channel, CAST(l_quantity AS BIGINT) AS quantity,
               CAST(floor(round(l_extendedprice * 100) / l_quantity) AS BIGINT) AS unit_cents
        FROM lineitem""",
    "raw_lines": """
        SELECT * FROM single_lines UNION ALL SELECT * FROM single_lines WHERE order_id % 10 = 0""",
    "raw_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS sold_at FROM orders""",
    "raw_sales": """
        SELECT l.*, o.customer_id, o.sold_at, l.quantity * l.unit_cents AS cents
        FROM raw_lines l JOIN raw_orders o USING (order_id)""",
    "lines": """
        SELECT * EXCLUDE (rn), quantity * unit_cents AS cents
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id, line_no, product_id, supplier_id
                 ORDER BY channel, quantity, unit_cents) AS rn FROM raw_lines)
        WHERE rn = 1""",
    "sales": f"""
        SELECT l.*, o.customer_id, o.sold_at, CAST(o.sold_at AS DATE) AS sale_date,
               hour(o.sold_at) AS sale_hour, dayofweek(o.sold_at) + 1 AS weekday_no,
               {weekday_case("dayofweek(o.sold_at) + 1")} AS weekday
        FROM lines l JOIN raw_orders o USING (order_id)""",
    "raw_products": """
        SELECT p_partkey AS product_id,
               p_name || ' ' || CASE WHEN p_size = 7 THEN 'Brand#3' ELSE p_brand END AS product_name,
               p_type AS category, p_brand AS brand,
               CAST(round(p_retailprice * 100) AS BIGINT) AS list_cents,
               CAST(DATE '1995-01-01' + CAST(p_size * 4 AS INTEGER) AS TIMESTAMP) AS created_at
        FROM part""",
    "products": """
        SELECT *, CASE WHEN list_cents > 97500 THEN 'PREMIUM' WHEN list_cents > 92500 THEN 'MEDIO'
                       ELSE 'BASICO' END AS price_band
        FROM raw_products""",
    "states": """
        SELECT n_name AS state, 'State of ' || n_name AS state_name, r_name AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "raw_customers": """
        SELECT c_custkey AS customer_id,
               CASE c_mktsegment WHEN 'MACHINERY' THEN ' Dr. ' WHEN 'BUILDING' THEN 'Sra.   '
                    WHEN 'FURNITURE' THEN 'Dr ' ELSE '' END || lower(c_name) || ' ' AS customer_name,
               ' nation_' || c_nationkey || ' ' AS state
        FROM customer""",
    "customers": f"""
        SELECT c.customer_id, trim(c.customer_name) AS original_name,
               {title_case(f"regexp_replace(trim(c.customer_name), '{TITLE}', '')")} AS customer_name,
               upper(trim(c.state)) AS state, s.state_name, s.region
        FROM raw_customers c LEFT JOIN states s ON upper(trim(c.state)) = s.state""",
    "raw_offers": """
        SELECT l_partkey AS product_id, l_suppkey AS competitor,
               CAST(floor(round(p_retailprice * 100) * CASE l_partkey % 10
                   WHEN 0 THEN 70 + (l_suppkey * 13 + l_orderkey * 7) % 90 % 25
                   WHEN 1 THEN 105 + (l_suppkey * 13 + l_orderkey * 7) % 90 % 25 WHEN 2 THEN 100
                   ELSE 55 + (l_suppkey * 13 + l_orderkey * 7) % 90 END / 100) AS BIGINT) AS offer_cents,
               l_shipdate AS collected_at
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "offers": """
        SELECT o.product_id, o.competitor, o.offer_cents, o.collected_at,
               coalesce(o.offer_cents * 10 < p.list_cents * 6, false) AS is_suspicious
        FROM (SELECT *, row_number() OVER (PARTITION BY product_id, competitor
                 ORDER BY offer_cents, collected_at) AS rn FROM raw_offers) o
        LEFT JOIN products p USING (product_id) WHERE o.rn = 1""",
    "flagged": """
        SELECT s.*, p.product_id IS NOT NULL AS is_registered,
               coalesce(s.sold_at < p.created_at, false) AS is_before_registration
        FROM sales s LEFT JOIN products p ON s.product_id = p.product_id""",
    "event_sales": f"""
        SELECT event_id AS sale_id, ts AS sold_at, user_id AS customer_id, event_type AS channel,
               CAST(props->>'$.k' AS BIGINT) AS quantity,
               CAST(round(value * 100) AS BIGINT) AS unit_cents,
               CAST(props->>'$.k' AS BIGINT) * CAST(round(value * 100) AS BIGINT) AS cents,
               CAST(ts AS DATE) AS sale_date, hour(ts) AS sale_hour, dayofweek(ts) + 1 AS weekday_no,
               {weekday_case("dayofweek(ts) + 1")} AS weekday
        FROM events""",
    "product_totals": """
        SELECT product_id, count(*) AS n_sales, sum(quantity) AS items, sum(cents) AS cents
        FROM sales GROUP BY product_id""",
    "performance": f"""
        SELECT t.product_id, coalesce(p.product_name, '{fixed.UNREGISTERED_PRODUCT}') AS product_name,
               coalesce(p.category, '{fixed.UNREGISTERED_GROUP}') AS category,
               coalesce(p.brand, '{fixed.UNREGISTERED_GROUP}') AS brand, p.price_band,
               p.product_id IS NOT NULL AS is_registered, t.n_sales, t.items, t.cents,
               {half_up("t.cents", "t.n_sales")} AS ticket_cents,
               row_number() OVER (ORDER BY t.cents DESC, t.product_id) AS revenue_rank,
               row_number() OVER (PARTITION BY coalesce(p.category, '{fixed.UNREGISTERED_GROUP}')
                                  ORDER BY t.cents DESC, t.product_id) AS rank_in_category
        FROM product_totals t LEFT JOIN products p ON t.product_id = p.product_id""",
    "segments": f"""
        SELECT *, {half_up("cents", "n_sales")} AS ticket_cents,
               CASE WHEN cents >= 210000000 THEN 'VIP' WHEN cents >= 128000000 THEN 'TOP_TIER'
                    ELSE 'REGULAR' END AS segment,
               row_number() OVER (ORDER BY cents DESC, customer_id) AS revenue_rank
        FROM (SELECT c.customer_id, c.customer_name, c.state, c.state_name, c.region,
                     count(s.customer_id) AS n_sales, coalesce(sum(s.cents), 0) AS cents,
                     min(s.sale_date) AS first_purchase, max(s.sale_date) AS last_purchase
              FROM customers c LEFT JOIN sales s ON c.customer_id = s.customer_id
              GROUP BY ALL)""",
    "market": f"""
        SELECT product_id, sum(offer_cents) AS offer_total, count(*) AS n_offers,
               min(offer_cents) AS low_cents, max(offer_cents) AS high_cents,
               {half_up("sum(offer_cents)", "count(*)")} AS mean_cents,
               bool_or(is_suspicious) AS has_suspicious_price
        FROM offers GROUP BY product_id""",
    "competitiveness": f"""
        SELECT p.product_id, p.product_name, p.category, p.brand, p.list_cents, m.low_cents, m.high_cents,
               m.mean_cents, m.n_offers, m.has_suspicious_price,
               {pct("p.list_cents - m.mean_cents", "m.mean_cents", 2, "diff_pct_vs_mean")},
               {pct("p.list_cents - m.low_cents", "m.low_cents", 2, "diff_pct_vs_lowest")},
               CASE WHEN p.list_cents > m.high_cents THEN '{fixed.DEARER_THAN_ALL}'
                    WHEN p.list_cents < m.low_cents THEN '{fixed.CHEAPER_THAN_ALL}'
                    WHEN p.list_cents > m.mean_cents THEN '{fixed.ABOVE_MEAN}'
                    WHEN p.list_cents < m.mean_cents THEN '{fixed.BELOW_MEAN}'
                    ELSE '{fixed.AT_MEAN}' END AS price_position,
               coalesce(t.cents, 0) AS cents, coalesce(t.items, 0) AS items
        FROM products p JOIN market m ON p.product_id = m.product_id
        LEFT JOIN product_totals t ON p.product_id = t.product_id""",
    "detailed": f"""
        SELECT f.*, coalesce(p.product_name, '{fixed.UNREGISTERED_PRODUCT}') AS product_name,
               coalesce(p.category, '{fixed.UNREGISTERED_GROUP}') AS category,
               coalesce(p.brand, '{fixed.UNREGISTERED_GROUP}') AS brand, p.price_band,
               c.customer_name, c.state, c.region, c.segment
        FROM flagged f LEFT JOIN products p ON f.product_id = p.product_id
        LEFT JOIN segments c ON f.customer_id = c.customer_id""",
    "brand_mismatch": """
        SELECT p.* FROM products p WHERE EXISTS (
            SELECT 1 FROM (SELECT DISTINCT brand FROM products) b
            WHERE b.brand <> p.brand AND contains(lower(p.product_name), lower(b.brand)))""",
    "scorecard": f"""
        SELECT 'sale of an unregistered product' AS rule, 'sales' AS table_name, '{fixed.ALERT}' AS severity,
               count(*) AS affected_rows, sum(cents) AS cents FROM flagged WHERE NOT is_registered
        UNION ALL
        SELECT 'sale before the product was created', 'sales', '{fixed.ALERT}', count(*), sum(cents)
        FROM flagged WHERE is_before_registration
        UNION ALL
        SELECT 'competitor price far below ours', 'competitor_prices', '{fixed.ALERT}', count(*), NULL
        FROM offers WHERE is_suspicious
        UNION ALL
        SELECT 'brand differs from the brand in the name', 'products', '{fixed.ALERT}', count(*), NULL
        FROM brand_mismatch
        UNION ALL
        SELECT 'product shares its name with another product', 'products', '{fixed.INFORMATIVE}', count(*), NULL
        FROM (SELECT count(*) OVER (PARTITION BY product_name) AS n FROM products) WHERE n > 1
        UNION ALL
        SELECT 'product watched at too few competitors', 'competitor_prices', '{fixed.INFORMATIVE}',
               count(*), NULL
        FROM (SELECT product_id FROM offers GROUP BY product_id HAVING count(*) < 20)
        UNION ALL
        SELECT 'title in the customer name', 'customers', '{fixed.CORRECTED}', count(*), NULL
        FROM customers WHERE regexp_matches(original_name, '{TITLE}')""",
    "over_time": """
        SELECT sale_date, weekday, weekday_no, sale_hour, channel, count(*) AS n_sales,
               sum(quantity) AS items, sum(cents) AS cents, count(DISTINCT customer_id) AS customers
        FROM event_sales GROUP BY ALL""",
    "region_channel": f"""
        SELECT c.region, s.channel, count(*) AS n_sales, sum(s.cents) AS cents,
               count(DISTINCT s.customer_id) AS customers,
               {half_up("sum(s.cents)", "count(*)")} AS ticket_cents
        FROM sales s LEFT JOIN customers c ON s.customer_id = c.customer_id GROUP BY ALL""",
}


def _needed(body: str, found: list[str]) -> None:
    for name in PARTS:
        if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", body):
            _needed(PARTS[name], found)
            if name not in found:
                found.append(name)


def sql(body: str) -> str:
    """``body`` preceded by the named subqueries it reads, directly or not."""
    needed: list[str] = []
    _needed(body, needed)
    if not needed:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in needed) + "\n" + body.strip()
