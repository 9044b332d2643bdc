"""Expectation, check and profile queries."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import money
from ..operators import aggregates as agg
from ..operators import checks, profile, scorecard
from ..operators.dedup import duplicated_keys
from ..plans import marts
from ..plans.bindings import CHANNELS, LINE_KEY, MIN_COMPETITORS
from ..plans.cleaning import clean_offers
from ..session import materialize
from ..sinks.datasets import DROP, FAIL, WARN, Expectation, expectation_counts, split_on
from .joins import t_segments
from .reference_sql import big, shown, sql, ts
from .registry import query

SALE_RULES = [
    Expectation("positive_quantity", "quantity > 0", FAIL),
    Expectation("known_channel", "channel IN ('click', 'view', 'purchase')", WARN),
    Expectation("worth_a_unit", "unit_price >= 1", DROP),
]


@query(
    "expectation_counts",
    sql("""SELECT 'event_sales' AS dataset, r.rule, r.action,
                  count(*) FILTER (WHERE CASE r.rule WHEN 'positive_quantity' THEN quantity > 0
                      WHEN 'known_channel' THEN channel IN ('click', 'view', 'purchase')
                      ELSE unit_cents >= 100 END) AS passed,
                  count(*) FILTER (WHERE NOT CASE r.rule WHEN 'positive_quantity' THEN quantity > 0
                      WHEN 'known_channel' THEN channel IN ('click', 'view', 'purchase')
                      ELSE unit_cents >= 100 END) AS failed
           FROM event_sales, (VALUES ('positive_quantity', 'fail'), ('known_channel', 'warn'),
                                     ('worth_a_unit', 'drop')) AS r(rule, action)
           GROUP BY ALL"""),
    "DQ-1", "DQ-4",
)
def _(t):
    return expectation_counts(t.event_sales(), "event_sales", SALE_RULES)


@query(
    "dropped_and_quarantined",
    sql("""SELECT CASE WHEN quantity > 0 AND channel IN ('click', 'view', 'purchase') AND unit_cents >= 100
                       THEN 'kept' ELSE 'quarantined' END AS destination, channel, count(*) AS n_rows
           FROM event_sales GROUP BY ALL"""),
    "DQ-3",
)
def _(t):
    good, bad = split_on(t.event_sales(), SALE_RULES)
    return agg.value_counts(
        good.select(F.lit("kept").alias("destination"), "channel").unionByName(
            bad.select(F.lit("quarantined").alias("destination"), "channel")
        ),
        "destination",
        "channel",
    )


@query(
    "under_covered_products",
    sql("SELECT product_id, count(*) AS n_rows FROM offers GROUP BY 1 HAVING count(*) < 20"),
    "DQ-10", "FLT-8",
)
def _(t):
    return scorecard.under_covered(t.unflagged_offers(), "product_id", MIN_COMPETITORS)


@query(
    "duplicated_line_keys",
    sql("SELECT order_id, line_no, count(*) AS n_rows FROM raw_lines GROUP BY 1, 2 HAVING count(*) > 1"),
    "DQ-13", "FLT-8",
)
def _(t):
    return duplicated_keys(t.raw_lines(), ["order_id", "line_no"])


@query(
    "missing_lookup_rows",
    sql("""SELECT product_id, count(*) AS n_rows FROM flagged f
           WHERE f.product_id NOT IN (SELECT product_id FROM products) GROUP BY 1"""),
    "DQ-14", "DQ-17",
)
def _(t):
    side = t.products().select("product_id", "category")
    per_key = t.line_sales().groupBy("product_id").agg(F.count("*").alias("n_rows"))
    joined = per_key.join(side, "product_id", "left")
    return joined.where(checks.any_null("category", "product_id")).select("product_id", "n_rows")


@query(
    "domain_violations",
    """SELECT event_type, count(*) AS n_rows FROM events
       WHERE event_type NOT IN ('click', 'view', 'purchase') GROUP BY 1""",
    "DQ-15", "FLT-3",
)
def _(t):
    bad = t.table("events").where(checks.outside("event_type", ["click", "view", "purchase"]))
    return agg.value_counts(bad, "event_type")


@query(
    "business_rule_violations",
    sql("""SELECT CASE WHEN quantity <= 0 THEN 'no quantity' ELSE 'price below one' END AS problem, count(*) AS n_rows
           FROM event_sales WHERE quantity <= 0 OR unit_cents < 100 GROUP BY 1"""),
    "DQ-16", "FLT-2",
)
def _(t):
    bad = t.event_sales().where((F.col("quantity") <= 0) | (F.col("unit_price") < 1))
    problem = F.when(F.col("quantity") <= 0, "no quantity").otherwise("price below one")
    return agg.value_counts(bad.withColumn("problem", problem), "problem")


@query(
    "row_counts_compared",
    sql("""SELECT s.n AS left_rows, d.n AS right_rows, s.n = d.n AS is_equal
           FROM (SELECT count(*) AS n FROM sales) s, (SELECT count(*) AS n FROM detailed) d"""),
    "DQ-19", "JN-6",
)
def _(t):
    sales, people = materialize(t.sales()), t.customers()  # read three times
    detailed = marts.detailed_sales(sales, t.products(), t_segments(t, sales, people))
    pair = checks.counts_pair(sales, detailed)
    return pair.select(
        F.col("left").alias("left_rows"),
        F.col("right").alias("right_rows"),
        (F.col("left") == F.col("right")).alias("is_equal"),
    )


@query(
    "tolerated_orphan_share",
    sql("""SELECT CAST(max(CASE WHEN 100 * bad >= n THEN 1 ELSE 0 END) AS BIGINT) AS at_one_percent,
                  CAST(max(CASE WHEN 200 * bad >= n THEN 1 ELSE 0 END) AS BIGINT) AS at_half_percent
           FROM (SELECT count(*) FILTER (WHERE NOT is_registered) AS bad, count(*) AS n FROM flagged)"""),
    "DQ-20", "FLT-9",
)
def _(t):
    bad = F.when(~F.col("is_registered"), F.col("n_sales")).otherwise(0)
    counts = t.sales_by_registration().agg(F.sum(bad).alias("bad"), F.sum("n_sales").alias("n"))
    rows = F.col("n").cast("decimal(20,0)")
    return counts.select(
        F.when(F.col("bad") >= rows * F.lit(Decimal("0.01")), 1).otherwise(0).alias("at_one_percent"),
        F.when(F.col("bad") >= rows * F.lit(Decimal("0.005")), 1).otherwise(0).alias("at_half_percent"),
    )


@query(
    "suspicious_when_frequent",
    sql("""SELECT count(*) AS n_offers, count(*) FILTER (WHERE is_suspicious) AS n_suspicious
           FROM offers HAVING count(*) FILTER (WHERE is_suspicious) * 10 >= count(*)"""),
    "FLT-9",
)
def _(t):
    counts = t.offers().agg(F.count("*").alias("n_offers"), F.count_if("is_suspicious").alias("n_suspicious"))
    return counts.where(F.col("n_suspicious") * 10 >= F.col("n_offers"))


def _twice(table: str, key: str) -> str:
    return f"SELECT 1 FROM {table} GROUP BY {key} HAVING count(*) > 1"


def _unequal(one: str, other: str) -> str:
    return f"SELECT 1 WHERE (SELECT {one}) IS DISTINCT FROM (SELECT {other})"


_KEY = ", ".join(LINE_KEY)
#: What the checks and the scorecard need of a detailed sale.
DETAIL = ["segment", "region", "is_registered", "is_before_registration", "revenue", "revenue_cents"]
_TOTAL, _COUNT = "sum(cents) FROM sales", "count(*) FROM sales"

#: Each check and the SQL of its problem rows.
SUITE = {
    f"sales: unique {_KEY}": _twice("sales", _KEY),
    f"raw: unique {_KEY}": _twice("single_lines", _KEY),
    f"detailed: unique {_KEY}": _twice("detailed", _KEY),
    "catalog: unique product_id": _twice("products", "product_id"),
    "customers: unique customer_id": _twice("customers", "customer_id"),
    "prices: unique product_id": _twice("competitiveness", "product_id"),
    "scorecard: unique rule": _twice("scorecard", "rule"),
    "segments: unique customer_id": _twice("segments", "customer_id"),
    "scorecard: known severity": f"""SELECT 1 FROM scorecard
        WHERE severity NOT IN ('{fixed.ALERT}', '{fixed.INFORMATIVE}', '{fixed.CORRECTED}')""",
    "customers: customer has a region": "SELECT 1 FROM customers WHERE region IS NULL",
    "segments: customer has a region": "SELECT 1 FROM segments WHERE region IS NULL",
    "segments: known segment": "SELECT 1 FROM segments WHERE segment NOT IN ('VIP', 'TOP_TIER', 'REGULAR')",
    "segments: top segment reaches its threshold": "SELECT 1 FROM segments WHERE segment = 'VIP' AND cents < 210000000",
    "sales: required fields": """SELECT 1 FROM sales WHERE order_id IS NULL OR line_no IS NULL OR sold_at IS NULL
        OR customer_id IS NULL OR product_id IS NULL OR quantity IS NULL OR unit_cents IS NULL""",
    "sales: known channel": "SELECT 1 FROM sales WHERE channel IS NULL OR channel NOT IN ('F', 'O')",
    "sales: positive quantity and price": "SELECT 1 FROM sales WHERE NOT coalesce(quantity > 0 AND unit_cents > 0, false)",
    "sales: revenue is quantity times price": "SELECT 1 FROM sales WHERE NOT coalesce(cents = quantity * unit_cents, false)",
    "detailed: sale has segment and region": "SELECT 1 FROM detailed WHERE segment IS NULL OR region IS NULL",
    "detailed: unregistered products stay tolerable": """SELECT 1 FROM
        (SELECT count(*) AS n, count(*) FILTER (WHERE NOT is_registered) AS bad FROM flagged) WHERE n > 0 AND 100 * bad >= n""",
    "segments: total revenue equals sales": _unequal("sum(cents) FROM segments", _TOTAL),
    "products: total revenue equals sales": _unequal("sum(cents) FROM performance", _TOTAL),
    "raw: total revenue equals sales": _unequal("sum(quantity * unit_cents) FROM single_lines", _TOTAL),
    "time: total revenue equals sales": _unequal(
        "sum(c) FROM (SELECT sum(cents) AS c FROM sales GROUP BY sale_date, sale_hour, channel)", _TOTAL),
    "detailed: total revenue equals sales": _unequal("sum(cents) FROM detailed", _TOTAL),
    "raw: row count equals sales": _unequal("count(*) FROM single_lines", _COUNT),
    "detailed: row count equals sales": _unequal("count(*) FROM detailed", _COUNT),
}


@query(
    "check_suite",
    sql("\nUNION ALL\n".join(
        f"""SELECT '{label}' AS "check", count(*) AS n_problems,
                   CASE count(*) WHEN 0 THEN 'OK' ELSE 'FAILED' END AS status FROM ({problems})"""
        for label, problems in SUITE.items()
    )),
    "DQ-22",
)
def _(t):
    # each stored table is computed once, from those stored before it
    sales, products, people = materialize(t.sales()), materialize(t.products()), materialize(t.customers())
    segments = materialize(t_segments(t, sales, people))
    offers = materialize(clean_offers(t.raw_offers().drop("collected_at"), products))  # no check asks for the time
    detailed = materialize(marts.detailed_sales(sales, products, segments).select(*LINE_KEY, *DETAIL))
    tables = {
        "sales": sales,
        "raw": t.single_priced(),
        "catalog": products,
        "customers": people,
        "segments": segments,
        "products": marts.product_performance(sales, products, ranked=False),
        "time": marts.sales_over_time(sales),
        "detailed": detailed,
        "prices": marts.competitiveness(products, offers, sales),
        "scorecard": marts.quality_scorecard(detailed, products, people, offers, min_competitors=MIN_COMPETITORS),
    }
    suite = checks.CheckSuite(tables)
    for table in ("sales", "raw", "detailed"):
        suite.unique(table, LINE_KEY)
    for table, key in (("catalog", "product_id"), ("customers", "customer_id"), ("prices", "product_id"), ("scorecard", "rule")):
        suite.unique(table, [key])
    severities = [fixed.ALERT, fixed.INFORMATIVE, fixed.CORRECTED]
    suite.rows("scorecard", "known severity", checks.outside("severity", severities))
    suite.rows("customers", "customer has a region", F.col("region").isNull())
    suite.rows("segments", "known segment", checks.outside("segment", ["VIP", "TOP_TIER", "REGULAR"]))
    suite.rule("sales", "positive quantity and price", (F.col("quantity") > 0) & (F.col("unit_price") > 0))
    suite.rows("detailed", "sale has segment and region", checks.any_null("segment", "region"))
    suite.share_below("detailed", "unregistered products stay tolerable", ~F.col("is_registered"), Decimal("0.01"))
    required = checks.any_null("order_id", "line_no", "sold_at", "customer_id", "product_id", "quantity", "unit_price")
    product = money.line_revenue("quantity", "unit_price")
    suite.rows("sales", "required fields", required)
    suite.rows("sales", "known channel", checks.outside("channel", CHANNELS))
    suite.rule("sales", "revenue is quantity times price", F.col("revenue") == product)
    suite.rows("segments", "customer has a region", F.col("region").isNull())
    low_vip = (F.col("segment") == "VIP") & (F.col("revenue") < 2100000)
    suite.rows("segments", "top segment reaches its threshold", low_vip)
    suite.unique("segments", ["customer_id"])
    for other in ("segments", "products", "raw", "time", "detailed"):
        suite.same_total("sales", other)
    for other in ("raw", "detailed"):
        suite.same_count("sales", other)
    return suite.results()


def _quartiles(c: str) -> str:
    at = lambda share: f"max({c}) FILTER (WHERE r = ({share} * n + 3) // 4)"
    numbered = f"SELECT {c}, row_number() OVER (ORDER BY {c}) AS r, count(*) OVER () AS n FROM part WHERE {c} IS NOT NULL"
    return f", (SELECT CAST({at(1)} AS DOUBLE) AS q1, CAST({at(3)} AS DOUBLE) AS q3 FROM ({numbered}))"


def _fences(c: str) -> str:
    low, high = "q1 - (q3 - q1) * 1.5::DOUBLE", "q3 + (q3 - q1) * 1.5::DOUBLE"
    return f"""any_value({low}) AS low_fence, any_value({high}) AS high_fence,
               count(*) FILTER (WHERE {c} < {low} OR {c} > {high}) AS n_outliers"""


@query(
    "part_profile",
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, '{kind}' AS data_type, count(*) AS n_rows,
                   count(*) - count({c}) AS n_nulls, count(DISTINCT {c}) AS n_distinct,
                   CAST(min({c}) AS VARCHAR) AS smallest, CAST(max({c}) AS VARCHAR) AS largest,
                   {f"count(*) FILTER (WHERE {c} <= 0)" if kind != "string" else "0"} AS n_not_positive,
                   {_fences(c) if kind != "string" else "NULL AS low_fence, NULL AS high_fence, 0 AS n_outliers"}
            FROM part{_quartiles(c) if kind != "string" else ""}"""
        for c, kind in [
            ("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"),
            ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double"),
        ]
    ),
    "DQ-25",
)
def _(t):
    return profile.profile_columns(t.table("part"))


@query(
    "line_key_profile",
    sql("""SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
                  count(*) FILTER (WHERE n > 1) AS n_duplicated_keys, CAST(sum(n - 1) AS BIGINT) AS n_extra_rows
           FROM (SELECT count(*) AS n FROM raw_lines GROUP BY order_id, line_no)"""),
    "DQ-25", "DQ-13",
)
def _(t):
    return profile.duplicate_key_profile(t.raw_lines(), ["order_id", "line_no"])
