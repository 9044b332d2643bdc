"""The layers as declared datasets over a lake, in refresh order, and the checks between them.

Raw tables expected in the lake: ``raw_sales``, ``raw_products``,
``raw_customers``, ``raw_competitor_prices`` and ``states``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..operators import checks as ck
from ..sinks.datasets import FAIL, Dataset, Expectation, Lake
from . import cleaning, marts, schemas
from .bindings import CHANNELS, LINE_KEY, MIN_COMPETITORS, PRICE_BANDS, SEGMENTS, Tables
from .schemas import Settings

TEST_TABLE_SETTINGS = Settings(
    sale_key=LINE_KEY,
    id_type="bigint",
    channels=CHANNELS,
    price_bands=PRICE_BANDS,
    segments=SEGMENTS,
    min_competitors=MIN_COMPETITORS,
)


def load_raw(lake: Lake, folder: str) -> None:
    """Fill the raw layer from the star-schema test tables, unchanged by cleaning."""
    t = Tables(lake.spark, folder)
    raw = {
        "raw_sales": t.single_lines().join(t.raw_orders(), "order_id"),
        "raw_products": t.raw_products(),
        "raw_customers": t.raw_customers(),
        "raw_competitor_prices": t.raw_offers(),
        "states": t.states(),
    }
    for name, df in raw.items():
        lake.table(name).overwrite(df)


def _fail(name: str, rule: str) -> Expectation:
    return Expectation(name, rule, FAIL)


def datasets(s: Settings = TEST_TABLE_SETTINGS) -> list[Dataset]:
    """Cleaned tables first, then the datasets that read them."""
    filled = " AND ".join(
        f"{c} IS NOT NULL" for c in (*s.sale_key, "sold_at", "customer_id", "product_id", "quantity", "unit_price")
    )
    known = "channel IN (" + ", ".join(f"'{c}'" for c in s.channels) + ")"
    return [
        Dataset(
            "products",
            schemas.products(s),
            lambda read: cleaning.clean_products(read("raw_products"), bands=s.price_bands),
            "Catalog with exact prices and price band.",
            [_fail("key_filled", "product_id IS NOT NULL"), _fail("positive_price", "list_price > 0")],
        ),
        Dataset(
            "customers",
            schemas.customers(s),
            lambda read: cleaning.clean_customers(read("raw_customers"), read("states")),
            "Customers with clean name and region.",
            [_fail("key_filled", "customer_id IS NOT NULL"), _fail("has_region", "region IS NOT NULL")],
        ),
        Dataset(
            "competitor_prices",
            schemas.competitor_prices(s),
            lambda read: cleaning.clean_offers(
                read("raw_competitor_prices"), read("products"), share=s.suspicious_share
            ),
            "Competitor prices, suspicious ones flagged.",
            [
                _fail("key_filled", "product_id IS NOT NULL"),
                _fail("positive_price", "competitor_price > 0"),
                Expectation("plausible_price", "NOT is_suspicious"),
            ],
        ),
        Dataset(
            "sales",
            schemas.sales(s),
            lambda read: cleaning.clean_sales(read("raw_sales"), read("products"), keys=s.sale_key),
            "One row per sale with revenue, calendar and flags. No sale is dropped.",
            [
                _fail("required_fields", filled),
                _fail("positive_quantity", "quantity > 0"),
                _fail("positive_price", "unit_price > 0"),
                _fail("known_channel", known),
                Expectation("registered_product", "is_registered"),
                Expectation("sold_after_registration", "NOT is_before_registration"),
            ],
            totals=("revenue",),
        ),
        Dataset(
            "sales_over_time",
            schemas.sales_over_time(s),
            lambda read: marts.sales_over_time(read("sales"), sketches=True),
            "Sales by day, hour and channel.",
            totals=("revenue",),
        ),
        Dataset(
            "product_performance",
            schemas.product_performance(s),
            lambda read: marts.product_performance(read("sales"), read("products")),
            "Sales per product with rankings.",
            totals=("revenue",),
        ),
        Dataset(
            "customer_segmentation",
            schemas.customer_segmentation(s),
            lambda read: marts.customer_segmentation(read("customers"), read("sales"), segments=s.segments),
            "Revenue, segment and rank per customer, including customers who never bought.",
            totals=("revenue",),
        ),
        Dataset(
            "price_competitiveness",
            schemas.price_competitiveness(s),
            lambda read: marts.competitiveness(read("products"), read("competitor_prices"), read("sales")),
            "Our price against the market per watched product.",
        ),
        Dataset(
            "detailed_sales",
            schemas.detailed_sales(s),
            lambda read: marts.detailed_sales(read("sales"), read("products"), read("customer_segmentation")),
            "One row per sale with product, customer, region and segment.",
            cluster_by=("sale_date",),
            totals=("revenue",),
        ),
        Dataset(
            "sales_by_region_and_channel",
            schemas.sales_by_region_and_channel(s),
            lambda read: marts.sales_by_region_and_channel(read("sales"), read("customers")),
            "Sales per region and channel.",
            totals=("revenue",),
        ),
        Dataset(
            "quality_scorecard",
            schemas.quality_scorecard(s),
            lambda read: marts.quality_scorecard(
                read("sales"),
                read("products"),
                read("customers"),
                read("competitor_prices"),
                min_competitors=s.min_competitors,
            ),
            "One row per quality rule.",
        ),
    ]


REVENUE_DATASETS = [
    "sales_over_time",
    "product_performance",
    "customer_segmentation",
    "detailed_sales",
    "sales_by_region_and_channel",
]


def reconciled(lake: Lake, *, scan: bool = False) -> DataFrame:
    """Every revenue dataset against the sales, by what was measured while they were written.

    Nothing but the logs is read; with ``scan`` the files are, as after changes that no log knows of.
    """
    totals = lake.reconciled("sales", REVENUE_DATASETS, "revenue", scan=scan)
    return totals.unionByName(lake.reconciled("sales", ["detailed_sales"], scan=scan))


def checks(lake: Lake, s: Settings = TEST_TABLE_SETTINGS) -> ck.CheckSuite:
    """The cross-row and cross-table checks over the published tables."""
    declared = datasets(s)
    suite = ck.CheckSuite({d.name: lake.read(d.name) for d in declared})
    key = list(s.sale_key)
    for table, keys in {
        "sales": key,
        "products": ["product_id"],
        "customers": ["customer_id"],
        "competitor_prices": ["product_id", "competitor"],
        "price_competitiveness": ["product_id"],
        "customer_segmentation": ["customer_id"],
        "detailed_sales": key,
        "sales_by_region_and_channel": ["region", "channel"],
        "quality_scorecard": ["rule"],
    }.items():
        suite.unique(table, keys)

    top_limit, top = s.segments[0]
    labels = [name for _, name in s.segments] + [fixed.LOWEST_SEGMENT]
    required = ck.any_null(*key, "sold_at", "customer_id", "product_id", "quantity", "unit_price")
    suite.rows("sales", "required fields", required)
    suite.rows("sales", "known channel", ck.outside("channel", s.channels))
    suite.rule("sales", "positive quantity and price", (F.col("quantity") > 0) & (F.col("unit_price") > 0))
    suite.rule("sales", "revenue is quantity times price", F.col("revenue") == F.col("quantity") * F.col("unit_price"))
    suite.share_below(
        "sales", "unregistered products stay tolerable", ~F.col("is_registered"), s.max_unregistered_share
    )
    suite.rows("customers", "every customer has a region", ck.any_null("region"))
    suite.rows("customer_segmentation", "known segment", ck.outside("segment", labels))
    suite.rows(
        "customer_segmentation",
        "top segment reaches its threshold",
        (F.col("segment") == top) & (F.col("revenue") < F.lit(top_limit)),
    )
    severities = [fixed.ALERT, fixed.INFORMATIVE, fixed.CORRECTED]
    suite.rows("quality_scorecard", "known severity", ck.outside("severity", severities))
    suite.rows("detailed_sales", "every sale has segment and region", ck.any_null("segment", "region"))
    for other in REVENUE_DATASETS:
        suite.same_total("sales", other)
    suite.same_count("sales", "detailed_sales")
    for d in declared:
        suite.documented(d.name)
    return suite
