"""Business datasets on top of the cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as cols
from ..functions import fixed_values as fixed
from ..functions import money
from ..operators import aggregates, ranking, scorecard
from ..operators.joins import with_registration_flags
from ..operators.pricing import price_competitiveness
from ..operators.segments import customer_segments
from ..operators.terms import rows_mentioning_other_term


def sales_over_time(sales: DataFrame, *, sketches: bool = False) -> DataFrame:
    """Sales by date, hour and channel. Distinct customers hold for their own row only.

    With ``sketches`` each row also has a sketch of its customers, from which
    distinct customers of any coarser grouping follow (``aggregates.rolled_up``).
    """
    keys = ["sale_date", "weekday", "weekday_no", "sale_hour", "channel"]
    if sketches:  # each customer of a row once, so that every sketch is made of distinct values
        per_customer = sales.groupBy(*keys, "customer_id").agg(
            F.count("*").alias("n_sales"), F.sum("quantity").alias("items"), F.sum(money.cents_of(sales, "revenue")).alias("_cents")
        )
        return per_customer.groupBy(*keys).agg(
            F.sum("n_sales").alias("n_sales"),
            F.sum("items").alias("items"),
            money.from_cents(F.sum("_cents")).alias("revenue"),
            F.count("customer_id").alias("customers"),
            aggregates.sketch_of("customer_id").alias("customer_sketch"),
        )
    return sales.groupBy(*keys).agg(
        F.count("*").alias("n_sales"),
        F.sum("quantity").alias("items"),
        money.total_of(sales, "revenue").alias("revenue"),
        F.countDistinct("customer_id").alias("customers"),
    )


def product_totals(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_id").agg(
        F.count("*").alias("n_sales"),
        F.sum("quantity").alias("items"),
        money.total_of(sales, "revenue").alias("revenue"),
    )


def _described(df: DataFrame) -> DataFrame:
    """Fill the labels of products that are not in the catalog."""
    return df.withColumns(
        {
            "product_name": F.coalesce("product_name", F.lit(fixed.UNREGISTERED_PRODUCT)),
            "category": F.coalesce("category", F.lit(fixed.UNREGISTERED_GROUP)),
            "brand": F.coalesce("brand", F.lit(fixed.UNREGISTERED_GROUP)),
        }
    )


def product_performance(sales: DataFrame, products: DataFrame, *, ranked: bool = True) -> DataFrame:
    """One row per sold product id with totals and two revenue ranks.

    Sales are totalled per id before the catalog is joined, so a best-seller
    is one row by the time anything is shuffled for the join. Ids that are not
    in the catalog keep a row each under a placeholder name.
    """
    side = products.select(
        "product_id", "product_name", "category", "brand", "price_band", F.lit(True).alias("is_registered")
    )
    joined = product_totals(sales).join(side, "product_id", "left")
    out = _described(joined).withColumns(
        {
            "is_registered": F.coalesce("is_registered", F.lit(False)),
            "avg_ticket": money.mean("revenue", "n_sales"),
        }
    )
    if not ranked:
        return out
    order = [F.desc("revenue"), "product_id"]
    return ranking.rank_within(
        ranking.global_rank(out, order, "revenue_rank"), "category", order, "rank_in_category"
    )


def customer_segmentation(
    customers: DataFrame,
    sales: DataFrame,
    *,
    segments=fixed.SEGMENTS,
    lowest: str = fixed.LOWEST_SEGMENT,
    ranked: bool = True,
) -> DataFrame:
    """One row per customer, including those who never bought, with segment and revenue rank."""
    keep = customers.select("customer_id", "customer_name", "state", "state_name", "region")
    out = customer_segments(keep, sales, segments=segments, lowest=lowest)
    if not ranked:
        return out
    return ranking.global_rank(out, [F.desc("revenue"), "customer_id"], "revenue_rank")


def competitiveness(products: DataFrame, offers: DataFrame, sales: DataFrame) -> DataFrame:
    """One row per product that has a competitor price."""
    keep = products.select("product_id", "product_name", "category", "brand", "list_price")
    return price_competitiveness(keep, offers, product_totals(sales).drop("n_sales"))


def detailed_sales(sales: DataFrame, products: DataFrame, segments: DataFrame) -> DataFrame:
    """One row per sale with product, customer, region and segment.

    ``sales`` needs no catalog flags: the one join that brings the product's
    attributes also sets them.
    """
    with_product = _described(
        with_registration_flags(
            sales.drop("is_registered", "is_before_registration"),
            products,
            "product_id",
            "sold_at",
            "created_at",
            keep=["product_name", "category", "brand", "price_band"],
        )
    )
    people = segments.select("customer_id", "customer_name", "state", "region", "segment")
    return with_product.join(people, "customer_id", "left")


def quality_scorecard(
    sales: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    offers: DataFrame,
    *,
    min_competitors: int = fixed.MIN_COMPETITORS,
) -> DataFrame:
    """One row per quality rule: how many rows and how much revenue it touches."""
    on_sales = scorecard.score_rows(
        sales,
        "sales",
        [
            scorecard.RowRule("sale of an unregistered product", fixed.ALERT, ~F.col("is_registered"), "revenue"),
            scorecard.RowRule(
                "sale before the product was created", fixed.ALERT, F.col("is_before_registration"), "revenue"
            ),
        ],
    )
    on_offers = scorecard.score_rows(
        offers,
        "competitor_prices",
        [scorecard.RowRule("competitor price far below ours", fixed.ALERT, F.col("is_suspicious"))],
    )
    brand = scorecard.score_count(
        rows_mentioning_other_term(products, "product_name", "brand").agg(F.count("*").alias("n")),
        "n",
        "brand differs from the brand in the name",
        "products",
        fixed.ALERT,
    )
    names = scorecard.score_count(
        scorecard.same_name_rows(products, "product_name"),
        "n",
        "product shares its name with another product",
        "products",
        fixed.INFORMATIVE,
    )
    coverage = scorecard.score_count(
        scorecard.under_covered(offers.select("product_id"), "product_id", min_competitors).agg(F.count("*").alias("n")),
        "n",
        "product watched at too few competitors",
        "competitor_prices",
        fixed.INFORMATIVE,
    )
    titles = scorecard.score_rows(
        customers,
        "customers",
        [scorecard.RowRule("title in the customer name", fixed.CORRECTED, cols.has_title("original_name"))],
    )
    return scorecard.stacked([on_sales, on_offers, brand, names, coverage, titles])


def sales_by_region_and_channel(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue, sales, distinct customers and mean ticket per region and channel.

    Sales are totalled per customer and channel first; each customer has one
    region, so counting those rows counts distinct customers without a
    distinct aggregate.
    """
    per_customer = sales.groupBy("customer_id", "channel").agg(
        F.count("*").alias("_n"), money.total_of(sales, "revenue").alias("_revenue")
    )
    joined = per_customer.join(customers.select("customer_id", "region"), "customer_id", "left")
    out = joined.groupBy("region", "channel").agg(
        F.sum("_n").alias("n_sales"),
        money.total("_revenue").alias("revenue"),
        F.count("customer_id").alias("customers"),
    )
    return out.withColumn("avg_ticket", money.mean("revenue", "n_sales"))


def revenue_by_channel(sales: DataFrame, *, revenue_type: str = "decimal(12,2)") -> DataFrame:
    """Sales and revenue per channel; a total that does not fit ``revenue_type`` is an error."""
    return sales.groupBy("channel").agg(
        F.count("*").alias("n_sales"), money.total_of(sales, "revenue").cast(revenue_type).alias("revenue")
    )
