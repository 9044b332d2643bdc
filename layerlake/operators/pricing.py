"""Own prices against competitors' prices."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import money
from ..functions.columns import price_position


def market_profile(
    offers: DataFrame, product: str = "product_id", price: str = "competitor_price"
) -> DataFrame:
    """Per product: sum, mean, lowest and highest competitor price and how many were seen.

    ``has_suspicious_price`` comes along when the offers carry ``is_suspicious``.
    """
    measures = [
        money.total_of(offers, price).alias("price_total"),
        money.lowest_of(offers, price).alias("lowest_price"),
        money.highest_of(offers, price).alias("highest_price"),
        F.count("*").alias("n_offers"),
    ]
    if "is_suspicious" in offers.columns:
        measures.append(F.bool_or("is_suspicious").alias("has_suspicious_price"))
    profile = offers.groupBy(product).agg(*measures)
    return profile.withColumn("mean_price", money.mean("price_total", "n_offers"))


def price_competitiveness(
    products: DataFrame,
    offers: DataFrame,
    product_totals: DataFrame,
    *,
    product: str = "product_id",
    list_price: str = "list_price",
    share: Decimal = fixed.SUSPICIOUS_SHARE,
) -> DataFrame:
    """Watched products with their market, differences, position and own revenue.

    All three inputs are one row per product before they meet. The difference
    to the market uses the rounded mean. Offers need no flag: some price is
    below the share of ours exactly when the lowest one is.
    """
    market = market_profile(offers, product).drop("price_total")
    joined = products.join(market, product).join(product_totals, product, "left")
    if "has_suspicious_price" not in joined.columns:
        low = money.is_below_share("lowest_price", list_price, share)
        joined = joined.withColumn("has_suspicious_price", low)
    return joined.withColumns(
        {
            "diff_pct_vs_mean": money.percent_above(list_price, "mean_price", 2),
            "diff_pct_vs_lowest": money.percent_above(list_price, "lowest_price", 2),
            "price_position": price_position(list_price, "lowest_price", "mean_price", "highest_price"),
            "revenue": F.coalesce("revenue", F.lit(0).cast(money.TOTAL)),
            "items": F.coalesce("items", F.lit(0)),
        }
    )


def difference_to_unrounded_mean(
    products: DataFrame, offers: DataFrame, *, product: str = "product_id", list_price: str = "list_price"
) -> DataFrame:
    """Market profile per product with the difference to the exact mean, one decimal."""
    market = market_profile(offers, product).drop("has_suspicious_price")
    scaled = F.col(list_price).cast("decimal(18,2)") * F.col("n_offers").cast("decimal(10,0)")
    return (
        products.join(market, product)
        .withColumn("diff_pct", money.percent_above(scaled, "price_total", 1))
        .drop("price_total")
    )


def mean_difference_by(
    products: DataFrame,
    offers: DataFrame,
    by: str,
    *,
    product: str = "product_id",
    list_price: str = "list_price",
    price: str = "competitor_price",
) -> DataFrame:
    """Mean over all product-competitor pairs of the percentage difference, per ``by``.

    A pair counts once per offer: this is a mean of ratios, unlike the two
    differences above. Pairs carry six decimals. Equal prices of a product are
    counted together before the products are joined.
    """
    prices = offers.groupBy(product, price).agg(F.count("*").alias("_n"))
    pairs = prices.join(products.select(product, by, list_price), product)
    out = (
        pairs.withColumn("_diff", money.percent_above(list_price, price, 6) * F.col("_n"))
        .groupBy(by, product)
        .agg(F.sum("_diff").alias("_sum"), F.sum("_n").alias("_n"))
        .groupBy(by)
        .agg(F.count("*").alias("n_products"), F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))
    )
    mean = F.round(F.col("_sum") / F.col("_n"), 1).cast("decimal(19,1)")
    return out.select(by, "n_products", mean.alias("mean_diff_pct"))
