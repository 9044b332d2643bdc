"""Cleaned tables: one row per key, exact types, problems flagged and never deleted."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as cols
from ..functions import fixed_values as fixed
from ..functions import money
from ..operators.dedup import first_by_key
from ..operators.joins import with_registration_flags


def clean_products(raw: DataFrame, *, bands=fixed.PRICE_BANDS, lowest: str = fixed.LOWEST_PRICE_BAND) -> DataFrame:
    """Products by id: trimmed name, decimal price, price band."""
    priced = first_by_key(raw, ["product_id"]).withColumns(
        {"product_name": F.trim("product_name"), "list_price": money.amount("list_price")}
    )
    return priced.withColumn("price_band", cols.banded("list_price", bands, lowest, inclusive=False))


def clean_customers(raw: DataFrame, states: DataFrame) -> DataFrame:
    """Customers by id: name without title next to the original, upper-case state, region if known."""
    tidy = first_by_key(raw, ["customer_id"]).withColumns(
        {
            "original_name": F.trim("customer_name"),
            "customer_name": cols.clean_person_name("customer_name"),
            "state": cols.clean_code("state"),
        }
    )
    return tidy.join(states.select("state", "state_name", "region"), "state", "left")


def unflagged_offers(raw: DataFrame) -> DataFrame:
    """Competitor prices by product and competitor, with decimal price and, where it is given, real timestamp.

    The lowest price of a pair stays; the time only decides between equal prices.
    """
    unique = first_by_key(raw, ["product_id", "competitor"])
    priced = unique.withColumn("competitor_price_cents", money.price_cents("competitor_price"))
    priced = priced.withColumn("competitor_price", money.from_cents("competitor_price_cents", money.AMOUNT))
    return priced.withColumn("collected_at", F.to_timestamp("collected_at")) if "collected_at" in raw.columns else priced


def clean_offers(raw: DataFrame, products: DataFrame, *, share: Decimal = fixed.SUSPICIOUS_SHARE) -> DataFrame:
    """Competitor prices, flagged when far below our own price; unknown products are kept unflagged."""
    own = products.select("product_id", F.col("list_price").alias("_own"))
    flag = money.is_below_share("competitor_price", "_own", share)
    return unflagged_offers(raw).join(own, "product_id", "left").withColumn("is_suspicious", flag).drop("_own")


def priced(lines: DataFrame) -> DataFrame:
    """Decimal unit price and revenue from a floating price, with the revenue's cents twin."""
    cents = lines.withColumn("_price", money.price_cents("unit_price"))
    return (
        cents.withColumn("revenue_cents", F.col("quantity") * F.col("_price"))
        .withColumns(
            {
                "unit_price": money.from_cents("_price", money.AMOUNT),
                "revenue": money.from_cents("revenue_cents", money.AMOUNT),
            }
        )
        .drop("_price")
    )


def priced_sales(raw: DataFrame, *, keys: Sequence[str] = (), weekdays=fixed.WEEKDAYS) -> DataFrame:
    """Sales with decimal price, revenue and calendar, before any lookup.

    ``keys`` de-duplicates first; leave it empty for rows that are already unique.
    """
    unique = first_by_key(raw, keys) if keys else raw
    return cols.with_calendar(priced(unique), "sold_at", weekdays)


def clean_sales(raw: DataFrame, products: DataFrame, *, keys: Sequence[str] = (), weekdays=fixed.WEEKDAYS) -> DataFrame:
    """Every sale once, with the two catalog flags. No sale is ever dropped."""
    return with_registration_flags(
        priced_sales(raw, keys=keys, weekdays=weekdays), products, "product_id", "sold_at", "created_at"
    )
