"""Declared columns of the cleaned tables and datasets: name, type, comment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import types as T

from ..functions import fixed_values as fixed


@dataclass(frozen=True)
class Settings:
    """What differs from shop to shop."""

    sale_key: Sequence[str] = ("sale_id",)
    id_type: str = "string"
    channels: Sequence[str] = tuple(fixed.CHANNELS)
    price_bands: Sequence[tuple[Decimal, str]] = tuple(fixed.PRICE_BANDS)
    segments: Sequence[tuple[Decimal, str]] = tuple(fixed.SEGMENTS)
    suspicious_share: Decimal = fixed.SUSPICIOUS_SHARE
    min_competitors: int = fixed.MIN_COMPETITORS
    max_unregistered_share: Decimal = fixed.MAX_UNREGISTERED_SHARE


def _schema(*columns: tuple[str, str, str]) -> T.StructType:
    return T.StructType(
        [
            T.StructField(name, T.DataType.fromDDL(kind), True, {"comment": comment})
            for name, kind, comment in columns
        ]
    )


def _keys(s: Settings) -> list[tuple[str, str, str]]:
    return [(k, s.id_type, "Key of the sale.") for k in s.sale_key if k != "product_id"]


def products(s: Settings) -> T.StructType:
    return _schema(
        ("product_id", s.id_type, "Key of the product."),
        ("product_name", "string", "Name; different products may share it."),
        ("category", "string", "Category."),
        ("brand", "string", "Brand."),
        ("list_price", "decimal(10,2)", "Our current price."),
        ("created_at", "timestamp", "When the product was created."),
        ("price_band", "string", "Band of the list price."),
    )


def customers(s: Settings) -> T.StructType:
    return _schema(
        ("customer_id", s.id_type, "Key of the customer."),
        ("customer_name", "string", "Name without title."),
        ("original_name", "string", "Name as it came."),
        ("state", "string", "State code."),
        ("state_name", "string", "State name."),
        ("region", "string", "Region of the state."),
    )


def competitor_prices(s: Settings) -> T.StructType:
    return _schema(
        ("product_id", s.id_type, "Product the price is for."),
        ("competitor", "string", "Who asks the price."),
        ("competitor_price", "decimal(10,2)", "The competitor's price."),
        ("collected_at", "timestamp", "When the price was seen."),
        ("is_suspicious", "boolean", "True when far below our own price."),
    )


def sales(s: Settings) -> T.StructType:
    return _schema(
        *_keys(s),
        ("sold_at", "timestamp", "When the sale took place."),
        ("customer_id", s.id_type, "Buyer."),
        ("product_id", s.id_type, "Product sold."),
        ("channel", "string", "Sales channel."),
        ("quantity", "bigint", "Units sold."),
        ("unit_price", "decimal(10,2)", "Price per unit."),
        ("revenue", "decimal(10,2)", "Quantity times unit price; add up for totals."),
        ("sale_date", "date", "Day of the sale."),
        ("sale_hour", "int", "Hour of the sale, 0 to 23."),
        ("weekday_no", "int", "1 = Sunday ... 7 = Saturday."),
        ("weekday", "string", "Name of the weekday."),
        ("is_registered", "boolean", "False when the product is not in the catalog."),
        ("is_before_registration", "boolean", "True when sold before the product was created."),
    )


def sales_over_time(s: Settings) -> T.StructType:
    return _schema(
        ("sale_date", "date", "Day."),
        ("weekday", "string", "Name of the weekday."),
        ("weekday_no", "int", "1 = Sunday ... 7 = Saturday."),
        ("sale_hour", "int", "Hour, 0 to 23."),
        ("channel", "string", "Sales channel."),
        ("n_sales", "bigint", "Sales; add up for totals."),
        ("items", "bigint", "Units sold; add up for totals."),
        ("revenue", "decimal(20,2)", "Revenue; add up for totals."),
        ("customers", "bigint", "Distinct customers of this row only; never add up."),
        ("customer_sketch", "binary", "Sketch of the customers; unite to estimate those of several rows."),
    )


def product_performance(s: Settings) -> T.StructType:
    return _schema(
        ("product_id", s.id_type, "Key of the product; count products by it."),
        ("product_name", "string", "Name, or the label of an unregistered product."),
        ("category", "string", "Category."),
        ("brand", "string", "Brand."),
        ("price_band", "string", "Band of the list price."),
        ("is_registered", "boolean", "False when the product is not in the catalog."),
        ("n_sales", "bigint", "Sales."),
        ("items", "bigint", "Units sold."),
        ("revenue", "decimal(20,2)", "Revenue."),
        ("avg_ticket", "decimal(11,2)", "Mean revenue per sale; do not average."),
        ("revenue_rank", "bigint", "1 = most revenue."),
        ("rank_in_category", "bigint", "1 = most revenue in the category."),
    )


def customer_segmentation(s: Settings) -> T.StructType:
    return _schema(
        ("customer_id", s.id_type, "Key of the customer."),
        ("customer_name", "string", "Name without title."),
        ("state", "string", "State code."),
        ("state_name", "string", "State name."),
        ("region", "string", "Region."),
        ("n_sales", "bigint", "Purchases, 0 if none."),
        ("revenue", "decimal(20,2)", "Revenue, 0 if none."),
        ("avg_ticket", "decimal(11,2)", "Mean revenue per purchase; empty if none."),
        ("first_purchase", "date", "Day of the first purchase."),
        ("last_purchase", "date", "Day of the last purchase."),
        ("segment", "string", "Segment by revenue."),
        ("revenue_rank", "bigint", "1 = most revenue."),
    )


def price_competitiveness(s: Settings) -> T.StructType:
    return _schema(
        ("product_id", s.id_type, "Key of the product."),
        ("product_name", "string", "Name."),
        ("category", "string", "Category."),
        ("brand", "string", "Brand."),
        ("list_price", "decimal(10,2)", "Our current price."),
        ("mean_price", "decimal(11,2)", "Mean competitor price."),
        ("lowest_price", "decimal(10,2)", "Lowest competitor price."),
        ("highest_price", "decimal(10,2)", "Highest competitor price."),
        ("n_offers", "bigint", "Competitors with a price."),
        ("diff_pct_vs_mean", "decimal(19,2)", "Percent above the mean; negative = cheaper."),
        ("diff_pct_vs_lowest", "decimal(18,2)", "Percent above the lowest."),
        ("price_position", "string", "Position of our price in the market."),
        ("has_suspicious_price", "boolean", "True when some competitor price looks wrong."),
        ("revenue", "decimal(20,2)", "Revenue, 0 if never sold."),
        ("items", "bigint", "Units sold, 0 if never sold."),
    )


def detailed_sales(s: Settings) -> T.StructType:
    return _schema(
        *_keys(s),
        ("sold_at", "timestamp", "When the sale took place."),
        ("sale_date", "date", "Day of the sale."),
        ("weekday", "string", "Name of the weekday."),
        ("weekday_no", "int", "1 = Sunday ... 7 = Saturday."),
        ("sale_hour", "int", "Hour of the sale, 0 to 23."),
        ("channel", "string", "Sales channel."),
        ("product_id", s.id_type, "Product sold."),
        ("product_name", "string", "Name, or the label of an unregistered product."),
        ("category", "string", "Category."),
        ("brand", "string", "Brand."),
        ("price_band", "string", "Band of the list price; empty if unregistered."),
        ("customer_id", s.id_type, "Buyer."),
        ("customer_name", "string", "Name without title."),
        ("state", "string", "State code."),
        ("region", "string", "Region."),
        ("segment", "string", "Segment of the buyer."),
        ("quantity", "bigint", "Units sold."),
        ("unit_price", "decimal(10,2)", "Price per unit."),
        ("revenue", "decimal(10,2)", "Quantity times unit price; add up for totals."),
        ("is_registered", "boolean", "False when the product is not in the catalog."),
        ("is_before_registration", "boolean", "True when sold before the product was created."),
    )


def quality_scorecard(s: Settings) -> T.StructType:
    return _schema(
        ("rule", "string", "What is checked."),
        ("table_name", "string", "Where it is checked."),
        ("severity", "string", "How serious it is."),
        ("affected_rows", "bigint", "Rows the rule touches."),
        ("affected_revenue", "decimal(20,2)", "Revenue of those sales; empty if the rule is not about sales."),
    )


def sales_by_region_and_channel(s: Settings) -> T.StructType:
    return _schema(
        ("region", "string", "Region of the buyer."),
        ("channel", "string", "Sales channel."),
        ("n_sales", "bigint", "Sales."),
        ("revenue", "decimal(20,2)", "Revenue."),
        ("customers", "bigint", "Distinct customers of this row."),
        ("avg_ticket", "decimal(11,2)", "Mean revenue per sale."),
    )
