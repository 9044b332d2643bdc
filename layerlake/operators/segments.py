"""Customer totals, segments and coverage of customers who never bought."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import money
from ..functions.columns import banded
from .joins import zero_filled


def customer_totals(sales: DataFrame, customer: str = "customer_id", day: str = "sale_date") -> DataFrame:
    """Purchases, revenue, mean ticket and first and last day per customer.

    ``sales`` has one row per sale, or partial totals (say, per order) that
    carry the number of sales in ``n_sales``.
    """
    n = F.sum("n_sales") if "n_sales" in sales.columns else F.count("*")
    totals = sales.groupBy(customer).agg(
        n.alias("n_sales"),
        money.total_of(sales, "revenue").alias("revenue"),
        F.min(day).alias("first_purchase"),
        F.max(day).alias("last_purchase"),
    )
    return totals.withColumn("avg_ticket", money.mean("revenue", "n_sales"))


def customer_segments(
    customers: DataFrame,
    sales: DataFrame,
    *,
    customer: str = "customer_id",
    segments=fixed.SEGMENTS,
    lowest: str = fixed.LOWEST_SEGMENT,
) -> DataFrame:
    """One row per customer, buyers or not: revenue 0 and no ticket or dates without sales."""
    filled = zero_filled(customers, customer_totals(sales, customer), customer, {"n_sales": 0})
    return filled.withColumn(
        "revenue", F.coalesce("revenue", F.lit(0).cast(money.TOTAL))
    ).withColumn("segment", banded("revenue", segments, lowest, inclusive=True))
