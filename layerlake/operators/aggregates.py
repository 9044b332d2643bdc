"""Grouped and global measures over sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money
from . import ranking


def sales_totals(
    sales: DataFrame,
    keys: Sequence[Column | str] = (),
    *,
    revenue: str = "revenue",
    quantity: str | None = None,
    customer: str | None = None,
) -> DataFrame:
    """Sales count, revenue and mean ticket per key; items and distinct customers on request.

    The ticket is the ratio of the summed parts, never a mean of means. Distinct
    customers are exact and must not be added up across rows.
    """
    measures = [F.count("*").alias("n_sales"), money.total_of(sales, revenue).alias("revenue")]
    if quantity:
        measures.append(F.sum(quantity).alias("items"))
    if customer:
        measures.append(F.countDistinct(customer).alias("customers"))
    totals = sales.groupBy(*keys).agg(*measures)
    return totals.withColumn("avg_ticket", money.mean("revenue", "n_sales"))


def kpis(
    sales: DataFrame, *, revenue: str = "revenue", customer: str = "customer_id", sold_at: str = "sold_at"
) -> DataFrame:
    """One row: sales, revenue, mean ticket, distinct customers, first and last sale."""
    row = sales.agg(
        F.count("*").alias("n_sales"),
        money.total_of(sales, revenue).alias("revenue"),
        F.countDistinct(customer).alias("customers"),
        F.min(sold_at).alias("first_sale"),
        F.max(sold_at).alias("last_sale"),
    )
    return row.withColumn("avg_ticket", money.mean("revenue", "n_sales"))


def share_of_total(totals: DataFrame, value: str, name: str = "share_pct", places: int = 1) -> DataFrame:
    """Each row's percentage of the whole, from an already grouped frame.

    The whole is a scalar subquery: no window over one partition and no join.
    """
    whole = totals.agg(F.sum(value)).scalar()
    return totals.withColumn(name, money.percent(value, whole, places))


#: Sketches have 2^12 registers; a union's standard error is 1.04 / 2^6, and three of them are the stated bound.
SKETCH_BITS = 12
SKETCH_BOUND = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def sketch_of(column: Column | str) -> Column:
    """Aggregate: a sketch of the distinct values, of bounded size, that can be united with others."""
    return F.hll_sketch_agg(column, SKETCH_BITS)


def rolled_up(totals: DataFrame, keys: Sequence[str], sketch: str = "customer_sketch", name: str = "customers") -> DataFrame:
    """Distinct values per coarser key, estimated from the sketches of finer rows; the facts are not read again.

    ``name`` holds the estimate and ``sketch`` the united sketch, so the result can be rolled up further.
    """
    united = totals.groupBy(*keys).agg(F.hll_union_agg(sketch).alias(sketch))
    return united.withColumn(name, F.hll_sketch_estimate(sketch))


def is_within_bound(estimate: Column | str, exact: Column | str, bound: float = SKETCH_BOUND) -> Column:
    estimate, exact = (F.col(c) if isinstance(c, str) else c for c in (estimate, exact))
    return F.abs(estimate - exact) <= exact * bound


def mean_per_day(
    totals: DataFrame, keys: Sequence[str], *, revenue: str = "revenue", day: str = "sale_date"
) -> DataFrame:
    """Total, number of distinct days and revenue per day.

    Input may hold many rows per day; it is first reduced to one row per key
    and day, so the days are counted without a distinct aggregate.
    """
    daily = totals.groupBy(*keys, day).agg(money.total_of(totals, revenue).alias("_daily"))
    out = daily.groupBy(*keys).agg(
        money.total("_daily").alias("revenue"), F.count(day).alias("n_days")
    )
    return out.withColumn("revenue_per_day", money.mean("revenue", "n_days"))


def day_over_day(daily: DataFrame, day: str = "sale_date", revenue: str = "revenue") -> DataFrame:
    """Previous day's revenue and the percentage change, for one row per day.

    The window has no partition; its input is bounded by the number of calendar
    days. The change is NULL on the first day and after a day without revenue.
    """
    previous = F.lag(revenue).over(Window.orderBy(day))
    return daily.withColumn("previous_revenue", previous).withColumn(
        "change_pct", money.percent_above(revenue, "previous_revenue", 1)
    )


def period_over_period(
    totals: DataFrame, order: Sequence[str], group: str | None = None, revenue: str = "revenue"
) -> DataFrame:
    """The revenue of the period before and the percentage change, for any number of periods and groups.

    One row per period (and group), as many as there are hours or products. No
    window spans the table or a group; see ``ranking.previous_value``.
    """
    before = ranking.previous_value(totals, order, revenue, "previous_revenue", group)
    return before.withColumn("change_pct", money.percent_above(revenue, "previous_revenue", 1))


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows"))


def tagged_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and row count."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return _stacked(parts)


def tagged_totals(layers: dict[str, DataFrame], revenue: str = "revenue") -> DataFrame:
    """One row per layer: its name and revenue total, for reconciliation by eye."""
    parts = [
        df.agg(money.total_of(df, revenue).alias("revenue")).select(F.lit(name).alias("layer"), "revenue")
        for name, df in layers.items()
    ]
    return _stacked(parts)


def _stacked(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def share_where(df: DataFrame, condition: Column, name: str = "share", weight: str | None = None) -> DataFrame:
    """One row: the share of rows for which ``condition`` is true.

    In a frame of partial counts each row stands for ``weight`` rows.
    """
    if weight is None:
        return df.agg(F.avg(F.when(condition, 1).otherwise(0)).alias(name))
    return df.agg((F.sum(F.when(condition, F.col(weight)).otherwise(0)) / F.sum(weight)).alias(name))
