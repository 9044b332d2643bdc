"""The quality scorecard: one row per rule, one pass per table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money

COLUMNS = ["rule", "table_name", "severity", "affected_rows", "affected_revenue"]


@dataclass(frozen=True)
class RowRule:
    """Counts the rows where ``condition`` holds, and sums ``revenue`` over them if given."""

    rule: str
    severity: str
    condition: Column
    revenue: str | None = None


def _entry(rule: str, table: str, severity: str, rows: Column, revenue: Column) -> Column:
    values = [F.lit(rule), F.lit(table), F.lit(severity), rows.cast("bigint"), revenue.cast(money.TOTAL)]
    return F.struct(*[v.alias(n) for v, n in zip(values, COLUMNS)])


def score_rows(df: DataFrame, table: str, rules: Sequence[RowRule]) -> DataFrame:
    """All row rules of one table in a single aggregation, turned into one row per rule."""
    nothing = F.lit(None)
    measures, entries = [], []
    for i, r in enumerate(rules):
        measures.append(F.count_if(r.condition).alias(f"_rows{i}"))
        if r.revenue:
            measures.append(money.total_of(df, r.revenue, r.condition).alias(f"_revenue{i}"))
        revenue = F.col(f"_revenue{i}") if r.revenue else nothing
        entries.append(_entry(r.rule, table, r.severity, F.col(f"_rows{i}"), revenue))
    return df.agg(*measures).select(F.inline(F.array(*entries)))


def score_count(counted: DataFrame, count: str, rule: str, table: str, severity: str) -> DataFrame:
    """A rule whose count comes from its own one-row frame."""
    return counted.select(
        F.inline(F.array(_entry(rule, table, severity, F.coalesce(F.col(count), F.lit(0)), F.lit(None))))
    )


def same_name_rows(df: DataFrame, name: str) -> DataFrame:
    """How many rows share their name with another row.

    Same as counting rows with ``COUNT(*) OVER (PARTITION BY name) > 1``, but
    summed from per-name counts: nothing is sorted and a frequent name collapses
    before the shuffle.
    """
    per_name = df.groupBy(name).agg(F.count("*").alias("_n"))
    return per_name.agg(F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).alias("n"))


def under_covered(df: DataFrame, entity: str, minimum: int) -> DataFrame:
    """Entities with fewer than ``minimum`` rows, with their row count."""
    return df.groupBy(entity).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") < minimum)


def stacked(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
