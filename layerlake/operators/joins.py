"""Lookups that never lose a fact row, and their opposites.

No side is hinted: Spark broadcasts a dimension only when its measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a shuffled
join that adaptive execution splits on hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import money
from ..functions.columns import is_earlier


def orphans(facts: DataFrame, dimension: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Facts whose key is missing in the dimension."""
    on = [on] if isinstance(on, str) else list(on)
    return facts.join(dimension.select(*on), on, "left_anti")


def without_facts(dimension: DataFrame, facts: DataFrame, on: str) -> DataFrame:
    """Dimension rows that no fact refers to. Fact keys are made distinct before they are shuffled."""
    return dimension.join(facts.select(on).distinct(), on, "left_anti")


def with_registration_flags(
    facts: DataFrame,
    dimension: DataFrame,
    on: str,
    happened_at: str,
    created_at: str,
    *,
    keep: Sequence[str] = (),
    registered: str = "is_registered",
    too_early: str = "is_before_registration",
) -> DataFrame:
    """Left join a unique dimension and flag, without dropping, the facts that do not fit.

    ``registered`` is false for an unknown key; ``too_early`` is true when the
    fact is older than its entity. ``keep`` carries further dimension columns.
    """
    side = dimension.select(
        on, F.col(created_at).alias("_created"), F.lit(True).alias("_known"), *keep
    )
    return (
        facts.join(side, on, "left")
        .withColumns(
            {
                registered: F.coalesce("_known", F.lit(False)),
                too_early: is_earlier(happened_at, "_created"),
            }
        )
        .drop("_known", "_created")
    )


def zero_filled(
    dimension: DataFrame, totals: DataFrame, on: str, defaults: Mapping[str, object]
) -> DataFrame:
    """Every dimension row with its totals; entities without facts get the given defaults.

    ``totals`` is already aggregated per key, so the join is one to one and a
    hot entity has been reduced to a single row before it is shuffled.
    """
    return dimension.join(totals, on, "left").fillna(dict(defaults))


def join_loss(facts: DataFrame, dimension: DataFrame, on: str, revenue: str) -> DataFrame:
    """Total with and without the inner join: what the join silently drops.

    One pass: the facts are totalled per key first, then the per-key totals are
    matched, so no fact row is shuffled for the comparison.
    """
    per_key = facts.groupBy(on).agg(money.total_of(facts, revenue).alias("_total"))
    known = dimension.select(on, F.lit(True).alias("_known"))
    both = per_key.join(known, on, "left").agg(
        money.total("_total").alias("without_join"),
        money.total_where(F.col("_known"), "_total").alias("with_join"),
    )
    return both.select(
        F.inline(
            F.array(
                F.struct(F.lit("without join").alias("variant"), F.col("without_join").alias("revenue")),
                F.struct(F.lit("with join").alias("variant"), F.col("with_join").alias("revenue")),
            )
        )
    )

