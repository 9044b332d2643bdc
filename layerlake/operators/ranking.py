"""Row numbers over whole tables without gathering the rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .selection import quantiles

_POS, _SLOT, _BEFORE = "_pos", "_slot", "_before"
_IN_SLOT = (1 << 33) - 1  # monotonically_increasing_id: partition in the upper bits, row in the lower 33


def _placed(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` in total order, each row carrying its partition number and its place in it.

    The global sort is a range shuffle plus a local sort. The result is stored
    so that counting and numbering see the same partition boundaries.
    """
    stored = materialize(df.orderBy(*order).withColumn(_POS, F.monotonically_increasing_id()))
    return stored.withColumns(
        {_SLOT: F.shiftright(_POS, 33), _POS: F.col(_POS).bitwiseAND(F.lit(_IN_SLOT))}
    )


def _earlier(count: str, *group: str) -> Column:
    window = Window.partitionBy(*group).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(count).over(window), F.lit(0))


def global_rank(df: DataFrame, order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order)``; end ``order`` with a unique key.

    The offsets have one row per sorted partition, so broadcasting them is
    bounded by the partition count, not by the data.
    """
    placed = _placed(df, order)
    sizes = placed.groupBy(_SLOT).agg(F.count("*").alias("_n"))
    offsets = sizes.select(_SLOT, _earlier("_n").alias(_BEFORE))
    ranked = placed.join(F.broadcast(offsets), _SLOT)
    return ranked.withColumn(name, F.col(_BEFORE) + F.col(_POS) + 1).drop(_SLOT, _POS, _BEFORE)


def rank_within(
    df: DataFrame, group: str, order: Sequence[Column | str], name: str = "rank"
) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY group ORDER BY order)`` for groups of any size.

    Rows are range-sorted by (group, order): a large group spreads over many
    tasks. A run is one group inside one partition; a row's number is its place
    in the run plus the sizes of the group's earlier runs.
    """
    placed = _placed(df, [group, *order])
    runs = placed.groupBy(_SLOT, group).agg(F.min(_POS).alias("_start"), F.count("*").alias("_n"))
    runs = runs.select(
        F.col(_SLOT).alias("_run_slot"),
        F.col(group).alias("_run_group"),
        "_start",
        _earlier("_n", group).alias(_BEFORE),
    )
    same = (F.col(_SLOT) == F.col("_run_slot")) & F.col(group).eqNullSafe(F.col("_run_group"))
    return (
        placed.join(runs, same)
        .withColumn(name, F.col(_BEFORE) + F.col(_POS) - F.col("_start") + 1)
        .drop(_SLOT, _POS, _BEFORE, "_start", "_run_slot", "_run_group")
    )


def previous_value(
    df: DataFrame, order: Sequence[Column | str], value: str, name: str, group: str | None = None
) -> DataFrame:
    """``LAG(value) OVER ([PARTITION BY group] ORDER BY order)`` for tables and groups of any size.

    Rows are range-sorted by (group, order). Inside a partition the row before
    is at hand; the first row of a partition takes its value from the last row
    of the partition before, one carried row per partition, if that is of the
    same group. End ``order`` with a unique key.
    """
    placed = _placed(df, [*([group] if group else []), *order])
    carried = [F.col(value).alias("_value"), (F.col(group) if group else F.lit(0)).alias("_of")]
    edges = placed.groupBy(_SLOT).agg(F.max_by(F.struct(*carried), _POS).alias("_last"))
    filled = sorted(r[0] for r in placed.select(_SLOT).distinct().collect())  # one number per partition
    following = [None] * (filled[-1] + 1) if filled else [None]
    for slot, after in zip(filled, filled[1:], strict=False):
        following[slot] = after
    after = F.get(F.array(*[F.lit(x).cast("bigint") for x in following]), F.col(_SLOT).cast("int"))
    edges = edges.select(after.alias("_next"), "_last").where("_next IS NOT NULL")
    inside = Window.partitionBy(_SLOT).orderBy(_POS)
    rows = placed.withColumn("_lag", F.lag(F.struct(*carried)).over(inside))
    rows = rows.join(F.broadcast(edges), (F.col(_SLOT) == F.col("_next")) & (F.col(_POS) == 0), "left")
    before = F.coalesce("_lag", "_last")
    if group:
        before = F.when(before["_of"].eqNullSafe(F.col(group)), before)
    return rows.withColumn(name, before["_value"]).drop(_SLOT, _POS, "_lag", "_next", "_last")


def sampled(df: DataFrame, n: int, key: Sequence[str], seed: int = 0, group: Sequence[str] = ()) -> DataFrame:
    """``n`` rows, or ``n`` of each group, by chance but the same on every run: those whose hash is smallest.

    The hash is the MD5 of the seed and the key, so the choice does not depend
    on partitions or order, and a larger sample holds the smaller one. Each
    task keeps only its ``n`` rows before the merge. Equal keys are
    interchangeable; a null counts as an empty text.
    """
    parts = [F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]]
    rows = df.withColumn("_hash", F.md5(F.concat_ws(":", *parts).cast("binary")))
    order = ["_hash", *key]
    chosen = top_k_per_group(rows, group, order, n, "_place").drop("_place") if group else top_n(rows, order, n)
    return chosen.drop("_hash")


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows; each task keeps only ``n`` before the merge."""
    return df.orderBy(*order).limit(n)


def top_ranked(df: DataFrame, order: Sequence[Column | str], n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows with their row number, without ranking the rest.

    The window has no partitions, but only the ``n`` rows of the limit reach it.
    """
    return top_n(df, order, n).withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int, name: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group.

    Spark limits every group inside each map task before the shuffle, so even
    one huge group sends at most ``k`` rows per task to its reducer.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)


def exact_quantiles(df: DataFrame, value: str, key: str, shares: Sequence[str]) -> DataFrame:
    """The values at the given shares of the ranked rows (``ceil(share * n)``-th smallest), exactly.

    One row per share. Shares are decimals over 0 and up to 1, of at most 15 places. Nothing is sorted, and
    ``key`` is not read: rows that differ only by it have the same value.
    """
    return quantiles(df.select(value), value, shares)
