"""One row per key, chosen by value so that reruns and retries agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the smallest row per key, comparing the other columns from left to right.

    ``dropDuplicates`` keeps whichever row arrives first. Taking the minimum of
    a struct is as cheap, is the same on every run, and is combined before the
    shuffle: a key holding a third of all rows leaves each map task as one row.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    if len(rest) == 1:  # a number or date is kept by hash, without a sort; as in a struct, null is the smallest
        least = F.when(~F.bool_or(F.col(rest[0]).isNull()), F.min(rest[0]))
        return df.groupBy(*keys).agg(least.alias(rest[0])).select(*df.columns)
    picked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return picked.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def latest_by_key(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Keep the row with the greatest ``ts`` per key; ties go to the greatest remaining columns."""
    keys = list(keys)
    rest = [ts] + [c for c in df.columns if c not in keys and c != ts]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return picked.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)
