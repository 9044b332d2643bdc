"""A long-form profile of a raw table before it is cleaned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .selection import quantiles

REACH = 1.5
OUTLIERS = {"column_name": "string", "low_fence": "double", "high_fence": "double", "n_outliers": "bigint"}


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name`` and ``n_distinct``, exactly but for hash collisions; nulls do not count.

    Rows become one short row per column, (column, 128-bit hash of the value),
    and equal ones are combined in the map tasks: a column of few values sends
    few rows, and long values are never moved. No copy of the whole row is made
    per column.
    """
    fraction = (T.FloatType, T.DoubleType)
    plain = [F.col(f"`{c}`") + 0.0 if isinstance(df.schema[c].dataType, fraction) else F.col(f"`{c}`") for c in columns]  # no -0.0
    values = F.array(*[_hashed(i, c) for i, c in enumerate(plain)])
    seen = df.select(F.explode(values).alias("v")).where("v.one IS NOT NULL").select("v.*").distinct()
    counts = seen.groupBy("column_no").agg(F.count("*").alias("n_distinct"))
    return counts.select(_named(columns).alias("column_name"), "n_distinct")


def _hashed(number: int, c: Column) -> Column:
    one = F.when(c.isNotNull(), F.xxhash64(c))
    return F.struct(F.lit(number).alias("column_no"), one.alias("one"), F.xxhash64(F.lit(1), c).alias("two"))


def _named(columns: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(c) for c in columns]), F.col("column_no"))


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name`` and ``value`` (double) of every number that is not null."""
    values = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])
    return df.select(F.inline(values)).where("value IS NOT NULL")


def fences(values: DataFrame, reach: float = REACH) -> DataFrame:
    """``column_name``, ``low_fence`` and ``high_fence``: ``reach`` interquartile ranges beyond the quartiles.

    ``values`` has column_name and value. Quartiles are values of the column
    (of n, the n/4-th and the 3n/4-th smallest, rounded up), found without a sort.
    """
    quartiles = quantiles(values, "value", ["0.25", "0.75"], "column_name")
    sides = quartiles.groupBy("column_name").agg(F.min("value").alias("q1"), F.max("value").alias("q3"))
    width = (F.col("q3") - F.col("q1")) * reach
    return sides.select("column_name", (F.col("q1") - width).alias("low_fence"), (F.col("q3") + width).alias("high_fence"))


def outliers(df: DataFrame, columns: Sequence[str] | None = None, reach: float = REACH) -> DataFrame:
    """``column_name``, both fences and ``n_outliers``, the values beyond them, of the numeric columns."""
    columns = _numeric(df) if columns is None else list(columns)
    if not columns:
        empty = df.sparkSession.range(0)
        return empty.select(*[F.lit(None).cast(k).alias(n) for n, k in OUTLIERS.items()])
    values = materialize(numbers(df, columns))  # read once to find the quartiles, once to count
    sides = fences(values, reach)  # one row per column
    beyond = (F.col("value") < F.col("low_fence")) | (F.col("value") > F.col("high_fence"))
    counted = values.join(F.broadcast(sides), "column_name").groupBy(*list(OUTLIERS)[:3])
    return counted.agg(F.count_if(beyond).alias("n_outliers"))


def profile_columns(df: DataFrame, *, exact_distinct: bool = True, reach: float = REACH) -> DataFrame:
    """One row per column: type, rows, nulls, distinct values, smallest, largest, non-positive numbers, outliers.

    Measures of fixed size take a single pass over the table. Distinct values
    are counted as :func:`distinct_values` does, or with ``exact_distinct=False``
    estimated in that same pass by a sketch. Outliers lie beyond the fences of
    :func:`outliers`; columns that hold no number have neither fences nor outliers.
    """
    measures = [F.count("*").alias("_rows")]
    for field in df.schema.fields:
        c, name = F.col(f"`{field.name}`"), field.name
        measures += [
            F.count_if(c.isNull()).alias(f"{name}__nulls"),
            F.min(c).cast("string").alias(f"{name}__min"),
            F.max(c).cast("string").alias(f"{name}__max"),
        ]
        if not exact_distinct:
            measures.append(F.approx_count_distinct(c).alias(f"{name}__distinct"))
        if isinstance(field.dataType, T.NumericType):
            measures.append(F.count_if(c <= 0).alias(f"{name}__low"))
    row = df.agg(*measures)
    entries = []
    for field in df.schema.fields:
        name = field.name
        numeric = isinstance(field.dataType, T.NumericType)
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col("_rows").alias("n_rows"),
                F.col(f"`{name}__nulls`").alias("n_nulls"),
                (F.lit(None).cast("bigint") if exact_distinct else F.col(f"`{name}__distinct`")).alias("_estimate"),
                F.col(f"`{name}__min`").alias("smallest"),
                F.col(f"`{name}__max`").alias("largest"),
                (F.col(f"`{name}__low`") if numeric else F.lit(0).cast("bigint")).alias("n_not_positive"),
            )
        )
    out = row.select(F.inline(F.array(*entries)))
    if exact_distinct:
        out = out.join(distinct_values(df, df.columns), "column_name", "left")
    else:
        out = out.withColumn("n_distinct", F.col("_estimate"))
    out = out.join(outliers(df, reach=reach), "column_name", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_distinct", "n_outliers")}
    return out.withColumns(zero).select(
        "column_name", "data_type", "n_rows", "n_nulls", "n_distinct", "smallest", "largest", "n_not_positive", *list(OUTLIERS)[1:]
    )


def duplicate_key_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, keys seen more than once, and rows beyond the first per key."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.count_if(F.col("_n") > 1).alias("n_duplicated_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_extra_rows"),
    )
