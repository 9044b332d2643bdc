"""Exact order statistics without a sort: histograms, narrowed to the bucket that holds the rank.

One pass counts the values between the smallest and the largest in ``BUCKETS``
ranges of equal width. The bucket in which a wanted rank falls is the range of
the next pass, from its smallest value to its largest, until a range is a
single value. Counts are combined in the map tasks; what moves is one row per
bucket and task, whatever the size of the table, and no rows are sorted. Every
pass divides the width by the number of buckets, so whole numbers of 64 bits
need seven passes at most, decimals of 38 digits thirteen. Floating numbers are
first divided by their logarithm, so that values of very different size take no
more.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from fractions import Fraction
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

BUCKETS = 1024


@dataclass
class Range:
    """Values of one group from ``low`` to ``high``; ``before`` values of the group are smaller."""

    group: str
    low: Any
    high: Any
    before: int
    by_size: bool  # divided by logarithm instead of by difference
    wanted: list[tuple[Decimal, int]] = field(default_factory=list)  # (share, rank)


def checked_shares(shares: Sequence[str]) -> list[Decimal]:
    out = [Decimal(s) for s in shares]
    for share in out:
        if not 0 < share <= 1 or -share.as_tuple().exponent > 15:
            raise ValueError(f"{share} is no share over 0 and up to 1 of at most 15 places")
    return out


def _working_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.IntegralType):
        return T.DecimalType(20, 0)  # differences of any two fit
    return kind if isinstance(kind, T.DecimalType) else T.DoubleType()


def _size(x: Column) -> Column:
    """Grows with ``x``; values that differ by a factor differ by a constant."""
    return F.when(x == 0, 0.0).otherwise(F.signum(x) * (F.log(F.abs(x)) + 746))


def _per_range(ranges: Sequence[Range], values: Sequence[Any], kind: T.DataType) -> Column:
    """The entry of ``values`` that belongs to the row's range."""
    return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("_range"))


def _in_ranges(values: DataFrame, ranges: Sequence[Range], kind: T.DataType) -> DataFrame:
    number = F.lit(None).cast("int")
    for i, r in enumerate(ranges):
        inside = (F.col("_group") == r.group) & F.col("_x").between(F.lit(r.low).cast(kind), F.lit(r.high).cast(kind))
        number = F.when(inside, i).otherwise(number)
    return values.withColumn("_range", number).where("_range IS NOT NULL")


def _histogram(values: DataFrame, ranges: Sequence[Range], kind: T.DataType) -> DataFrame:
    """One row per range and bucket that holds values: how many, the smallest and the largest."""
    low, high = (_per_range(ranges, [getattr(r, side) for r in ranges], kind) for side in ("low", "high"))
    share = (F.col("_x") - low).cast("double") / (high - low).cast("double")
    if any(_overflows(r, kind) for r in ranges):
        x, a, b = (c.cast("double") for c in (F.col("_x"), low, high))
        share = F.when(F.get(F.array(*[F.lit(_overflows(r, kind)) for r in ranges]), F.col("_range")), (x - a) / (b - a)).otherwise(share)
    if any(r.by_size for r in ranges):
        sizes = (_size(F.col("_x")) - _size(low)) / (_size(high) - _size(low))
        share = F.when(F.get(F.array(*[F.lit(r.by_size) for r in ranges]), F.col("_range")), sizes).otherwise(share)
    bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))
    rows = values.withColumn("_bucket", bucket)
    return rows.groupBy("_range", "_bucket").agg(F.count("*").alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high"))


def _first_ranges(values: DataFrame, shares: Sequence[Decimal], floating: bool) -> tuple[list[Range], list[tuple]]:
    """(a range for each group, (group, share, value) of ranks already known to be infinite or no number)."""
    x = F.col("_x")
    finite = F.when(F.abs(x) < float("inf"), x) if floating else x
    measures = [F.count("*").alias("n"), F.min(finite).alias("low"), F.max(finite).alias("high")]
    if floating:
        measures += [F.count_if(x == float(v)).alias(n) for v, n in (("-inf", "below"), ("inf", "above"), ("nan", "none"))]
    ranges, found = [], []
    for row in values.groupBy("_group").agg(*measures).collect():  # one row per group
        below, last = (row.below, row.n - row.above - row.none) if floating else (0, row.n)
        span = Range(row._group, row.low, row.high, below, floating)
        for share in shares:
            part = Fraction(share) * row.n
            rank = -(-part.numerator // part.denominator)
            if rank <= below:
                found.append((row._group, share, float("-inf")))
            elif rank > last:
                found.append((row._group, share, float("inf") if rank <= row.n - row.none else float("nan")))
            else:
                span.wanted.append((share, rank))
        if span.wanted:
            ranges.append(span)
    return ranges, found


def _narrowed(span: Range, buckets: Sequence) -> list[Range]:
    """The buckets that hold wanted ranks; ``buckets`` are in order."""
    out, before, left = [], span.before, sorted(span.wanted, key=lambda w: w[1])
    for b in buckets:
        inside = [w for w in left if w[1] <= before + b.n]
        if inside:
            out.append(Range(span.group, b.low, b.high, before, False, inside))
            left = left[len(inside) :]
        before += b.n
    return out


def quantiles(df: DataFrame, value: str, shares: Sequence[str], group: str | None = None) -> DataFrame:
    """``share`` and the ``ceil(share * n)``-th smallest value of the column, for each share; nulls do not count.

    With ``group`` (few different values, such as names of columns) for each
    group and share, with the group's column first. Numbers that are none come
    last, after infinity. No values give no rows.
    """
    wanted = checked_shares(shares)
    kind = df.schema[value].dataType
    inner = _working_type(kind)
    floating = isinstance(inner, T.DoubleType)
    label = F.lit("") if group is None else F.col(f"`{group}`").cast("string")
    values = df.select(label.alias("_group"), F.col(f"`{value}`").cast(inner).alias("_x"))
    values = materialize(values.where("_x IS NOT NULL AND _group IS NOT NULL"))  # read by every pass
    ranges, found = _first_ranges(values, wanted, floating)
    passes = 0
    while ranges:
        for r in (r for r in ranges if r.low == r.high):
            found += [(r.group, share, r.low) for share, _ in r.wanted]
        ranges = [r for r in ranges if r.low != r.high]
        if not ranges:
            break
        inside = _in_ranges(values, ranges, inner)
        if passes == 1:  # from now on only what the first histogram left
            values = materialize(inside.select("_group", "_x"))
            inside = _in_ranges(values, ranges, inner)
        if floating:
            for r in ranges:
                r.by_size = r.by_size and passes == 0 and _apart(r)
        rows = _histogram(inside, ranges, inner).collect()  # BUCKETS rows for each range at most
        rows.sort(key=lambda b: (b._range, b._bucket))
        ranges = [n for i, r in enumerate(ranges) for n in _narrowed(r, [b for b in rows if b._range == i])]
        passes += 1
    name = group or "_group"
    entries = [
        F.struct(F.lit(g).alias(name), F.lit(s).cast("decimal(16,15)").alias("share"), F.lit(v).cast(kind).alias(value))
        for g, s, v in sorted(found, key=lambda f: (f[0], f[1]))
    ]
    one = df.sparkSession.range(1)
    none = F.array().cast(T.ArrayType(T.StructType([
        T.StructField(name, T.StringType()), T.StructField("share", T.DecimalType(16, 15)), T.StructField(value, kind)])))
    out = one.select(F.inline(F.array(*entries) if entries else none))
    return out if group else out.drop("_group")


def _apart(r: Range) -> bool:
    """Whether a range of floating numbers is so wide that halving its width would take long."""
    return r.low < 0 < r.high or max(abs(r.low), abs(r.high)) > 1e6 * min(abs(r.low), abs(r.high))


def _overflows(r: Range, kind: T.DataType) -> bool:
    """Whether decimals differ by more than their type holds; as doubles they are still told apart."""
    return isinstance(kind, T.DecimalType) and Fraction(r.high) - Fraction(r.low) >= 10 ** (38 - kind.scale)
