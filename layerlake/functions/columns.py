"""Scalar column expressions, all built from Spark's own functions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed_values as fixed


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def title_pattern(titles: Sequence[str] = fixed.TITLES) -> str:
    """Pattern of a title, taken literally, at the start of a name: the title, a dot, at least one space."""
    return "^(" + "|".join(map(re.escape, titles)) + r")\.\s+"


def has_title(name: Column | str, titles: Sequence[str] = fixed.TITLES) -> Column:
    return _c(name).rlike(title_pattern(titles))


def clean_person_name(name: Column | str, titles: Sequence[str] = fixed.TITLES) -> Column:
    """Trim, take the leading title off, then capitalise each word."""
    return F.initcap(F.regexp_replace(F.trim(_c(name)), title_pattern(titles), ""))


def clean_code(code: Column | str) -> Column:
    return F.upper(F.trim(_c(code)))


def banded(value: Column | str, bands: Sequence[tuple[Any, str]], lowest: str, *, inclusive: bool) -> Column:
    """Label by descending thresholds: ``>=`` when inclusive, else ``>``; the rest gets ``lowest``."""
    value = _c(value)
    label = None
    for limit, name in bands:
        hit = value >= F.lit(limit) if inclusive else value > F.lit(limit)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return F.lit(lowest) if label is None else label.otherwise(lowest)


def translated(col: Column | str, labels: Mapping[Any, str]) -> Column:
    """Look a value up in a literal map; NULL when the map has no such key."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), _c(col))


def with_calendar(df: DataFrame, ts: str, weekdays: Mapping[int, str] = fixed.WEEKDAYS) -> DataFrame:
    """Add ``sale_date``, ``sale_hour``, ``weekday_no`` (1 = Sunday) and ``weekday``.

    The name is looked up by number, so it does not depend on the session's locale.
    """
    number = F.dayofweek(ts)
    return df.withColumns(
        {
            "sale_date": F.to_date(ts),
            "sale_hour": F.hour(ts),
            "weekday_no": number,
            "weekday": translated(number, weekdays),
        }
    )


def day_part(hour: Column | str, parts=fixed.DAY_PARTS, first: str = fixed.FIRST_DAY_PART) -> Column:
    return banded(hour, parts, first, inclusive=True)


def is_earlier(ts: Column | str, other: Column | str) -> Column:
    """``ts < other``; false when either is missing."""
    return F.coalesce(_c(ts) < _c(other), F.lit(False))


def price_position(ours: Column | str, low: Column | str, mean: Column | str, high: Column | str) -> Column:
    """Our price against the market. The extremes are tested before the mean."""
    ours, low, mean, high = _c(ours), _c(low), _c(mean), _c(high)
    return (
        F.when(ours > high, fixed.DEARER_THAN_ALL)
        .when(ours < low, fixed.CHEAPER_THAN_ALL)
        .when(ours > mean, fixed.ABOVE_MEAN)
        .when(ours < mean, fixed.BELOW_MEAN)
        .otherwise(fixed.AT_MEAN)
    )


def violates(rule: Column) -> Column:
    """True where a rule is false or cannot be decided."""
    return ~F.coalesce(rule, F.lit(False))


def conditional_set(df: DataFrame, column: str, value: Any, where: Column) -> DataFrame:
    """``UPDATE ... SET column = value WHERE where`` as a projection."""
    return df.withColumn(column, F.when(where, F.lit(value)).otherwise(F.col(column)))


def flatten_structs(df: DataFrame, separator: str = "_") -> DataFrame:
    """Turn every nested struct field ``a.b`` into a column ``a_b``, at any depth."""
    from pyspark.sql import types as T

    def leaves(struct: T.StructType, path: tuple[str, ...]):
        for field in struct.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                quoted = ".".join(f"`{p}`" for p in here)
                yield F.col(quoted).alias(separator.join(here))

    return df.select(*leaves(df.schema, ()))


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})
