"""Exact money arithmetic: DECIMAL(10,2) amounts, whole-cent totals, half-up means.

An amount column ``x`` may have a twin ``x_cents`` holding the same amount as
BIGINT cents. Totals and extremes read the twin when it is there: long
arithmetic stays primitive in generated code, while decimals are objects and
several times slower per row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AMOUNT = "decimal(10,2)"
TOTAL = "decimal(20,2)"
MEAN = "decimal(11,2)"
_WIDE = "decimal(18,2)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def amount(col: Column | str) -> Column:
    """A floating or text price as DECIMAL(10,2)."""
    return _c(col).cast(AMOUNT)


def price_cents(price: Column | str) -> Column:
    """A floating price in cents, rounded as the cast to DECIMAL(10,2) rounds.

    Prices within a millionth of a whole cent take the quick way; any other
    price goes through the decimal cast.
    """
    price = _c(price)
    scaled = price * 100
    whole = F.rint(scaled)
    return F.when(F.abs(scaled - whole) < 1e-6, whole.cast("bigint")).otherwise(to_cents(price.cast(AMOUNT)))


def line_revenue(quantity: Column | str, unit_price: Column | str) -> Column:
    """Quantity times unit price as DECIMAL(10,2); overflow is an error, not a wrong number."""
    return (_c(quantity) * _c(unit_price)).cast(AMOUNT)


def from_cents(cents: Column | str, kind: str = TOTAL) -> Column:
    return (_c(cents).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(kind)


def to_cents(money: Column | str) -> Column:
    """Whole cents, rounded half up."""
    return F.round(_c(money) * 100, 0).cast("bigint")


def total(money: Column | str) -> Column:
    """Exact DECIMAL(20,2) sum of a two-decimal column.

    Whole cents are added as BIGINT; overflow is an error.
    """
    return from_cents(F.sum(to_cents(money)))


def cents_of(df: DataFrame, money: str) -> Column:
    """The amount in cents: its twin column if ``df`` has one."""
    return F.col(f"{money}_cents") if f"{money}_cents" in df.columns else to_cents(money)


def total_of(df: DataFrame, money: str, where: Column | None = None) -> Column:
    """Exact DECIMAL(20,2) sum, over the rows where ``where`` holds if given (NULL for none)."""
    cents = cents_of(df, money)
    return from_cents(F.sum(cents if where is None else F.when(where, cents)))


def lowest_of(df: DataFrame, money: str) -> Column:
    return from_cents(F.min(cents_of(df, money)), AMOUNT)


def highest_of(df: DataFrame, money: str) -> Column:
    return from_cents(F.max(cents_of(df, money)), AMOUNT)


def without_cents(df: DataFrame) -> DataFrame:
    """``df`` without the cents twins of its amounts."""
    return df.drop(*[c for c in df.columns if c.endswith("_cents")])


def total_where(condition: Column, money: Column | str) -> Column:
    """Sum over the rows where ``condition`` holds; NULL when there are none."""
    return from_cents(F.sum(F.when(condition, to_cents(money))))


def mean(money_total: Column | str, n: Column | str) -> Column:
    """Half-up two-decimal mean from a total and a count; NULL for a count of zero."""
    n = _c(n)
    return F.when(n > 0, F.round(_c(money_total) / n, 2)).cast(MEAN)


def percent(part: Column | str, whole: Column | str, places: int = 1) -> Column:
    """``part`` as a percentage of ``whole``, exact decimals, half-up; NULL for a zero whole."""
    whole = _c(whole).cast(_WIDE)
    value = F.round(_c(part).cast(_WIDE) * 100 / F.nullif(whole, F.lit(0).cast(_WIDE)), places)
    return value.cast(f"decimal(19,{places})")


def percent_above(value: Column | str, base: Column | str, places: int = 2) -> Column:
    """How far ``value`` lies above ``base`` in percent of ``base`` (10 = ten percent dearer)."""
    value, base = _c(value), _c(base)
    return percent(value.cast(_WIDE) - base.cast(_WIDE), base, places)


def is_below_share(price: Column | str, reference: Column | str, share: Decimal) -> Column:
    """``price < reference * share`` in decimals; false when the reference is missing."""
    limit = _c(reference) * F.lit(share)
    return F.coalesce(_c(price) < limit, F.lit(False))


def format_brl(col: Column | str) -> Column:
    """Display text such as ``R$ 1.234,56`` from a decimal amount."""
    return F.concat(F.lit("R$ "), F.translate(F.format_number(_c(col), 2), ",.", ".,"))
