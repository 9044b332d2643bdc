"""Nested fields of changing shape: JSON text as VARIANT, read by path and type, malformed text kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MALFORMED, MISSING, WRONG_TYPE, PRESENT = "malformed", "missing", "wrong_type", "present"


def parsed(df: DataFrame, text: str, name: str = "fields") -> DataFrame:
    """``df`` with the text as VARIANT; what is not JSON gives null there, as a null text does."""
    return df.withColumn(name, F.try_parse_json(F.col(text)))


def split_malformed(df: DataFrame, text: str, name: str = "fields") -> tuple[DataFrame, DataFrame]:
    """(rows with the text as VARIANT, rows whose text is not JSON as they came). A null text is no fault."""
    rows = parsed(df, text, name)
    bad = F.col(text).isNotNull() & F.col(name).isNull()
    return rows.where(~bad), rows.where(bad).drop(name)


def field(variant: Column | str, path: str, kind: str) -> Column:
    """The field at the path (``$.a.b[0]``) as ``kind``; null where it is missing or does not fit."""
    return F.try_variant_get(variant, path, kind)


def field_state(text: Column | str, variant: Column | str, path: str, *kinds: str) -> Column:
    """``malformed``, ``missing`` (also JSON null), ``wrong_type`` or ``present`` for each row.

    ``kinds`` are the types the field may have in the data, as ``schema_of_variant``
    names them (``BIGINT``, ``DOUBLE``, ``STRING``). No value is converted to find out.
    """
    text, variant = (F.col(c) if isinstance(c, str) else c for c in (text, variant))
    inner = F.try_variant_get(variant, path, "variant")
    return (
        F.when(text.isNotNull() & variant.isNull(), MALFORMED)
        .when(inner.isNull() | F.is_variant_null(inner), MISSING)
        .when(F.schema_of_variant(inner).isin(list(kinds)), PRESENT)
        .otherwise(WRONG_TYPE)
    )


def observed_schema(df: DataFrame, variant: str) -> DataFrame:
    """One row, ``observed``: the smallest schema that all values of the column fit."""
    return df.agg(F.schema_of_variant_agg(variant).alias("observed"))
