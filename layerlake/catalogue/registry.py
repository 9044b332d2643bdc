"""Registration of queries together with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.bindings import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None
    covers: tuple[str, ...]

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return plain(self.build(Tables(spark, folder)))


QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None, *covers: str):
    """Register the decorated ``Tables -> DataFrame`` function under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(name, build, oracle, covers)
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Types every SQL client reads alike: decimals as double, integers as bigint, dates and times as text.

    Times carry six decimals; those without a zone do not depend on the session's zone.
    """
    out = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            c = c.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(kind, T.DateType):
            c = c.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            text = c.cast("string")  # a fraction is shown only if there is one
            c = F.rpad(F.when(text.contains("."), text).otherwise(F.concat(text, F.lit("."))), 26, "0")
        out.append(c.alias(field.name))
    return df.select(*out)
