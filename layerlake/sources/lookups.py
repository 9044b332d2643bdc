"""Small lookup tables declared in code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed


def states(spark: SparkSession, rows=fixed.STATES) -> DataFrame:
    """State code, state name and region; a fixed 27 rows."""
    entries = [
        F.struct(F.lit(code).alias("state"), F.lit(name).alias("state_name"), F.lit(region).alias("region"))
        for code, name, region in rows
    ]
    return spark.range(1).select(F.inline(F.array(*entries)))


def with_region(customers: DataFrame, states_df: DataFrame, state: str = "state") -> DataFrame:
    """Left join of the state lookup; the lookup has one row per state, so it is broadcast."""
    return customers.join(F.broadcast(states_df), state, "left")
