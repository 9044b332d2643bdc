"""Expectation metrics kept as JSON in an event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import latest_by_key

EXPECTATIONS = "array<struct<name:string,passed_records:bigint,failed_records:bigint>>"


def exploded_metrics(log: DataFrame, dataset: Column, at: Column, expectations_json: Column) -> DataFrame:
    """One row per (event, rule): dataset, time, rule, passed and failed records."""
    parsed = log.select(
        dataset.alias("dataset"),
        at.alias("recorded_at"),
        F.explode(F.from_json(expectations_json, EXPECTATIONS)).alias("e"),
    )
    return parsed.select(
        "dataset",
        "recorded_at",
        F.col("e.name").alias("rule"),
        F.col("e.passed_records").alias("passed"),
        F.col("e.failed_records").alias("failed"),
    )


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """The most recent row per dataset and rule."""
    return latest_by_key(metrics, ["dataset", "rule"], "recorded_at")
