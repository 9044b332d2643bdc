"""Declared datasets: a typed, commented schema, row expectations, and a refresh that publishes or refuses.

A refresh computes the whole dataset, counts expectations while the rows are
being written to a staging folder, and publishes the folder only if no ``fail``
rule was broken. Otherwise the folder is deleted and the previous version stays what
readers see.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import money
from ..functions.columns import violates
from .snapshots import SnapshotTable
from .tables import clustered

WARN, DROP, FAIL = "warn", "drop", "fail"
ROWS = "rows"
METRICS = "_expectation_metrics"
METRICS_SCHEMA = (
    "dataset string, rule string, action string, passed bigint, failed bigint, recorded_at timestamp"
)


class ExpectationFailure(RuntimeError):
    """A ``fail`` rule was broken; nothing was published."""


@dataclass(frozen=True)
class Expectation:
    """A rule about one row, as SQL text or a column. Undecided (NULL) counts as broken."""

    name: str
    rule: Column | str
    action: str = WARN

    @property
    def broken(self) -> Column:
        rule = self.rule
        return violates(F.expr(rule) if isinstance(rule, str) else rule)


@dataclass(frozen=True)
class Dataset:
    name: str
    schema: T.StructType
    build: Callable[[Callable[[str], DataFrame]], DataFrame]
    comment: str = ""
    expectations: Sequence[Expectation] = ()
    cluster_by: Sequence[str] = ()
    totals: Sequence[str] = ()  # two-decimal columns whose totals are kept with each version


@dataclass(frozen=True)
class Refresh:
    version: int
    rows: int
    failed: Mapping[str, int] = field(default_factory=dict)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to the declared columns, carrying their comments."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in schema.fields
        ]
    )


def split_on(df: DataFrame, rules: Sequence[Expectation]) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy every rule, rows that break at least one)."""
    broken = F.lit(False)
    for r in rules:
        broken = broken | r.broken
    return df.where(~broken), df.where(broken)


def expectation_counts(df: DataFrame, dataset: str, rules: Sequence[Expectation]) -> DataFrame:
    """One row per rule: dataset, rule, action, passed, failed, from a single pass."""
    n = F.count(F.lit(1))
    counts = df.agg(n.alias("_n"), *[F.count_if(r.broken).alias(f"_f{i}") for i, r in enumerate(rules)])
    entries = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(r.name).alias("rule"),
            F.lit(r.action).alias("action"),
            (F.col("_n") - F.col(f"_f{i}")).alias("passed"),
            F.col(f"_f{i}").alias("failed"),
        )
        for i, r in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*entries)))


class Lake:
    """Datasets stored as snapshot tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def table(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/{name}")

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()

    def metrics(self) -> DataFrame:
        """Every recorded expectation count, with the time it was recorded."""
        return self.spark.read.schema(METRICS_SCHEMA).json(f"{self.root}/{METRICS}")

    def refresh(self, dataset: Dataset) -> Refresh:
        rows = dataset.build(self.read)
        rules = list(dataset.expectations)
        flagged = {f"_broken{i}": r.broken for i, r in enumerate(rules)}
        rows = clustered(rows, dataset.cluster_by)

        # The counts sit above the layout shuffle, in the stage that writes the files:
        # a re-run of an earlier stage cannot count a row twice.
        seen = Observation()
        measured = rows.withColumns(flagged).observe(
            seen,
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(F.col(flag)).alias(flag) for flag in flagged],
        )
        kept = measured
        for i, r in enumerate(rules):
            if r.action == DROP:
                kept = kept.where(~F.col(f"_broken{i}"))
        table = self.table(dataset.name)
        # what is in the files: their rows and totals, seen by the tasks that write them
        written = Observation()
        sums = [F.sum(money.to_cents(F.col(c))).alias(c) for c in dataset.totals]
        final = conform(kept, dataset.schema).observe(written, F.count(F.lit(1)).alias(ROWS), *sums)
        folder = table.stage(final)
        counts = seen.get
        failed = {r.name: counts[f"_broken{i}"] for i, r in enumerate(rules)}
        self._record(dataset, counts["n"], failed)

        fatal = {r.name: failed[r.name] for r in rules if r.action == FAIL and failed[r.name]}
        if fatal:
            table.discard(folder)
            raise ExpectationFailure(f"{dataset.name}: {fatal}")
        held = written.get
        cents = {c: held[c] for c in dataset.totals}
        measures = {ROWS: held[ROWS]} | {c: None if v is None else Decimal(v).scaleb(-2) for c, v in cents.items()}
        version = table.publish([folder], dataset.schema, "REFRESH", dataset.comment or None, measures)
        return Refresh(version, held[ROWS], failed)

    def measure(self, name: str, measure: str = ROWS, *, scan: bool = False) -> tuple[Decimal | None, str]:
        """The rows of a dataset, or the total of a column, and where it is from.

        ``log``: measured when the version was written, nothing is read.
        ``scan``: counted again in the files, on request or if the version has no such measure.
        """
        known = None if scan else self.table(name).measures()
        if known is not None and measure in known:
            return known[measure], "log"
        rows = self.read(name)
        counted = rows.agg(F.count("*").alias("n") if measure == ROWS else money.total_of(rows, measure).alias("n")).first()
        return None if counted["n"] is None else Decimal(counted["n"]), "scan"

    def reconciled(self, base: str, others: Sequence[str], measure: str = ROWS, *, scan: bool = False) -> DataFrame:
        """One row per other dataset: its measure against that of ``base``, whether they are equal, and where both are from."""
        left, from_base = self.measure(base, measure, scan=scan)
        entries = []
        for other in others:
            right, from_other = self.measure(other, measure, scan=scan)
            entries.append(
                F.struct(
                    F.lit(base).alias("base"),
                    F.lit(other).alias("other"),
                    F.lit(measure).alias("measure"),
                    F.lit(left).cast("decimal(38,2)").alias("left"),
                    F.lit(right).cast("decimal(38,2)").alias("right"),
                    F.lit(left == right).alias("is_equal"),
                    F.lit("log" if from_base == from_other == "log" else "scan").alias("source"),
                )
            )
        return self.spark.range(1).select(F.inline(F.array(*entries)))

    def refresh_all(self, datasets: Sequence[Dataset]) -> dict[str, Refresh]:
        """Refresh in the given order; a failure stops the ones after it."""
        return {d.name: self.refresh(d) for d in datasets}

    def _record(self, dataset: Dataset, n: int, failed: Mapping[str, int]) -> None:
        """Append one line per rule to the metrics log, whether or not the refresh is published."""
        if not dataset.expectations:
            return
        entries = [
            F.struct(
                F.lit(dataset.name).alias("dataset"),
                F.lit(r.name).alias("rule"),
                F.lit(r.action).alias("action"),
                F.lit(n - failed[r.name]).alias("passed"),
                F.lit(failed[r.name]).alias("failed"),
            )
            for r in dataset.expectations
        ]
        rows = self.spark.range(1).select(F.inline(F.array(*entries)), F.current_timestamp().alias("recorded_at"))
        rows.coalesce(1).write.mode("append").json(f"{self.root}/{METRICS}")
