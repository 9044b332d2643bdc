"""Cross-row and cross-table checks: each counts problems, zero is a pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money
from ..functions.columns import violates
from .dedup import duplicated_keys


class CheckFailure(AssertionError):
    """At least one check found problems."""


def outside(column: str, allowed: Sequence) -> Column:
    """True for a value not in ``allowed``. A NULL is outside, unlike with SQL's NOT IN."""
    return violates(F.col(column).isin(list(allowed)))


def any_null(*columns: str) -> Column:
    found = F.lit(False)
    for c in columns:
        found = found | F.col(c).isNull()
    return found


@dataclass
class _Wanted:
    """What one table has to tell: numbers of rows that meet conditions, totals, keys that occur more than once."""

    rows: list[Column] = field(default_factory=list)
    totals: list[str] = field(default_factory=list)
    keys: list[tuple[str, ...]] = field(default_factory=list)


@dataclass
class CheckSuite:
    """Collects checks over named tables and runs them as one query.

    Each table is read once: row rules, totals and the row count are measured
    per value of its key, in the aggregation that also finds keys that occur
    more than once, and then added up. Only a second key of the same table
    needs another pass. All measures of all tables, one row each, are brought
    together and compared at the end.
    """

    tables: Mapping[str, DataFrame]
    _wanted: dict[str, _Wanted] = field(default_factory=dict)
    _checks: list[tuple[str, Callable[[Callable[[str], Column]], Column]]] = field(default_factory=list)

    def rows(self, table: str, label: str, problem: Column) -> CheckSuite:
        """Problem rows: those where ``problem`` is true."""
        found = self._rows(table, problem)
        return self._add(f"{table}: {label}", lambda of: of(found))

    def rule(self, table: str, label: str, rule: Column) -> CheckSuite:
        """Problem rows: those where ``rule`` is false or undecided."""
        return self.rows(table, label, violates(rule))

    def unique(self, table: str, keys: Sequence[str], label: str | None = None) -> CheckSuite:
        known = self._of(table).keys
        if tuple(keys) not in known:
            known.append(tuple(keys))
        found = f"{table}/key/{known.index(tuple(keys))}"
        return self._add(f"{table}: {label or 'unique ' + ', '.join(keys)}", lambda of: of(found))

    def same_total(self, base: str, other: str, value: str = "revenue") -> CheckSuite:
        """The total of ``value`` is equal in both tables; missing on one side is a problem."""
        one, two = self._total(base, value), self._total(other, value)
        differ = lambda of: F.when(of(one).eqNullSafe(of(two)), 0).otherwise(1)
        return self._add(f"{other}: total {value} equals {base}", differ)

    def same_count(self, base: str, other: str) -> CheckSuite:
        one, two = self._count(base), self._count(other)
        return self._add(f"{other}: row count equals {base}", lambda of: F.when(of(one) == of(two), 0).otherwise(1))

    def share_below(self, table: str, label: str, problem: Column, limit: Decimal) -> CheckSuite:
        bad, n = self._rows(table, problem), self._count(table)
        reached = lambda of: F.when((of(n) > 0) & (of(bad) >= of(n).cast("decimal(20,0)") * F.lit(limit)), 1).otherwise(0)
        return self._add(f"{table}: {label}", reached)

    def documented(self, table: str) -> CheckSuite:
        """Every column of the frame carries a comment."""
        missing = [f.name for f in self.tables[table].schema.fields if not f.metadata.get("comment", "").strip()]
        return self._add(f"{table}: every column has a comment", lambda of: F.lit(len(missing)))

    def results(self) -> DataFrame:
        """``check, n_problems, status`` for every check."""
        parts = [part for table in self._wanted for part in self._measured(table)]
        if parts:
            facts = parts[0]
            for part in parts[1:]:
                facts = facts.unionByName(part)
            # one short row for each measure of the suite
            facts = facts.agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("facts"))
        else:
            facts = next(iter(self.tables.values())).sparkSession.range(1)
        entries = [
            F.struct(F.lit(label).alias("check"), n(lambda name: F.col("facts")[name]).cast("bigint").alias("n_problems"))
            for label, n in self._checks
        ]
        status = F.when(F.col("n_problems") == 0, "OK").otherwise("FAILED")
        return facts.select(F.inline(F.array(*entries))).withColumn("status", status)

    def run(self) -> list:
        """Run all checks in one job; raise :class:`CheckFailure` naming those that failed."""
        found = self.results().collect()  # one row per check
        failed = [f"{r['check']} ({r['n_problems']})" for r in found if r["n_problems"]]
        if failed:
            raise CheckFailure("failed checks:\n- " + "\n- ".join(failed))
        return found

    def _of(self, table: str) -> _Wanted:
        return self._wanted.setdefault(table, _Wanted())

    def _rows(self, table: str, condition: Column) -> str:
        wanted = self._of(table)
        wanted.rows.append(condition)
        return f"{table}/rows/{len(wanted.rows) - 1}"

    def _total(self, table: str, value: str) -> str:
        totals = self._of(table).totals
        if value not in totals:
            totals.append(value)
        return f"{table}/total/{value}"

    def _count(self, table: str) -> str:
        self._of(table)
        return f"{table}/count"

    def _add(self, label: str, n_problems: Callable) -> CheckSuite:
        self._checks.append((label, n_problems))
        return self

    def _measured(self, table: str) -> list[DataFrame]:
        """(name, value) of all measures of one table."""
        df, wanted = self.tables[table], self._wanted[table]
        measures = [F.count("*").alias("_n")]
        measures += [F.count_if(problem).alias(f"_r{i}") for i, problem in enumerate(wanted.rows)]
        measures += [F.sum(money.cents_of(df, value)).alias(f"_t{i}") for i, value in enumerate(wanted.totals)]
        values = {f"{table}/count": F.col("_n")}
        values |= {f"{table}/rows/{i}": F.col(f"_r{i}") for i in range(len(wanted.rows))}
        values |= {f"{table}/total/{value}": money.from_cents(f"_t{i}") for i, value in enumerate(wanted.totals)}
        if not wanted.keys:
            return [_long(df.agg(*measures), values)]
        per_key = df.groupBy(*wanted.keys[0]).agg(*measures)
        names = ["_n", *[f"_r{i}" for i in range(len(wanted.rows))]]
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]
        sums += [F.sum(f"_t{i}").alias(f"_t{i}") for i in range(len(wanted.totals))]
        whole = per_key.agg(F.count_if(F.col("_n") > 1).alias("_twice"), *sums)
        out = [_long(whole, values | {f"{table}/key/0": F.col("_twice")})]
        for i, keys in enumerate(wanted.keys[1:], 1):
            twice = duplicated_keys(df, keys).agg(F.count("*").alias("_twice"))
            out.append(_long(twice, {f"{table}/key/{i}": F.col("_twice")}))
        return out


def _long(row: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    entries = [F.struct(F.lit(name).alias("name"), v.cast("decimal(38,2)").alias("value")) for name, v in values.items()]
    return row.select(F.inline(F.array(*entries)))


def _pair(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row measures side by side, merged by a one-group aggregation."""
    both = left.select(F.lit("left").alias("side"), "value").unionByName(
        right.select(F.lit("right").alias("side"), "value")
    )
    return both.agg(
        F.max(F.when(F.col("side") == "left", F.col("value"))).alias("left"),
        F.max(F.when(F.col("side") == "right", F.col("value"))).alias("right"),
    )


def totals_pair(left: DataFrame, right: DataFrame, value: str = "revenue") -> DataFrame:
    return _pair(
        left.agg(money.total_of(left, value).alias("value")),
        right.agg(money.total_of(right, value).alias("value")),
    )


def counts_pair(left: DataFrame, right: DataFrame) -> DataFrame:
    return _pair(left.agg(F.count("*").alias("value")), right.agg(F.count("*").alias("value")))


def share_reaches(df: DataFrame, problem: Column, limit: Decimal) -> DataFrame:
    """One row, ``n_problems`` = 1 when the share of problem rows is at or above ``limit``.

    Compared as ``problems >= limit * rows`` in decimals; an empty table passes.
    """
    counts = df.agg(F.count_if(problem).alias("bad"), F.count("*").alias("n"))
    reached = (F.col("n") > 0) & (F.col("bad") >= F.col("n").cast("decimal(20,0)") * F.lit(limit))
    return counts.select(F.when(reached, 1).otherwise(0).alias("n_problems"))
