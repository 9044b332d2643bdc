"""Compare registered queries with their SQL on the same Parquet tables."""

from __future__ import annotations

import math
import pathlib

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = pathlib.Path(folder) / f"{name}.parquet"
        if path.exists():
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows(names, records):
    """Rows as tuples in column-name order, floats to nine significant digits, sorted."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        if isinstance(v, bool) or v is None:
            return repr(v)
        if isinstance(v, (int, float)):
            return "nan" if isinstance(v, float) and math.isnan(v) else f"{float(v):.9g}"
        return str(v)

    return sorted(tuple(value(r[i]) for i in order) for r in records)


def differences(query, spark, folder, con):
    """(column names, rows) of both sides, equal when the query is right, and the Spark plan."""
    df = query(spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    got = sorted(df.columns), rows(df.columns, df.collect())
    result = con.sql(query.oracle)
    want = sorted(result.columns), rows(result.columns, result.fetchall())
    return got, want, plan
