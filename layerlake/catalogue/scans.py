"""Queries over sources, snapshots and the expectation log."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import variants
from ..functions.columns import conditional_set, rename_columns
from ..operators import aggregates as agg
from ..session import ensure_checkpoint_dir
from ..sinks.snapshots import SnapshotTable
from ..sources import lookups, metrics_log
from ..sources.catalog import query_table, read_table
from ..sources.files import read_parquet
from .reference_sql import big, shown, sql, ts
from .registry import query


@query(
    "parquet_scan",
    "SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders",
    "SRC-1", "PRJ-1",
)
def _(t):
    schema = "o_orderkey bigint, o_custkey bigint, o_orderpriority string, o_totalprice double"
    return read_parquet(t.spark, f"{t.folder}/orders.parquet", schema)


@query(
    "nested_fields",
    f"SELECT event_id, event_type AS kind, {big('CAST(props->>{!r} AS BIGINT)'.format('$.k'), 'k')} FROM events",
    "SRC-5", "SF-13",
)
def _(t):
    parsed = t.table("events").withColumn("p", F.from_json("props", "k bigint"))
    return parsed.select("event_id", F.col("event_type").alias("kind"), F.col("p.k").alias("k"))


@query(
    "catalog_scan",
    f"SELECT {big('n_nationkey', 'n_nationkey')}, n_name, {big('n_regionkey', 'n_regionkey')} FROM nation",
    "SRC-6",
)
def _(t):
    t.table("nation").createOrReplaceTempView("layerlake_nation")
    return read_table(t.spark, "layerlake_nation")


@query(
    "parameterised_table_query",
    "SELECT event_type, count(*) AS n_rows FROM events WHERE value >= 50 GROUP BY event_type",
    "SRC-13",
)
def _(t):
    t.table("events").createOrReplaceTempView("layerlake_events")
    text = (
        "SELECT event_type, count(*) AS n_rows FROM IDENTIFIER(:t) "
        "WHERE value >= :least GROUP BY event_type"
    )
    return query_table(t.spark, "layerlake_events", text, least=50)


_STATE_ROWS = ", ".join(f"({i}, '{c}', '{n}', '{r}')" for i, (c, n, r) in enumerate(fixed.STATES))


@query(
    "state_lookup",
    f"""SELECT s.state, s.state_name, s.region, count(*) AS customers
        FROM customer c JOIN (VALUES {_STATE_ROWS}) AS s(i, state, state_name, region)
          ON c.c_nationkey = s.i GROUP BY ALL""",
    "SRC-10",
)
def _(t):
    codes = F.array(*[F.lit(code) for code, _, _ in fixed.STATES])
    located = t.table("customer").select("c_custkey", F.get(codes, F.col("c_nationkey")).alias("state"))
    return (
        lookups.with_region(located, lookups.states(t.spark))
        .groupBy("state", "state_name", "region")
        .agg(F.count("*").alias("customers"))
    )


def _log(t):
    """Events turned into an expectation log: two rules per event, counts from ``k``."""
    k = F.from_json("props", "k bigint")["k"]
    rule = '{"name":"%s","passed_records":%s,"failed_records":%s}'
    text = F.format_string(
        "[" + rule % ("low", "%d", "%d") + "," + rule % ("high", "%d", "%d") + "]", k, 100 - k, 200 - k, k
    )
    log = t.table("events").withColumn("details", text)
    return metrics_log.exploded_metrics(log, F.col("event_type"), F.col("ts"), F.col("details"))


_LOG = """(SELECT event_type AS dataset, ts AS recorded_at, r.rule,
                  CASE r.rule WHEN 'low' THEN k ELSE 200 - k END AS passed,
                  CASE r.rule WHEN 'low' THEN 100 - k ELSE k END AS failed
           FROM (SELECT *, CAST(props->>'$.k' AS BIGINT) AS k FROM events) e,
                (VALUES ('low'), ('high')) AS r(rule))"""


@query(
    "expectation_log",
    f"""SELECT dataset, rule, {big('sum(passed)', 'passed')}, {big('sum(failed)', 'failed')},
               count(*) AS n_events FROM {_LOG} GROUP BY ALL""",
    "SRC-12", "SF-13",
)
def _(t):
    return _log(t).groupBy("dataset", "rule").agg(
        F.sum("passed").alias("passed"), F.sum("failed").alias("failed"), F.count("*").alias("n_events")
    )


@query(
    "latest_expectations",
    f"""SELECT dataset, rule, {ts('recorded_at', 'recorded_at')}, passed, failed
        FROM (SELECT *, row_number() OVER (PARTITION BY dataset, rule
                 ORDER BY recorded_at DESC, passed DESC, failed DESC) AS rn FROM {_LOG}) WHERE rn = 1""",
    "DQ-24", "WN-7",
)
def _(t):
    return metrics_log.latest_metrics(_log(t))


_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in _TABLES),
    "QY-1", "SO-1", "PRJ-4",
)
def _(t):
    return agg.tagged_counts({n: t.table(n) for n in _TABLES})


@query(
    "updated_channel_counts",
    sql("""SELECT CASE WHEN channel = 'F' THEN 'STORE' ELSE channel END AS channel, count(*) AS n_rows
           FROM raw_lines GROUP BY 1"""),
    "SNK-8",
)
def _(t):
    changed = conditional_set(t.raw_lines(), "channel", "STORE", F.col("channel") == "F")
    return agg.value_counts(changed, "channel")


@query(
    "snapshot_versions",
    """SELECT CAST(0 AS BIGINT) AS version, o_orderstatus AS status, count(*) AS n_rows FROM orders GROUP BY 2
       UNION ALL
       SELECT 1, CASE WHEN o_orderstatus = 'O' THEN 'OPEN' ELSE o_orderstatus END, count(*)
       FROM orders GROUP BY 2
       UNION ALL
       SELECT 2, o_orderstatus, count(*) FROM orders GROUP BY 2""",
    "SNK-9", "QY-30",
)
def _(t):
    """Counts as of each version: first load, after an update, after restoring the first load."""
    root = f"{ensure_checkpoint_dir(t.spark)}/snapshots/{uuid.uuid4().hex}"
    table = SnapshotTable(t.spark, root)
    first = table.overwrite(t.table("orders").select("o_orderkey", F.col("o_orderstatus").alias("status")))
    table.update("status", "OPEN", F.col("status") == "O")
    table.restore(first)
    parts = [
        agg.value_counts(table.read(v), "status").select(F.lit(v).alias("version"), "status", "n_rows")
        for v in (0, 1, 2)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "renamed_projection",
    f"SELECT {big('n_nationkey', 'nation_id')}, n_name AS state, {big('n_regionkey', 'n_regionkey')} FROM nation",
    "PRJ-6",
)
def _(t):
    return rename_columns(t.table("nation"), {"n_nationkey": "nation_id", "n_name": "state"})


@query(
    "typed_supplier_balances",
    f"""SELECT s_suppkey, {shown('CAST(round(s_acctbal * 100) AS BIGINT)', 'balance')},
               CAST(NULL AS DOUBLE) AS credit FROM supplier""",
    "SF-4", "PRJ-4",
)
def _(t):
    return t.table("supplier").select(
        "s_suppkey",
        F.col("s_acctbal").cast("decimal(10,2)").alias("balance"),
        F.lit(None).cast("decimal(20,2)").alias("credit"),
    )


_UNTIDY = """CASE event_id % 10 WHEN 0 THEN '{"k": "many"}' WHEN 1 THEN '{"other": 1}'
             WHEN 2 THEN left(props, length(props) - 1) ELSE props END"""


@query(
    "fields_of_changing_shape",
    f"""WITH t AS (SELECT event_type, {_UNTIDY} AS x FROM events),
        p AS (SELECT event_type, json_valid(x) AS ok, CASE WHEN json_valid(x) THEN json_type(x, '$.k') END AS kind,
                     CASE WHEN json_valid(x) THEN try_cast(json_extract_string(x, '$.k') AS BIGINT) END AS k FROM t)
        SELECT event_type, count(*) AS n_rows, count(*) FILTER (WHERE NOT ok) AS n_malformed,
               count(*) FILTER (WHERE ok AND kind IS NULL) AS n_missing,
               count(*) FILTER (WHERE kind NOT IN ('BIGINT', 'UBIGINT')) AS n_wrong_type,
               CAST(sum(k) FILTER (WHERE kind IN ('BIGINT', 'UBIGINT')) AS BIGINT) AS k_total
        FROM p GROUP BY 1""",
    "SF-13", "SRC-5",
)
def _(t):
    rows = variants.parsed(t.table("events").select("event_type", F.expr(_UNTIDY).alias("text")), "text")
    state = variants.field_state("text", "fields", "$.k", "BIGINT")
    rows = rows.select("event_type", state.alias("state"), variants.field("fields", "$.k", "bigint").alias("k"))
    return rows.groupBy("event_type").agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col("state") == s).alias(f"n_{s}") for s in (variants.MALFORMED, variants.MISSING, variants.WRONG_TYPE)],
        F.sum(F.when(F.col("state") == variants.PRESENT, F.col("k"))).alias("k_total"),
    )
