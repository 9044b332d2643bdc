"""URLs judged by rules on hosts and paths, found by hashes of host suffixes and path prefixes.

A rule names a host and the beginning of a path. It fits URLs of that host and
of all its subdomains whose path begins so. Every URL is expanded into its host
suffixes and path prefixes, only in the shapes (labels of the host, characters
of the path) that rules have. Each expression is hashed; its first four bytes
are joined with those of the rules, then the full digests are compared, and of
the rules that fit the longest holds (of equally long ones that with the longer
host). Without one the verdict is ``default``.

Rules are broadcast if together they are no larger than ``most_bytes``;
otherwise they are copied ``salts`` times, so that an expression that very many
URLs have is dealt over several tasks. The shapes are a handful: no more than
labels a host can have times lengths of paths.

A null URL, and one without ``://``, has empty host and path; no rule fits it.
Rules without a host are none; of equal rules ``block`` holds. Repeated rows are
judged each, null ids too. An empty table gives no rows; without rules all rows
get ``default``.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, stored

PREFIX_BYTES = 4
MOST_BYTES = 32 << 20
SALTS = 16

#: The rules of the registered query: host, path, verdict (fixed values).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, its A-Z lower-cased, and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return lower_ascii(host), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def digest(host: Column, path: Column) -> Column:
    return F.unhex(F.sha2(F.concat_ws("\0", host, path), 256))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def prepared(rules: DataFrame) -> DataFrame:
    """One row per host and path: its shape, digest, short digest, length, and ``held`` (what holds if it fits)."""
    rows = rules.select(
        lower_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.col("verdict")
    ).where("host != '' AND verdict IS NOT NULL")
    rows = rows.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    full = digest(F.col("host"), F.col("path"))
    rule = F.concat("host", "path")
    held = F.struct(F.char_length(rule).alias("chars"), F.char_length("host").alias("host_chars"), rule.alias("rule"), "verdict")
    return stored(
        rows.select(
            F.size(F.split("host", r"\.")).alias("labels"), F.char_length("path").alias("chars"),
            full.alias("rule_digest"), F.substring(full, 1, PREFIX_BYTES).alias("short"), held.alias("held"),
        )
    )


def judged(
    urls: DataFrame, rules: DataFrame, default: str = "allow", id_col="page_id", url_col="url",
    most_bytes: int = MOST_BYTES, salts: int = SALTS,
) -> DataFrame:
    """id, host, path, rule (or null) and verdict of every row. ``rules`` has host, path and verdict."""
    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    rows = urls.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()))  # the number goes with the row from here on
    known = prepared(rules)
    shapes = known.agg(F.collect_set(F.struct("labels", "chars"))).scalar()
    labels = F.split("host", r"\.")
    rows = rows.withColumn("shapes", shapes)
    fit = F.filter("shapes", lambda s: (s["labels"] <= F.size(labels)) & (s["chars"] <= F.char_length("path")))
    digests = F.transform(
        fit,
        lambda s: digest(
            F.array_join(F.slice(labels, F.size(labels) - s["labels"] + 1, s["labels"]), "."),
            F.substring(F.col("path"), F.lit(1), s["chars"]),
        ),
    )
    expressions = rows.select("row", "id", "host", "path", F.explode_outer(digests).alias("digest"))
    expressions = expressions.withColumn("short", F.substring("digest", 1, PREFIX_BYTES))
    table = known.select("short", "rule_digest", "held")
    size = table.agg(F.coalesce(F.sum(F.octet_length("held.rule") + 128), F.lit(0))).first()[0]
    if size <= most_bytes:
        both = expressions.join(F.broadcast(table), "short", "left")
    else:
        table = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        both = expressions.withColumn("salt", F.pmod("row", F.lit(salts)).cast("int")).join(table, ["short", "salt"], "left")
    confirmed = F.when(F.col("digest") == F.col("rule_digest"), F.col("held"))
    best = both.groupBy("row", "id", "host", "path").agg(F.max(confirmed).alias("b"))
    return best.select(
        F.col("id").alias(id_col), "host", "path", F.col("b.rule").alias("rule"), F.coalesce("b.verdict", F.lit(default)).alias("verdict")
    )


def allowed(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col="url", **limits) -> DataFrame:
    """The rows of ``pages`` whose URL is not blocked, with all their columns."""
    own = free_name(pages, "_u")
    urls = pages.select(F.col(f"`{url_col}`").alias(own)).distinct()
    blocked = judged(urls, rules, default, own, own, **limits).where("verdict = 'block'").select(F.col(own).alias(f"{own}b"))
    return pages.join(blocked, F.col(f"`{url_col}`").eqNullSafe(F.col(f"`{own}b`")), "left_anti")
