"""How the words of each source differ from those of the other sources of its language.

Every task counts the terms of its documents, how often and in how many
documents they occur. A document is counted in one task, so both counts add up
exactly, and one pass over the texts decides which terms a language keeps: those
of at least ``least`` of its documents.

Of the ASCII characters only letters belong to terms, and in UTF-8 no byte of
another character is ASCII. So terms are cut from bytes: one table turns A-Z to
lower case and what separates terms into spaces, and the text is split at these.

Shares are integers: p = 1 + floor(scale * (count + add) / (N + add * V)). The
distance of two sources is the sum of |p - q| over all kept terms. It is added up
per block of terms, in a matrix of bounded size, so that no pair of sources is
written out per term.

Null text, language and source count as empty. Every row is a document, repeated
ones too. A group without kept terms has shares of zero counts. A language
without kept terms has distances of 0. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, stored

LEAST = 30
TOP = 50
SCALE = 1_000_000_000
ADD = 5
ENTRIES = 400_000  # distinct terms a task holds before it hands them on
BLOCK = 20_000  # rows of a block of terms
CELLS = 4_000_000  # of a matrix
LONG = (1 << 63) - 1
TERM_BYTES = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def grouped_texts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    named = {"lang": lang_col, "source": source_col, "text": text_col}
    return docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for n, c in named.items()])


def term_counts(docs: DataFrame, text_col="text", lang_col="lang", source_col="source") -> DataFrame:
    """lang, source, term, n (occurrences) and docs; a term may have several rows of a group, to be added up.

    Documents are dealt by group first, large groups over several tasks, so that
    a task has few groups and most of a group's counts are added up in it.
    """

    def make():
        def flushed(occurrences, documents):
            for (lang, source), counts in documents.items():
                seen = occurrences[lang, source]
                terms = list(counts)
                n, size = list(map(seen.__getitem__, terms)), len(terms)
                yield pa.repeat(lang, size), pa.repeat(source, size), terms, n, list(counts.values())

        def work(langs, sources, texts):
            occurrences, documents = defaultdict(Counter), defaultdict(Counter)
            entries = 0
            for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), texts, strict=True):
                words = text.as_py().translate(TERM_BYTES).split()
                group = lang, source
                if words:
                    before = len(documents[group])
                    occurrences[group].update(words)
                    documents[group].update(set(words))
                    entries += len(documents[group]) - before
                    if entries > ENTRIES:
                        yield from flushed(occurrences, documents)
                        occurrences.clear(), documents.clear()
                        entries = 0
            yield from flushed(occurrences, documents)

        return work

    texts = grouped_texts(docs, text_col, lang_col, source_col).withColumn("text", F.col("text").cast("binary"))
    texts = texts.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("lang", "source", "row").drop("row")
    found = arrow_map(texts, make, "lang string, source string, term binary, n long, docs long")
    return found.withColumn("term", F.col("term").cast("string"))


def kept_terms(counts: DataFrame, least: int) -> DataFrame:
    """lang, source, term, n and n_lang, that of the whole language, of the terms in at least ``least`` of its documents; stored."""
    of_lang = Window.partitionBy("term", "lang")
    known = counts.withColumns({"docs_lang": F.sum("docs").over(of_lang), "n_lang": F.sum("n").over(of_lang)})
    known = known.where(F.col("docs_lang") >= least).groupBy("lang", "source", "term")
    return stored(known.agg(F.sum("n").alias("n"), F.max("n_lang").alias("n_lang")))


def share(count: str, total: str, scale: int, add: int) -> Column:
    """p of a count, from the columns ``total`` and ``v``; exact: in decimals where a product may not fit 64 bits."""
    whole = f"greatest({total} + {add} * v, 1)"
    part = f"(CAST({count} AS DECIMAL(24, 0)) + {add}) * CAST({scale} AS DECIMAL(12, 0))"
    wide = f"({part}) DIV CAST({whole} AS DECIMAL(24, 0))"
    short = f"((CAST({count} AS BIGINT) + {add}) * {scale}) DIV {whole}"
    return F.expr(f"1 + CASE WHEN {total} + {add} <= {LONG // scale} THEN {short} ELSE {wide} END")


def distances(shares: DataFrame, groups: DataFrame, n_blocks: int) -> DataFrame:
    """lang, source, item (another source) and value: the sum of |p - q| over all terms.

    ``shares``: lang, source, term, p of terms that occur in the group;
    ``groups``: lang, source and p0, the share of a term that does not. Every
    block of terms meets all groups of its language, also where it is empty.
    """
    blocks = shares.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(n_blocks)).cast("int"))
    every = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def sums(own: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        names = groups["source"].to_numpy()
        column = {name: i for i, name in enumerate(names)}
        rest = groups["p0"].to_numpy(np.int64)
        total = np.zeros((len(names), len(names)), np.int64)
        term, terms = pd.factorize(own["term"])
        source = own["source"].map(column).to_numpy(np.int64) if len(own) else np.zeros(0, np.int64)
        p, order = own["p"].to_numpy(np.int64), np.argsort(term, kind="stable")
        step = max(1, CELLS // len(names))
        for low in range(0, len(terms), step):
            a, b = np.searchsorted(term[order], [low, low + step])
            rows = order[a:b]
            matrix = np.tile(rest, (min(step, len(terms) - low), 1))
            matrix[term[rows] - low, source[rows]] = p[rows]
            for g in range(len(names)):
                total[g] += np.abs(matrix - matrix[:, g : g + 1]).sum(0)
        one, other = np.nonzero(~np.eye(len(names), dtype=bool))
        lang = groups["lang"].iloc[0]
        return pd.DataFrame({"lang": lang, "source": names[one], "item": names[other], "value": total[one, other]})

    keys = ["lang", "block"]
    both = blocks.select(*keys, "source", "term", "p").groupBy(*keys).cogroup(every.select(*keys, "source", "p0").groupBy(*keys))
    parts = both.applyInPandas(sums, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame, least: int = LEAST, top: int = TOP, scale: int = SCALE, add: int = ADD,
    text_col="text", lang_col="lang", source_col="source",
) -> DataFrame:
    """lang, source, part, item, value and rank.

    ``pair``: the distance of each other source of the language. ``term``: the
    ``top`` terms that the source uses more than its language, by p - q.
    """
    columns = {"text_col": text_col, "lang_col": lang_col, "source_col": source_col}
    used = kept_terms(term_counts(docs, **columns), least)
    sizes = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    v = used.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("v"))
    groups = grouped_texts(docs, **columns).select("lang", "source").distinct().join(sizes, ["lang", "source"], "left")
    of_lang = sizes.groupBy("lang").agg(F.sum("total").alias("total_lang")).join(v, "lang")
    groups = stored(groups.join(of_lang, "lang", "left").na.fill(0, ["total", "v", "total_lang"]))
    shares = used.join(groups, ["lang", "source"])
    p, q = share("n", "total", scale, add), share("n_lang", "total_lang", scale, add)
    shares = shares.select("lang", "source", "term", p.alias("p"), q.alias("q"))

    most = groups.groupBy("lang").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    n_blocks = max(1, used.count() // max(BLOCK, most * most))
    pairs = distances(shares, groups.select("lang", "source", share("0", "total", scale, add).alias("p0")), n_blocks)
    terms = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", F.col("rank").cast("int"))
