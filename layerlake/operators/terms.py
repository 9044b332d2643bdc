"""Free text that mentions a term belonging to somebody else."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

GRAM = 3


def _grams_at_each_place(texts: DataFrame) -> DataFrame:
    """``_low`` and ``_gram``: the three characters from each place of a text on, fewer at its end, each once."""
    places = F.sequence(F.lit(1), F.greatest(F.length("_low"), F.lit(1)))
    grams = F.array_distinct(F.transform(places, lambda i: F.substring(F.col("_low"), i, F.lit(GRAM))))
    return texts.select("_low", F.explode(grams).alias("_gram"))


def _index(terms: DataFrame, frequency: DataFrame) -> DataFrame:
    """``_gram`` and ``_term``: every text that contains the term has one of its grams here.

    A term of three characters and more is filed under the one of its grams
    that the fewest texts have, shorter ones under all grams that begin with them.
    """
    long = terms.where(F.length("_term") >= GRAM)
    places = F.sequence(F.lit(1), F.length("_term") - (GRAM - 1))
    own = long.select("_term", F.explode(F.transform(places, lambda i: F.substring("_term", i, F.lit(GRAM)))).alias("_gram"))
    counted = own.join(frequency, "_gram", "left")
    rarest = counted.groupBy("_term").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_gram")).alias("r"))
    index = rarest.where("r.n > 0").select(F.col("r._gram").alias("_gram"), "_term")
    for size in range(GRAM):
        short = terms.where(F.length("_term") == size).select("_term")
        begins = F.substring("_gram", 1, size) == F.col("_term")
        index = index.unionByName(frequency.select("_gram").join(short, begins).select("_gram", "_term"))
    return index


def other_term_mentions(df: DataFrame, text: str, own: str) -> DataFrame:
    """Distinct (text, own) pairs whose text contains, in any case, a term other than ``own``.

    Terms are the distinct values of ``own`` in the whole frame. A pairwise
    "contains" test would compare every text with every term. Instead texts
    meet only those terms whose rarest three characters they have, by equality,
    and containment is tested on these candidates. A text makes at most one row
    per character, whatever the number of terms and their lengths.
    """
    pairs = materialize(df.where(F.col(own).isNotNull() & F.col(text).isNotNull()).select(text, own).distinct())
    terms = pairs.select(own).distinct().unionByName(
        df.where(F.col(own).isNotNull() & F.col(text).isNull()).select(own)
    ).groupBy(F.lower(own).alias("_term")).agg(F.min(own).alias("_owner"), F.max(own).alias("_last"))
    terms = materialize(terms)
    grams = _grams_at_each_place(pairs.select(F.lower(text).alias("_low")).distinct())
    frequency = materialize(grams.groupBy("_gram").agg(F.count("*").alias("_n")))
    candidates = grams.join(_index(terms, frequency), "_gram").select("_low", "_term").distinct()
    found = candidates.where(F.col("_low").contains(F.col("_term"))).join(terms, "_term")
    named = pairs.withColumn("_low", F.lower(text))
    foreign = (F.col("_owner") != F.col("_last")) | (F.col("_owner") != F.col(own))
    return named.join(found, (named["_low"] == found["_low"]) & foreign, "left_semi").select(text, own)


def rows_mentioning_other_term(df: DataFrame, text: str, own: str) -> DataFrame:
    """The rows of ``df`` whose text mentions another term."""
    return df.join(other_term_mentions(df, text, own), [text, own], "left_semi")
