"""From documents to packed training sequences, stage by stage.

Each stage reads all rows the one before it kept and applies its decisions:
quality rules reject documents, one document of each near-duplicate group stays,
repeated passages go, personal data is masked, and what is left is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from layerlake.llm import near_copies, packing, pii, quality_rules, repeats
from layerlake.llm.common import read, stored
from layerlake.session import drop, intermediate


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality_rules.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by 5-word shingles of Jaccard similarity 0.8 or more."""
    return near_copies.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words that repeated windows cover; ``n_chars`` follows the text."""
    return repeats.stripped(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked; the model is learned from these documents."""
    return pii.masked(docs, pii.learned(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence."""
    return packing.packed(docs, public_tokenizers.path(packing.FILE))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: Tokenizing and fingerprints are no SQL; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what each stage kept is stored for the next, all else it stored goes."""
    docs, before = read(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        with intermediate(spark) as made:
            docs = stored(stage(spark, docs, sf_dir))
            kept = made.pop()  # the last table is the stage's result
        drop(spark, before)
        before = [kept]
    return STAGES[-1][1](spark, docs, sf_dir)
