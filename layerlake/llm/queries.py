"""One query per operator over its whole table, with the SQL that states the same result where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe, divergence, fill_middle, licenses, packing, pii, quality_rules, repeats, revisits, simhash, token_counts,
    topk, url_rules,
)
from .common import read, stored
from .reference_sql import DIVERGENCE, FILL_MIDDLE, LICENSES, QUALITY, REPEATS, REVISITS, TOP_K, URL_RULES


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"))


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return pii.found(docs, pii.learned(docs))


HOT = "http://www.hot.example.org/news/?b=2&a=1"


def crawl(pages: DataFrame) -> DataFrame:
    """Archive records made from ``pages``: three captures of each address, and a revisit after each of them.

    Every third page is also a capture of one hot address. The content changes
    after the second capture; some captures are errors. Entity tags, times of
    modification and digests are missing on some of either side, and weak, old
    or of another capture on some revisits; which, follows from the page. A
    revisit's URL has a tracking parameter more than the page's.
    """
    page, k, n = F.col("page_id"), F.col("k"), F.col("n")
    seen = stored(pages.select("page_id", "url", F.char_length("html").alias("n"), F.md5("html").alias("d")))  # pages are read once
    hot = seen.where(page % 3 == 0).withColumn("url", F.lit(HOT)).withColumn("of", F.lit("h"))
    seen = seen.withColumn("of", F.lit("u")).unionByName(hot).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2))))
    seen = seen.withColumn("state", F.md5(F.concat_ws(":", "d", "of", F.floor(k / 2))))
    number = F.concat(page, F.col("of"), k)
    at = F.timestamp_seconds(F.lit(1_700_000_000) + 7 * page + 10_000 * k)
    tag, modified = F.concat(F.lit('"'), F.col("state"), F.lit('"')), F.concat(F.lit("at "), F.col("state"))

    def headers(**named):
        both = [x for name, value in named.items() for x in (F.lit(name.replace("_", "-")), value)]
        return F.map_filter(F.create_map(*both), lambda name, value: value.isNotNull())

    response = seen.select(
        F.concat(F.lit("p"), number).alias("record_id"), "url", F.lit("response").alias("warc_type"), at.alias("ts"),
        F.when((page + k) % 11 == 0, 404).otherwise(200).alias("status"),
        headers(
            ETag=F.when(n % 4 != 1, tag), Last_Modified=F.when(n % 3 != 2, modified), Content_Type=F.lit("text/html"),
            Content_Length=n.cast("string"), Cache_Control=F.lit("max-age=60"),
        ).alias("headers"),
        F.when(page % 7 != 3, F.col("state")).alias("digest"),
    )
    kind = (n + k) % 5
    weak = F.when(kind == 1, F.concat(F.lit("W/"), tag)).when(kind == 2, F.lit('"old"')).when(kind != 0, tag)
    bare = F.regexp_replace("url", r"#.*$", "")
    revisit = seen.select(
        F.concat(F.lit("r"), number).alias("record_id"),
        F.concat(bare, F.when(bare.contains("?"), "&").otherwise("?"), F.lit("utm_source=check#seen")).alias("url"),
        F.lit("revisit").alias("warc_type"), (at + F.expr("INTERVAL 600 SECONDS")).alias("ts"), F.lit(304).alias("status"),
        headers(
            etag=weak, Last_Modified=F.when((n + k) % 3 == 0, modified).when((n + k) % 3 == 1, F.lit("at first")),
            Content_Length=F.lit("0"), Cache_Control=F.concat(F.lit("max-age="), page),
        ).alias("headers"),
        F.when((page + k) % 4 == 0, F.col("state")).when((page + k) % 4 == 1, F.lit("other")).alias("digest"),
    )
    return response.unionByName(revisit)


def archive_revisits(spark: SparkSession, folder: str) -> DataFrame:
    out = revisits.resolved(crawl(read(spark, folder, "pages")))
    entries = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return out.select(
        "record_id", "canonical_url", "outcome", "refers_to", "digest", F.array_join(entries, ";").alias("headers"),
        F.unix_seconds("ts").alias("at"),
    )


def packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(read(spark, folder, "documents"), public_tokenizers.path(packing.FILE))


def tree(docs: DataFrame) -> DataFrame:
    """Documents as files of one tree per source: folders of 64 and of 8 ids; the first id of each holds its licence file."""
    d = F.col("doc_id")
    outer, inner = F.floor(d / 64), F.floor(d / 8)
    name = F.when(d % 8 == 0, "LICENSE").otherwise(F.concat(F.lit("f"), d, F.lit(".txt")))
    path = F.when(d % 64 == 0, F.concat_ws("/", "source", F.concat(F.lit("o"), outer), name)).otherwise(
        F.concat_ws("/", "source", F.concat(F.lit("o"), outer), F.concat(F.lit("i"), inner), name))
    return docs.select(d.alias("file_id"), path.alias("path"), "text")


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scanned(tree(read(spark, folder, "documents"))).withColumnRenamed("file_id", "doc_id")


def quality(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_rules.judged(read(spark, folder, "documents").select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return rows.select(F.col("doc_id").cast("long"), *[f"quality.{n}" for n in names])


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(read(spark, folder, "documents"), public_tokenizers.path(token_counts.FILE))


def exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(read(spark, folder, "embeddings"))


def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.without_repeats(read(spark, folder, "documents")).drop("kept")


def bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.round_trip(read(spark, folder, "documents"), public_tokenizers.path(byte_bpe.FILE))


def source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(read(spark, folder, "documents"))


def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judged(read(spark, folder, "pages"), url_rules.rule_table(spark, url_rules.RULES))


def fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.digests(fill_middle.transformed(read(spark, folder, "documents")))


QUERIES = {
    "op1_simhash": near_duplicates,
    "op2_pii": personal_data,
    "op3_revisits": archive_revisits,
    "op4_packing": packed_sequences,
    "op5_licenses": license_scan,
    "op6_quality": quality,
    "op7_token_counts": tokens,
    "op8_top_k": exact_top_k,
    "op9_repeats": repeated_passages,
    "op10_byte_bpe": bpe_round_trip,
    "op11_divergence": source_divergence,
    "op12_url_filter": url_verdicts,
    "op13_fill_middle": fill_in_middle,
}
ORACLES = {
    "op3_revisits": REVISITS, "op5_licenses": LICENSES, "op6_quality": QUALITY, "op8_top_k": TOP_K, "op9_repeats": REPEATS,
    "op11_divergence": DIVERGENCE, "op12_url_filter": URL_RULES, "op13_fill_middle": FILL_MIDDLE,
}
