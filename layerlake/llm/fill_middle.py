"""Fill-in-the-middle: texts cut into prefix, middle and suffix at unit borders, and written in another order.

Units are runs of Latin letters and single other characters. ``regexp_count``
gives their number n. Two places are drawn from a hash of the id; a pattern made
for the row, with possessive groups of exactly a and b - a units, captures all
three parts in one match, and one replacement writes them in the form's order.
Possessive repetition does not recurse, so units may be many. No Python.

A text stays ``plain`` if it is empty, holds one of the marks, or is drawn to.
Marks cannot occur in what is cut, so a written text is read back by splitting
at the marks. Null text counts as empty. Rows are handled alone: repeated rows
give equal rows, a null id is hashed as no digits, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text

UNITS = "[A-Za-z]+|[^A-Za-z]"
MARKS = "<[PSM]>"
WRITTEN = {"psm": "<P>$1<S>$3<M>$2", "spm": "<S>$3<P>$1<M>$2"}
PLAIN_PERCENT = 10
SPM_PERCENT = 20
SEED = 1


def draw(digest: Column, k: int) -> Column:
    """The k-th group of eight hexadecimal digits as a number, from 0."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def pattern(a: Column, b: Column) -> Column:
    """For a text of at least ``b`` units: its first ``a``, those up to ``b``, and the rest."""
    return F.concat(
        F.lit(rf"\A((?:{UNITS}){{"), a.cast("string"), F.lit(rf"}}+)((?:{UNITS}){{"), (b - a).cast("string"),
        F.lit(r"}+)((?s:.*))\z"),
    )


def part(output: Column, form: Column, wanted: str) -> Column:
    """The prefix, middle or suffix (``P``, ``M``, ``S``) of a written text; null for plain ones."""
    pieces = F.split(output, MARKS)  # nothing stands before the first mark
    at = F.when(form == "psm", "PSM".index(wanted) + 1).when(form == "spm", "SPM".index(wanted) + 1)
    return F.get(pieces, at)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from."""
    return F.when(form == "plain", output).otherwise(F.concat(*[part(output, form, w) for w in "PMS"]))


def transformed(
    docs: DataFrame, seed: int = SEED, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT,
    id_col="doc_id", text_col="text",
) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm) and output of every document."""
    rows = id_text(docs, id_col, text_col)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = rows.select("doc_id", "text", F.regexp_count("text", F.lit(UNITS)).cast("long").alias("n"), digest.alias("h"))
    one, two = (draw(F.col("h"), k) % (F.col("n") + 1) for k in (0, 1))
    plain = (F.col("text") == "") | F.col("text").rlike(MARKS) | (draw(F.col("h"), 2) % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(draw(F.col("h"), 3) % 100 < spm_percent, "spm").otherwise("psm")
    rows = rows.select("doc_id", "text", "n", form.alias("form"), F.least(one, two).alias("a"), F.greatest(one, two).alias("b"))
    order = F.when(F.col("form") == "spm", WRITTEN["spm"]).otherwise(WRITTEN["psm"])
    written = F.regexp_replace("text", pattern(F.col("a"), F.col("b")), order)
    return rows.select("doc_id", "n", "form", F.when(F.col("form") == "plain", F.col("text")).otherwise(written).alias("output"))


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, n, form, the lengths of prefix and middle, and SHA-256 of the output and of the text read back from it."""
    out, form = F.col("output"), F.col("form")
    read = rows.select("*", part(out, form, "P").alias("p"), part(out, form, "M").alias("m"), part(out, form, "S").alias("s"))
    back = F.when(form == "plain", out).otherwise(F.concat("p", "m", "s"))
    return read.select(
        "doc_id", "n", "form", F.char_length("p").cast("long").alias("prefix_chars"), F.char_length("m").cast("long").alias("middle_chars"),
        F.sha2(out, 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )
