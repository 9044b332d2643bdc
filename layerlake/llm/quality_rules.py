"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Text is read whole. Null text counts as empty. An empty text has no words and
fails the length rule; a ratio whose denominator is zero is null and breaks no
rule. Every row is judged alone, so repeated rows get equal verdicts and an
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import any_of, free_name

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8

#: Frequent short words of four languages (fixed values).
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "have", "he", "in", "is", "it", "not",
    "of", "on", "or", "that", "the", "this", "to", "was", "were", "with",
    "au", "avec", "ce", "dans", "de", "des", "du", "elle", "en", "est", "et", "il", "la", "le", "les", "ne", "par",
    "pas", "pour", "que", "qui", "sur", "un", "une",
    "auf", "aus", "bei", "das", "dem", "den", "der", "die", "ein", "eine", "es", "ich", "ist", "mit", "nicht", "sich",
    "sie", "und", "von", "zu",
    "con", "del", "el", "los", "las", "no", "para", "por", "se", "su", "una", "y",
]


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie in [low, high]; an open side is None; ``base`` rules are those of the contract."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    base: bool = False


#: Ratios are SQL over the counts of ``measures``; lengths are in code points.
RULES = [
    Rule("enough_words", "n_words", low=20, base=True),
    Rule("repeated_windows", "100 * n_repeat_words - 30 * n_words", high=0, base=True),
    Rule("mean_word_length", "word_chars / nullif(n_words, 0)", low=1.5, high=25),
    Rule("symbols_in_words", "n_symbols / nullif(word_chars, 0)", high=0.10),
    Rule("stop_words", "n_stop_words / nullif(n_words, 0)", low=0.01),
    Rule("repeated_lines", "n_dup_lines / nullif(n_lines, 0)", high=0.60),
]


def measures(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with a struct column ``out`` of counts over the whole of ``text``.

    Windows are compared by 64-bit hashes built by doubling (1, 2, 4, 8 words).
    Texts without a repeated window, nearly all, stop at the comparison of two
    sizes; for the others the hashes are sorted with their places, so that the
    work stays n log n in the length of a text.
    """
    c = {n: free_name(df, f"_{n}") for n in ("t", "b", "w", "l", "h1", "h2", "h4", "h", "s", "p")}
    t, w = F.col(c["t"]), F.col(c["w"])
    df = df.withColumn(c["t"], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    # what is used more than once is a column of its own, so that it is computed once
    df = df.withColumn(c["b"], F.btrim(t, F.lit(SPACE)))
    bare = F.col(c["b"])
    df = df.withColumn(c["w"], F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACES + "+")))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    df = df.withColumn(c["l"], lines)
    df = df.withColumn(c["h1"], F.transform(w, lambda x: F.xxhash64(x)))
    df = df.withColumn(c["h2"], _joined(F.col(c["h1"]), 1)).withColumn(c["h4"], _joined(F.col(c["h2"]), 2))
    whole = F.slice(_joined(F.col(c["h4"]), 4), F.lit(1), F.greatest(F.size(w) - (WINDOW - 1), F.lit(1)))
    df = df.withColumn(c["h"], F.when(F.size(w) < WINDOW, F.array().cast("array<bigint>")).otherwise(whole))
    h = F.col(c["h"])
    repeats = F.size(F.array_distinct(h)) < F.size(h)
    placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.withColumn(c["s"], F.when(repeats, placed))
    s = F.col(c["s"])
    # neighbours with the same hash: both places are repeated
    pairs = F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))
    df = df.withColumn(c["p"], places)
    p = F.col(c["p"])
    gaps = F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(0), lambda n, x: n + x)
    counts = F.struct(
        F.size(w).cast("long").alias("n_words"),
        (F.char_length(t) - F.regexp_count(t, F.lit(SPACES))).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(c["l"]) - F.size(F.array_distinct(c["l"]))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(c["l"]).cast("long").alias("n_lines"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    )
    return df.withColumn(out, counts).drop(*c.values())


def _joined(hashes: Column, step: int) -> Column:
    """Hashes of windows twice as long; the last ``step`` places have no meaning."""
    return F.zip_with(hashes, F.slice(hashes, step + 1, F.greatest(F.size(hashes), F.lit(1))), lambda a, b: F.xxhash64(a, b))


def broken(rule: Rule, counts: str) -> Column:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")
    text = rule.measure
    for n in sorted(names, key=len, reverse=True):
        text = text.replace(n, f"`{counts}`.{n}")
    value = F.expr(text)
    out = [value < rule.low] if rule.low is not None else []
    out += [value > rule.high] if rule.high is not None else []
    return F.coalesce(any_of(out), F.lit(False))


def judged(df: DataFrame, text: str = "text", rules: list[Rule] | None = None, out: str = "quality") -> DataFrame:
    """``df`` with a struct ``out``: the counts, ``failed`` (names of broken rules), ``base_failed`` and ``kept``."""
    rules = RULES if rules is None else rules
    m = free_name(df, "_m")
    df = measures(df, text, m)
    flags = {r: broken(r, m) for r in rules}
    failed = F.filter(F.array(*[F.when(f, F.lit(r.name)) for r, f in flags.items()]), lambda x: x.isNotNull())
    verdict = F.struct(
        F.col(f"`{m}`.*"),
        failed.alias("failed"),
        any_of([f for r, f in flags.items() if r.base]).alias("base_failed"),
        (~any_of(list(flags.values()))).alias("kept"),
    )
    return df.withColumn(out, verdict).drop(m)


def kept_documents(df: DataFrame, text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """The rows that break no rule, with the columns they came with.

    The row number keeps the optimizer from moving the filter below the
    projection, where it would compute every measure again for every rule.
    """
    v, row = free_name(df, "_v"), free_name(df, "_row")
    rows = judged(df, text, rules, v).withColumn(row, F.monotonically_increasing_id())
    return rows.where(F.col(f"`{v}`.kept") & (F.col(f"`{row}`") >= 0)).drop(v, row)
