"""Repeated passages, found level by level with windows of doubling length.

A window of 35 words can repeat only if its parts do. The levels are 9, 18 and
35 words: windows repeated at one length alone are extended to twice that
length (less what goes beyond 35), and the levels end when no candidates are
left or the full length is reached.

* 9 words. Every 35-word window holds 27 windows of 9 words; the one with the
  smallest hash stands for it. These seeds are about one in fourteen places.
  Seeds found at a single place are dropped with all the windows they stand for.
* 18 words. A seed is extended to 18 words to the left and to the right. A
  window at offset o before its seed holds the right extension if o <= 17 and
  the left one if o >= 9; extensions found at one place alone rule those out.
* 35 words. What is around a seed, all windows it stands for together, is its
  context. A context found at two places settles all of its windows at once.
  Of seeds with several contexts, one place of each context gives its windows,
  and windows found in two contexts are repeated.

So a passage shared by thousands of documents gives thousands of narrow rows at
the first levels and none of its windows one by one. All hashes are compared
within one seed, so equality rests on 128 bits. Counts per hash are two minima,
combined before the shuffle; joins back to the places are between stored tables,
so that adaptive execution splits the hot ones. Texts are moved compressed.

Equal texts are told by the MD5 of the text. A text found twice has every
window of its own repeated. Null text counts as empty. Texts of fewer than 35
words keep all words. Every row is reported, repeated rows each; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, free_name, stored
from .vocab import Memo

WINDOW = 35
LOW = np.uint64(0xFFFFFFFF)


def seed_length(window: int) -> int:
    return -(-window // 4)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two hashes, in order."""
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x7F4A7C15F39CC060))
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words: lengths double, the last step overlaps."""
    k = 1
    while 2 * k <= size:
        h = mixed(h[:-k], h[k:]) if len(h) > k else h[:0]
        k *= 2
    if k < size:
        h = mixed(h[: k - size], h[size - k :]) if len(h) > size - k else h[:0]
    return h


def word_hashes() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest, 500_000)


def hashed(words: list[bytes], memo: Memo) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def ranges(h: np.ndarray, window: int, seed: int):
    """(place, first and last window start) of every seed, and the hashes of the 9-word windows."""
    small = windows(h, seed)
    each = window - seed + 1  # seeds in a window
    first, k = np.arange(len(small)), 1  # place of the leftmost least hash of k windows

    def least(step: int) -> np.ndarray:
        left, right = first[:-step], first[step:]
        return np.where(small[left] <= small[right], left, right)

    while 2 * k <= each:
        first, k = least(k), 2 * k
    if k < each:
        first = least(each - k)
    lo = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
    return first[lo], lo, np.r_[lo[1:], len(first)] - 1, small


def context_hashes(h: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """One hash for the words from the first window's first to the last window's last, and where the seed is in them."""
    power = np.uint64(0x9FB21C651E98DF25)
    out = np.zeros(len(at), np.uint64)
    two = [h]
    while 2 ** len(two) <= 2 * window:
        k = 2 ** (len(two) - 1)
        two.append(mixed(two[-1][:-k], two[-1][k:]) if len(two[-1]) > k else two[-1][:0])
    size = hi - lo + window
    level = np.floor(np.log2(size)).astype(int)
    for k in np.unique(level):
        own = level == k
        a, n = lo[own], size[own]
        out[own] = mixed(two[k][a], two[k][a + n - 2**k])
    return mixed(out ^ (size.astype(np.uint64) * power), (at - lo).astype(np.uint64))


def packed_place(at, lo, hi):
    """A seed's place and the windows it stands for in one number; offsets are below 4096."""
    return at << 24 | (at - lo) << 12 | (at - hi)


def unpacked(p: np.ndarray):
    at = p >> 24
    return at, at - (p >> 12 & 4095), at - (p & 4095)


def seeds(texts: DataFrame, window: int) -> DataFrame:
    """a: seed hash, c: context hash, e: 32 bits each of the left and right extension, k: text, p: place and windows."""
    seed = seed_length(window)

    def make():
        memo = word_hashes()

        def work(keys, texts):
            out = {n: [] for n in "aceip"}
            for row, text in enumerate(texts.to_pylist()):
                words = text.encode().split()
                if len(words) < window:
                    continue
                h = hashed(words, memo)
                at, lo, hi, small = ranges(h, window, seed)
                double = windows(h, 2 * seed)
                padded = np.zeros(len(h) + 2 * seed, np.uint64)
                padded[seed : seed + len(double)] = double  # place i holds the window that starts at i - seed
                out["a"].append(small[at])
                out["c"].append(context_hashes(h, lo, hi, at, window))
                out["e"].append(padded[at] << np.uint64(32) | padded[at + seed] & LOW)
                out["i"].append(np.full(len(at), row))
                out["p"].append(packed_place(at, lo, hi))
            if out["a"]:
                v = {n: np.concatenate(x) for n, x in out.items()}
                yield v["a"].view(np.int64), v["c"].view(np.int64), v["e"].view(np.int64), keys.take(v["i"]), v["p"]

        return work

    return arrow_map(texts.select("k", "text"), make, "a long, c long, e long, k binary, p long")


def _found_twice(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys found at two places or more; equal texts count as one place."""
    at = F.xxhash64("k", "p")
    return rows.groupBy(*keys).agg(F.min(at).alias("lo"), F.max(at).alias("hi")).where("lo < hi").select(*keys)


def candidates(rows: DataFrame, window: int) -> DataFrame:
    """Seeds that survive 9 and 18 words; ``from`` and ``to`` bound the offsets still possible."""
    seed = seed_length(window)
    rows = rows.join(stored(_found_twice(rows, "a")), "a")
    rows = stored(rows.select("a", "c", "k", "p", F.shiftright("e", 32).alias("l"), F.col("e").bitwiseAND(0xFFFFFFFF).alias("r")))
    left = stored(_found_twice(rows, "a", "l").withColumn("in_l", F.lit(True)))
    right = stored(_found_twice(rows, "a", "r").withColumn("in_r", F.lit(True)))
    rows = rows.join(left, ["a", "l"], "left").join(right, ["a", "r"], "left")
    rows = rows.withColumn("from", F.when(F.col("in_r"), 0).otherwise(window - 2 * seed + 1))
    rows = rows.withColumn("to", F.when(F.col("in_l"), window - seed).otherwise(seed - 1))
    # offsets of the windows it stands for: p holds the largest and the smallest
    largest, smallest = F.shiftright("p", 12).bitwiseAND(4095), F.col("p").bitwiseAND(4095)
    rows = rows.where((F.greatest("from", smallest) <= F.least("to", largest)))
    return stored(rows.select("a", "c", "k", "p", F.col("from").cast("int"), F.col("to").cast("int")))


def covered(docs: DataFrame, window: int) -> DataFrame:
    """(k, spans): starts and ends, in words, of what repeated windows cover in each text; ``docs`` has k and text."""
    rows = candidates(stored(seeds(docs, window)), window)
    at = F.xxhash64("k", "p")
    contexts = rows.groupBy("a", "c").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    contexts = stored(contexts)
    several = stored(contexts.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a", F.lit(True).alias("several")))
    contexts = stored(contexts.join(several, "a", "left").select(
        "a", "c", "first", (F.col("first") < F.col("last")).alias("settled"), F.coalesce("several", F.lit(False)).alias("several")
    ).where("settled OR several"))
    rows = rows.join(contexts, ["a", "c"])
    open_ = F.col("several") & (at == F.col("first"))
    rows = stored(rows.where(F.col("settled") | open_).select("k", "a", "p", "from", "to", "settled", open_.alias("open")))
    whole = rows.where("settled").groupBy("k").agg(F.collect_set("p").alias("places"))
    pending = rows.where("open").select("k", F.struct("a", "p", "settled", "from", "to").alias("s"))
    pending = stored(pending.groupBy("k").agg(F.collect_set("s").alias("s")))

    # the windows of one place of each context; texts are needed for these alone
    texts = squeezed(docs.select("k", "text")).join(
        pending.select(F.col("k").alias("q"), F.transform("s", lambda x: x["a"]).alias("a"), F.transform("s", lambda x: x["p"]).alias("p"),
                       F.transform("s", lambda x: x["settled"].cast("long")).alias("settled"),
                       F.transform("s", lambda x: x["from"].cast("long")).alias("from"), F.transform("s", lambda x: x["to"].cast("long")).alias("to")),
        F.col("k") == F.col("q"),
    )

    def make():
        memo, seen = word_hashes(), set()

        def work(keys, data, a, p, settled, low, high):
            out = {n: [] for n in "ahisw"}
            for row, (key, blob) in enumerate(zip(keys.to_pylist(), data.to_pylist(), strict=True)):
                if key in seen:  # an equal text in this task
                    continue
                seen.add(key)
                h = windows(hashed(inflate(blob).split(), memo), window)
                at, lo, hi = unpacked(np.array(p[row].as_py(), np.int64))
                lo = np.maximum(lo, at - np.array(high[row].as_py()))
                hi = np.minimum(hi, at - np.array(low[row].as_py()))
                size = np.maximum(hi - lo + 1, 0)
                start = np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                out["a"].append(np.repeat(np.array(a[row].as_py(), np.int64), size))
                out["h"].append(h[start].view(np.int64))
                out["i"].append(np.full(len(start), row))
                out["s"].append(start)
                out["w"].append(np.repeat(np.array(settled[row].as_py(), np.int64), size))
            if out["a"]:
                v = {n: np.concatenate(x) for n, x in out.items()}
                yield v["a"], v["h"], keys.take(v["i"]), v["s"], v["w"]

        return work

    single = stored(arrow_map(texts.select("k", "blob", "a", "p", "settled", "from", "to"), make,
                              "a long, h long, k binary, s long, settled long"))
    place = F.xxhash64("k", "s")
    twice = single.groupBy("a", "h").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.max("settled").alias("w"))
    twice = stored(twice.where("lo < hi OR w = 1").select("a", "h"))
    found = single.where("settled = 0").join(twice, ["a", "h"]).groupBy("k").agg(F.collect_set("s").alias("starts"))
    every = whole.select("k", "places", F.lit(None).cast("array<long>").alias("starts")).unionByName(
        found.select("k", F.lit(None).cast("array<long>").alias("places"), "starts"))
    copies = docs.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k", F.lit(True).alias("copied"))
    every = every.groupBy("k").agg(F.flatten(F.collect_list("places")).alias("places"), F.flatten(F.collect_list("starts")).alias("starts"))
    every = stored(every).join(stored(copies), "k", "full")
    return stored(every.select("k", "places", "starts", F.coalesce("copied", F.lit(False)).alias("copied")))


def squeezed(texts: DataFrame) -> DataFrame:
    """``texts`` (k, text and perhaps more columns of known types) with the text compressed to ``blob``, for moving."""
    names = {"doc_id": "long", "k": "binary"}
    rest = [c for c in texts.columns if c != "text"]

    def make():
        pack = zstandard.ZstdCompressor(level=1)

        def work(text, *columns):
            yield [pack.compress(t.encode()) for t in text.to_pylist()], *columns

        return work

    return arrow_map(texts.select("text", *rest), make, ", ".join(["blob binary", *(f"{c} {names[c]}" for c in rest)]))


def inflate(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def removed(n: int, places, starts, copied: bool, window: int) -> np.ndarray:
    """True for each of ``n`` words that a repeated window covers."""
    edge = np.zeros(n + 1, np.int64)
    if copied and n >= window:
        return np.ones(n, bool)
    if places is not None and len(places):
        _, lo, hi = unpacked(np.asarray(places, np.int64))
        np.add.at(edge, lo, 1)
        np.add.at(edge, hi + window, -1)
    if starts is not None and len(starts):
        starts = np.asarray(starts, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + window, -1)
    return np.cumsum(edge[:n]) > 0


def keyed(docs: DataFrame, text_col: str, k: str = "k") -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.withColumn(k, F.unhex(F.md5(text)))


def without_repeats(docs: DataFrame, window: int = WINDOW, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by one space) and kept_sha256 of every row."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text)).alias("k"))
    spans = covered(src, window)
    rows = squeezed(src).join(spans.withColumnRenamed("k", "q"), F.col("k") == F.col("q"), "left")

    def make():
        def work(ids, data, places, starts, copied):
            n, gone, kept, digest = [], [], [], []
            columns = (data.to_pylist(), places.to_pylist(), starts.to_pylist(), copied.to_pylist())
            for blob, p, s, c in zip(*columns, strict=True):
                words = inflate(blob).split()
                out = removed(len(words), p, s, bool(c), window) if p or s or c else np.zeros(len(words), bool)
                if out.any():
                    words = [w for w, x in zip(words, out.tolist(), strict=True) if not x]
                text = b" ".join(words)
                n.append(len(out))
                gone.append(int(out.sum()))
                kept.append(text.decode())
                digest.append(hashlib.sha256(text).hexdigest())
            yield ids, n, gone, kept, digest

        return work

    schema = "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string"
    return arrow_map(rows.select("doc_id", "blob", "places", "starts", "copied"), make, schema)


def stripped(docs: DataFrame, window: int = WINDOW, text_col="text", chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with repeated passages taken out of the text; texts without any stay as they are, white space included.

    A column named as ``chars_col``, if there is one, gets the new length. The
    columns are those of ``docs``, in order.
    """
    own = {n: free_name(docs, n) for n in ("_k", "_q", "_places", "_starts", "_copied")}
    src = keyed(docs, text_col, own["_k"])
    spans = covered(keyed(docs.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")), "text"), window)
    spans = spans.select(*[F.col(c).alias(own[n]) for c, n in
                           (("k", "_q"), ("places", "_places"), ("starts", "_starts"), ("copied", "_copied"))])
    rows = src.join(spans, F.col(own["_k"]) == F.col(own["_q"]), "left")

    def strip(texts, places, starts, copied):
        out = []
        for text, p, s, c in zip(texts, places, starts, copied, strict=True):
            p, s = (x if x is not None else () for x in (p, s))
            if text is None or not (len(p) or len(s) or c):
                out.append(text)
                continue
            words = text.encode().split()
            gone = removed(len(words), p, s, bool(c), window)
            kept = b" ".join(w for w, x in zip(words, gone.tolist(), strict=True) if not x)
            out.append(kept.decode() if gone.any() else text)
        return pd.Series(out, dtype=object)

    new = F.pandas_udf(strip, "string")(*[F.col(f"`{c}`") for c in (text_col, own["_places"], own["_starts"], own["_copied"])])
    rows = rows.withColumn(text_col, new)
    if chars_col in docs.columns:
        was = docs.schema[chars_col].dataType
        rows = rows.withColumn(chars_col, F.char_length(f"`{text_col}`").cast(was))
    return rows.select(*[f"`{c}`" for c in docs.columns])
