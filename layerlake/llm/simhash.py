"""SimHash near-duplicates with the generalised pigeonhole principle.

Two fingerprints that differ in at most r of their bits, cut into m parts, are
within t[i] bits of each other in at least one part i whenever the thresholds
t[1..m], -1 allowed, add up to r - m + 1. Bits that are correlated over the
corpus go to the same part, so that parts are nearly independent. Every
fingerprint chooses its own thresholds, by dynamic programming over the parts,
so that the keys it probes plus the candidates expected there are fewest; then
it probes all keys within t[i] of its own value in part i. Candidates are
verified in the join that finds them, and links are closed to components.

Nothing is capped. Equal fingerprints are one node, so copies make no pairs.
Bit counts over all fingerprints (64 x 64 numbers) are the only thing collected.

Null and empty texts, and texts of white space alone, have fingerprint zero,
which is linked like any other. A null doc_id is ignored when the smallest id of
a component is taken; a component of null ids alone has a null id. Repeated
rows are reported each. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, free_name, id_text, stored
from .graph import components

SHINGLE = 4
MOST = 4
SEED = 42
BITS = 64
BATCH = 100_000


def of_hashes(hashes: np.ndarray) -> int:
    """64-bit SimHash: a bit is set if it is set in over half the hashes."""
    set_ = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BATCH):  # bounded memory for very long texts
        part = np.unpackbits(hashes[at : at + BATCH].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_ += part.sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_ > len(hashes), bitorder="little").view("<u8")[0])


def remixed(hashes: np.ndarray, i: int) -> np.ndarray:
    """For the ``i``-th fingerprint of the same hashes: other ones, with bits independent of theirs; for 0 the same."""
    if not i:
        return hashes
    x = hashes + np.uint64(i * 0x9E3779B97F4A7C15 % 2**64)  # the finaliser of splitmix64
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text: a bit is set if it is set in over half the hashes."""
    words = text.encode().lower().split()  # bytes: A-Z alone are lower-cased, ASCII white space alone separates
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(joined, SEED)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start = (end - length)[: 1 - size].tolist() if size > 1 else (end - length).tolist()
    stop = end[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(start, stop, strict=True)), np.uint64, len(stop))
    return of_hashes(hashes)


def fingerprints(docs: DataFrame, size: int = SHINGLE, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id and ``fp``, the fingerprint's bits as a signed long."""

    def make():
        def work(ids, texts):
            fps = np.array([fingerprint(t, size) for t in texts.to_pylist()], np.uint64)
            yield ids, fps.view(np.int64)

        return work

    return arrow_map(id_text(docs, id_col, text_col), make, "doc_id long, fp long")


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each two bits, in how many both are set."""

    def make():
        def work(fps):
            bits = np.unpackbits(fps.to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both = (bits.T @ bits).astype(np.int64).ravel()
            yield [*range(BITS * BITS), -1], [*both.tolist(), len(bits)]

        return work

    counts = arrow_map(nodes.select("fp"), make, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    got = dict(map(tuple, counts.collect()))  # 4,097 numbers
    return got.get(-1, 0), np.array([got.get(i, 0) for i in range(BITS * BITS)], np.float64).reshape(BITS, BITS)


def grouped_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in parts of nearly equal size, each grown by the bit most correlated with those in it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tie = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(tie, 0)
    left, out = list(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(len, out))) // (parts - k)
        first = left[int(tie[np.ix_(left, left)].max(1).argmax())]
        own = [first]
        left.remove(first)
        while len(own) < size:
            best = left[int(tie[np.ix_(left, own)].sum(1).argmax())]
            own.append(best)
            left.remove(best)
        out.append(sorted(own))
    return out


def part_count(n: int, most: int) -> int:
    """Parts for which probes and expected candidates of a fingerprint with random bits are fewest."""

    def cost(m: int) -> float:
        total, width = most - m + 1, BITS // m
        t = [total // m + (i < total % m) for i in range(m)]
        keys = [sum(math.comb(width, d) for d in range(x + 1)) for x in t]
        return sum(k * (1 + n / 2**width) for k in keys)

    return min(range(2, most + 2), key=cost)


def masks(bits: list[int], most: int) -> list[np.ndarray]:
    """For each distance the numbers with that many of the part's bits set."""
    from itertools import combinations

    return [np.array([sum(1 << b for b in c) for c in combinations(bits, d)], np.uint64) for d in range(most + 1)]


def allocate(fps: np.ndarray, n: int, p: np.ndarray, parts: list[list[int]], most: int) -> np.ndarray:
    """Thresholds of each fingerprint for each part, by dynamic programming over the parts.

    The cost of a threshold is the number of probed keys plus the fingerprints
    expected there: n times the chance that bits with the corpus' frequencies
    differ from this fingerprint's in no more places of the part.
    """
    m, top = len(parts), most
    size = len(fps)
    set_ = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    # a threshold sum runs from -m (all parts unused) to most - m + 1
    states = most + 2
    best = np.full((states, size), np.inf)
    best[0] = 0
    choice = []
    for bits in parts:
        chance = np.zeros((top + 1, size))
        chance[0] = 1
        for b in bits:
            miss = np.where(set_[:, b] == 1, 1 - p[b], p[b])
            chance[1:] = chance[1:] * (1 - miss) + chance[:-1] * miss
            chance[0] *= 1 - miss
        within = np.cumsum(chance, axis=0)
        keys = np.cumsum([math.comb(len(bits), d) for d in range(top + 1)])
        new, pick = np.full((states, size), np.inf), np.zeros((states, size), np.int8)
        for s in range(states):
            for t in range(-1, top + 1):  # t + 1 is added to the state
                if s - t - 1 < 0:
                    break
                value = best[s - t - 1] + (keys[t] + n * within[t] if t >= 0 else 0)
                better = value < new[s]
                new[s][better] = value[better]
                pick[s][better] = t
        best = new
        choice.append(pick)
    at = np.full(size, states - 1)  # sum of (t + 1) is most + 1, so the sum of t is most - m + 1
    out = np.empty((m, size), np.int8)
    for i in range(m - 1, -1, -1):
        out[i] = choice[i][at, np.arange(size)]
        at = at - out[i] - 1
    return out


def links(nodes: DataFrame, most: int = MOST) -> DataFrame:
    """(a, b): every two fingerprints of ``nodes`` (distinct ``fp``) that differ in at most ``most`` bits, a < b."""
    n, both = bit_counts(nodes)
    parts = grouped_bits(n, both, part_count(n, most))
    p = np.clip(np.diag(both) / max(n, 1), 0.001, 0.999)
    whole = [sum(1 << b for b in bits) for bits in parts]
    flips = [masks(bits, most) for bits in parts]

    def make():
        def work(fps):
            fps = fps.to_numpy().view(np.uint64)
            for lo in range(0, len(fps), 2000):
                own = fps[lo : lo + 2000]
                t = allocate(own, n, p, parts, most)
                for i, mask in enumerate(whole):
                    for d in range(most + 1):
                        some = own[t[i] >= d]
                        if len(some):
                            keys = ((some & np.uint64(mask))[:, None] ^ flips[i][d][None, :]).ravel()
                            k = len(flips[i][d])
                            yield np.full(len(keys), i, np.int32), keys.view(np.int64), np.repeat(some, k).view(np.int64)

        return work

    probes = arrow_map(nodes.select("fp"), make, "part int, value long, a long")
    signed = np.array(whole, np.uint64).view(np.int64).tolist()
    index = nodes.select(
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for i, m in enumerate(signed)
        ])).alias("k"), F.col("fp").alias("b"),
    ).select("k.part", "k.value", "b")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most)
    found = probes.alias("p").join(
        index.alias("i"), (F.col("p.part") == F.col("i.part")) & (F.col("p.value") == F.col("i.value")) & near
    )
    # a pair is found from either side; each side's probes alone find it
    return found.select("a", "b").distinct()


def classes(docs: DataFrame, most: int, size: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, component_id) of every fingerprint."""
    fps = stored(fingerprints(docs, size, id_col, text_col))
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes.select("fp"), most), "a", "b")
    of = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    of = stored(of)
    least = stored(of.groupBy("root").agg(F.min("least").alias("component_id")))
    return fps, stored(of.join(least, "root").select("fp", "component_id"))


def near_duplicates(docs: DataFrame, most: int = MOST, size: int = SHINGLE, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id reachable) of every row."""
    fps, of = classes(docs, most, size, id_col, text_col)
    return fps.join(of, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, most: int = MOST, size: int = SHINGLE, id_col="doc_id", text_col="text") -> DataFrame:
    """The rows of ``docs`` less near-duplicates: the row with the smallest id of each component stays.

    If several rows of a component share that id, the one whose text sorts first
    stays. A component without any id keeps one row of each fingerprint. Columns are those of ``docs``.
    """
    fps, of = classes(docs, most, size, id_col, text_col)
    first = fps.join(of, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = stored(first.groupBy("fp", "doc_id", "component_id").agg(F.count("*").alias("n")))
    own = {n: free_name(docs, n) for n in ("_fp", "_sfp", "_sid", "_component", "_rank")}
    rows = docs.withColumn(own["_fp"], _fingerprint_column(text_col, size))
    found = stay.select(*[F.col(c).alias(own[n]) for c, n in (("fp", "_sfp"), ("doc_id", "_sid"), ("component_id", "_component"))])
    same_id = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(own["_sid"]))
    rows = rows.join(found, (F.col(own["_fp"]) == F.col(own["_sfp"])) & same_id)
    # components without any id keep one row for each of their fingerprints
    shared = stay.groupBy("component_id").agg(F.sum("n").alias("n")).where("n > 1")
    if not shared.isEmpty():
        by = Window.partitionBy(own["_component"], F.when(F.col(own["_component"]).isNull(), F.col(own["_fp"])))
        rows = rows.withColumn(own["_rank"], F.row_number().over(by.orderBy(F.col(f"`{text_col}`").asc_nulls_first())))
        rows = rows.where(F.col(own["_rank"]) == 1)
    return rows.select(*[f"`{c}`" for c in docs.columns])


def _fingerprint_column(text_col: str, size: int):
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64))

    return F.pandas_udf(hashed, "long")(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
