"""Groups of documents whose sets of word shingles have a Jaccard similarity of at least ``LEAST``.

A set is a node, so copies make no pairs. Every set has ``PRINTS`` SimHash
fingerprints. Those within ``MOST`` bits of each other are found as ``simhash``
finds them, by parts of correlated bits with thresholds of their own; each link
rests on the exact similarity of the two sets, computed from their texts.
Shingles are compared by 64-bit hashes.

At similarity 0.8 two sets differ in ten of 64 bits on average, beyond the reach
of any search by parts, so a complete search follows among sets that are still
apart. ``BANDS`` bands of ``ROWS`` minima of random orders of the shingles show
where: sets of similarity s share a band with probability
1 - (1 - s^ROWS)^BANDS, 0.99993 at 0.8 and more above it. Each set is compared
with the smallest one of each of its bands. Sets of bands that still hold
several components afterwards are compared across components, but only those
pairs that have one of their rarest common shingles in common: any two sets that
are alike do, sets that merely share bands seldom (``across``). So no band is
paired with itself. Nothing is capped.

Null and empty texts, and texts of white space alone, have the empty set and are
one group. A text of fewer words than a shingle has is one shingle. An empty
table gives no rows.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import operator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import arrow_map, free_name, stored
from .graph import components

SHINGLE = 5
LEAST = (4, 5)  # 0.8, as a fraction, so that the comparison is exact
PRINTS = 4
MOST = 4
BANDS = 24
ROWS = 5
SEED = 42
CHUNK = 1024
BATCH = 500
PARITY = 2048


def released() -> None:
    """Give memory that is free back to the system; workers are kept and go on to the next stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc alone has it
        ctypes.CDLL(None).malloc_trim(0)


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct word shingles of a text, sorted."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(joined, SEED)], np.uint64)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start, stop = (end - length)[: len(words) - size + 1].tolist(), end[size - 1 :].tolist()
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(start, stop, strict=True)), np.uint64, len(stop)))


def alike(a: np.ndarray, b: np.ndarray, least: tuple[int, int] = LEAST) -> bool:
    """Whether two sets have at least this Jaccard similarity."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common * least[1] >= (len(a) + len(b) - common) * least[0]


@functools.cache
def orders(n: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 2**32, n, np.uint32) | np.uint32(1)


def band_keys(hashes: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One key for each band; none of the empty set."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    by, short = orders(bands * rows)[:, None], (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(bands * rows, 2**32 - 1, np.uint32)
    for at in range(0, len(short), CHUNK):  # bounded memory for very long texts
        np.minimum(least, (by * short[None, at : at + CHUNK]).min(1), out=least)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(least[i * rows : i * rows + rows].tobytes(), i) for i in range(bands)], np.uint64).view(np.int64)


def parities(hashes: np.ndarray) -> np.ndarray:
    """For each of ``PARITY`` classes of hashes one bit: whether the set has an odd number of them."""
    odd = np.bincount((hashes & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text with null read as empty, and ``t``, its MD5."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text)).alias("t"))


def sets(rows: DataFrame, size: int, bands: int) -> DataFrame:
    """node, n (shingles), prints, keys (of the bands) and the first row's doc_id and t of each distinct set."""

    def make():
        def work(ids, texts, t):
            for at in range(0, len(ids), BATCH):
                rows = []
                for text in texts.slice(at, BATCH):  # one set at a time in memory
                    h = shingles(text.as_py(), size)
                    prints = [simhash.of_hashes(simhash.remixed(h, i)) for i in range(PRINTS)]
                    rows.append((xxhash.xxh3_128_digest(h.tobytes()), len(h), np.array(prints, np.uint64).view(np.int64), band_keys(h, bands)))
                yield ids.slice(at, BATCH), t.slice(at, BATCH), *map(list, zip(*rows, strict=True))
            released()

        return work

    schema = "doc_id long, t binary, k binary, n long, prints array<long>, keys array<long>"
    found = arrow_map(rows.select("doc_id", "text", "t"), make, schema)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "t")).alias("first")
    nodes = found.groupBy("k").agg(first, *[F.first(c).alias(c) for c in ("n", "prints", "keys")])
    return stored(nodes.withColumn("node", F.monotonically_increasing_id()).drop("k"))


def near_sizes(m: Column, n: Column, least: tuple[int, int]) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return F.least(m, n) * least[1] >= F.greatest(m, n) * least[0]


def close_prints(nodes: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of sets, a < b, that have a fingerprint within ``MOST`` bits of the other's.

    Sets with the same fingerprint are compared with the smallest one of them,
    and these with each other.
    """
    found = []
    for i in range(PRINTS):
        own = nodes.where("n > 0").select("node", "n", F.get("prints", F.lit(i)).alias("fp"))
        first = stored(own.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("low")))
        found.append(own.join(first, "fp").select("low", F.struct("node", "n").alias("other")))
        x, y = (first.select(F.col("fp").alias(c), F.col("low").alias(n)) for c, n in (("a", "low"), ("b", "other")))
        found.append(simhash.links(first.select("fp"), MOST).join(x, "a").join(y, "b").select("low", "other"))
    pairs = functools.reduce(DataFrame.unionByName, found)
    pairs = pairs.where((F.col("low.node") != F.col("other.node")) & near_sizes(F.col("low.n"), F.col("other.n"), least))
    return stored(pairs.select(F.least("low.node", "other.node").alias("a"), F.greatest("low.node", "other.node").alias("b")).distinct())


def compressed(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and the compressed text of its first row."""
    want = nodes.select("node", F.col("first.doc_id").alias("i"), F.col("first.t").alias("q"))
    own = rows.join(want, (F.col("t") == F.col("q")) & F.col("doc_id").eqNullSafe(F.col("i"))).select("node", "text")

    def make():
        pack = zstandard.ZstdCompressor(level=1)

        def work(nodes, texts):
            yield nodes, [pack.compress(t.as_buffer()) for t in texts]
            released()

        return work

    return stored(arrow_map(own, make, "node long, blob binary").groupBy("node").agg(F.min("blob").alias("blob")))


def verified(pairs: DataFrame, texts: DataFrame, size: int, least: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("blob").alias("x")), "a")
    both = both.join(texts.select(F.col("node").alias("b"), F.col("blob").alias("y")), "b")

    def make():
        unpack = zstandard.ZstdDecompressor()

        @functools.lru_cache(64)  # a set with many pairs comes with all of them
        def of(blob: bytes) -> np.ndarray:
            return shingles(unpack.decompress(blob).decode(), size)

        def work(a, b, x, y):
            good = pa.array([alike(of(p.as_py()), of(q.as_py()), least) for p, q in zip(x, y, strict=True)], pa.bool_())
            yield a.filter(good), b.filter(good)
            released()

        return work

    return stored(arrow_map(both.select("a", "b", "x", "y"), make, "a long, b long"))


def across(apart: DataFrame, texts: DataFrame, size: int, least: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of sets of different components among which are all that are alike.

    ``apart`` has node, n and root. If the shingles of all sets are put in one
    order, two sets that are alike have one in common among the first few of
    each. The order begins with the shingles that only one component has, which
    match nothing; then come rare ones before common ones. So a set counts only
    if other components have nearly all of its shingles, and then only with the
    rarest of these. Sizes and places in the order bound what two sets can have
    in common. So do their parities: every shingle turns one of ``PARITY`` bits
    over, and two sets differ by at least as many shingles as bits.
    """
    p, q = least

    def make():
        unpack = zstandard.ZstdDecompressor()

        def work(nodes, blobs):
            for at in range(0, len(nodes), BATCH):
                sets = [shingles(unpack.decompress(b.as_py()).decode(), size) for b in blobs.slice(at, BATCH)]
                yield nodes.slice(at, BATCH), [h.view(np.int64) for h in sets], list(map(parities, sets))
            released()

        return work

    rows = texts.join(apart.select("node"), "node", "left_semi").select("node", "blob")
    sets = stored(arrow_map(rows, make, "node long, hashes array<long>, bits array<long>"))
    own = sets.select("node", F.explode("hashes").alias("h")).join(apart, "node")
    seen = own.groupBy("h").agg(F.count("*").alias("df"), F.min("root").alias("low"), F.max("root").alias("high"))
    common = own.join(seen.where("low < high").select("h", "df"), "h")
    ordered = common.groupBy("node", "n", "root").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("s"))  # at most n
    before = F.col("n") - F.size("s")  # those of its own component come first
    first = F.col("n") - F.ceil(F.col("n") * p / q) + 1
    ordered = ordered.withColumns({"before": before, "first": first}).where("first > before")
    head = F.slice("s", F.lit(1), (F.col("first") - F.col("before")).cast("int"))
    heads = ordered.select("node", "n", "root", "before", F.posexplode(head).alias("i", "e"))
    heads = heads.select("node", "n", "root", F.col("e.h").alias("h"), (F.col("before") + F.col("i")).alias("at"))
    heads = stored(heads.join(sets.select("node", "bits"), "node"))
    # of two sets the smaller one needs fewer of its first shingles
    fewer = heads.where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * (2 * p) / (p + q)))
    x, y = (df.select("h", *[F.col(c).alias(f"{c}{k}") for c in ("node", "n", "root", "at", "bits")]) for df, k in ((fewer, 1), (heads, 2)))
    smaller = (F.col("n1") < F.col("n2")) | ((F.col("n1") == F.col("n2")) & (F.col("node1") < F.col("node2")))
    most = F.least(F.col("n1") - F.col("at1"), F.col("n2") - F.col("at2"))  # places count from 0
    turned = [F.bit_count(F.get("bits1", F.lit(i)).bitwiseXOR(F.get("bits2", F.lit(i)))) for i in range(PARITY // 64)]
    both = F.col("n1") + F.col("n2")
    alike = (F.col("n1") * q >= F.col("n2") * p) & (most * (p + q) >= both * p) & (functools.reduce(operator.add, turned) * (p + q) <= both * (q - p))
    same_shingle = x["h"] == y["h"]
    found = x.join(y, same_shingle & (F.col("root1") != F.col("root2")) & smaller & alike)
    return found.select(F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b")).distinct()


def still_open(keys: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """key, node, n, root of every set of a band; key and lowest set (node, n, root) of bands with several components."""
    of = keys.select("key", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    of = stored(of)
    both = of.groupBy("key").agg(F.min(F.struct("node", "n", "root")).alias("low"), F.min("root").alias("a"), F.max("root").alias("b"))
    return of, both.where("a < b").select("key", "low")


def groups(
    docs: DataFrame, size: int = SHINGLE, least: tuple[int, int] = LEAST, id_col="doc_id", text_col="text", bands: int = BANDS,
) -> DataFrame:
    """node, root, and the first row (without: no id, doc_id, t) of each distinct set; equal roots are one group.

    Without ``bands`` only fingerprints find links.
    """
    rows = keyed(docs, id_col, text_col)
    nodes = sets(rows, size, bands)
    tried = close_prints(nodes, least)
    keys = nodes.select("node", "n", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    keys = stored(keys.join(shared.select("key"), "key"))
    own = [keys.select("node"), *[tried.select(F.col(c).alias("node")) for c in ("a", "b")]]
    texts = compressed(rows, nodes.join(functools.reduce(DataFrame.unionByName, own).distinct(), "node", "left_semi"))
    links = verified(tried, texts, size, least)
    roots = stored(components(links, "a", "b"))
    # sets of bands that hold several components; the others are done with
    of, held = still_open(keys, roots)
    pairs = of.join(held.select("key", "low"), "key").where((F.col("low.root") != F.col("root")) & near_sizes(F.col("low.n"), F.col("n"), least))
    pairs = pairs.select(F.col("low.node").alias("a"), F.col("node").alias("b")).distinct()  # the lowest node of the band
    pairs = stored(pairs.join(tried, ["a", "b"], "left_anti"))
    more = verified(pairs, texts, size, least)
    if not more.isEmpty():
        links = links.unionByName(more)
        roots = stored(components(links, "a", "b"))
        of, held = still_open(of, roots)
    apart = stored(of.join(held.select("key"), "key", "left_semi").select("node", "n", "root").distinct())
    apart = stored(across(apart, texts, size, least).join(tried.unionByName(pairs), ["a", "b"], "left_anti"))
    more = verified(apart, texts, size, least)
    if not more.isEmpty():
        roots = stored(components(links.unionByName(more), "a", "b"))
    first = [F.col(f"first.{c}").alias(c) for c in ("without", "doc_id", "t")]
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), *first)


def one_of_each(
    docs: DataFrame, size: int = SHINGLE, least: tuple[int, int] = LEAST, id_col="doc_id", text_col="text", bands: int = BANDS,
) -> DataFrame:
    """The rows of ``docs`` less near copies: of each group the row with the smallest id stays.

    Rows without an id come last. Of rows with the same id, one with the
    smallest MD5 of the text stays. Columns are those of ``docs``.
    """
    of = groups(docs, size, least, id_col, text_col, bands)
    first = of.groupBy("root").agg(F.min(F.struct("without", "doc_id", "t")).alias("f"))
    first = stored(first.select(F.col("f.doc_id").alias("doc_id"), F.col("f.t").alias("t")))
    own = {n: free_name(docs, n) for n in ("_t", "_st", "_sid")}
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    same_id = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(own["_sid"]))
    rows = docs.withColumn(own["_t"], F.unhex(F.md5(text)))
    found = first.select(F.col("doc_id").alias(own["_sid"]), F.col("t").alias(own["_st"]))
    rows = rows.join(found, (F.col(own["_t"]) == F.col(own["_st"])) & same_id)
    again = keyed(docs, id_col, text_col).groupBy("doc_id", "t").agg(F.count("*").alias("n")).where("n > 1")
    again = again.join(first.withColumnRenamed("doc_id", "i").withColumnRenamed("t", "q"),
                       (F.col("t") == F.col("q")) & F.col("doc_id").eqNullSafe(F.col("i")))
    if not again.isEmpty():  # rows with the same id and text
        rows = rows.dropDuplicates([own["_st"], own["_sid"]])
    return rows.select(*[f"`{c}`" for c in docs.columns])
