"""Best-two-fit packing of token sequences.

A bin is filled greedily, largest piece first; then its smallest piece is
replaced by two unpacked pieces that fit the gap it leaves more tightly.

Pieces matter only by length, and a length is at most the capacity. So bins are
planned over the number of pieces of each length: a bin's recipe is applied as
often as the numbers allow. The plan has a few rows per length however many
documents there are, and is made from at most ``capacity`` counts. Pieces then
find their places from their number among those of their length, in parallel.

Null text counts as empty: one piece that holds only the end token. Rows are
packed as they are; repeated rows, also of one doc_id, are packed each. Equal
lengths are taken in stored order, so sequence numbers may differ between runs
while lengths, cuts and the number of sequences do not. An empty table packs
into nothing.
"""

from __future__ import annotations

import functools
import json
import re
import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, id_text, stored
from .vocab import Memo, byte_letters, unreached

FILE = "word_bpe_49k.json"
CAPACITY = 4096
END = 1
MEMORY = 14_000_000  # characters and overhead of remembered words
WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@[-`{-~]*)").fullmatch


class WordEncoder:
    """Ids of a text, as the tokenizers library gives them, from a memory of words.

    The file's pattern drops white space, so the ids of a text are those of its
    words between ASCII white space. A word of Latin letters followed by ASCII
    marks is lower-cased, and letters and marks are merged apart, which is what
    the file's normaliser and pattern do with it. The merging is done with
    tiktoken, which is faster: the end-of-word mark becomes a byte that UTF-8
    does not use. Merging by rank is the same as merging by pair for every
    token that the merges reach from its own characters; tokens they do not
    reach cannot occur and are left out. All other words go to the library.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.known = (
            model["type"] == "BPE" and model["end_of_word_suffix"] == "</w>" and not model["ignore_merges"]
            and [n["type"] for n in spec["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
        )
        byte = {c: b for b, c in byte_letters().items()}

        def raw(token: str) -> bytes:
            bare = token.removesuffix("</w>")
            return bytes(byte[c] for c in bare) + b"\xff" * (bare != token)

        merge = {bytes([b]): b for b in range(256)} | {bytes([b, 255]): 256 + b for b in range(256)}
        real, lost = {}, unreached(model)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        for k, m in enumerate(pairs):
            if "".join(m) not in lost:
                merge.setdefault(raw("".join(m)), 512 + k)
        for token, i in model["vocab"].items():
            if not token.startswith("<|") and token not in lost:
                real[merge[raw(token)]] = i
        self.core = tiktoken.Encoding("merges", pat_str=".", mergeable_ranks=merge, special_tokens={})._core_bpe
        self.real = real
        self.run = Memo(self._run, MEMORY // 2)
        self.word = Memo(self._word, MEMORY)

    def _run(self, letters: str) -> bytes:
        tokens = self.core.encode_single_piece(letters.encode() + b"\xff")
        return np.array([self.real[t] for t in tokens], "<u4").tobytes()

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        m = WORD(text) if self.known else None
        if m:
            marks = m[2]
            return self.run[m[1].lower()] + (self.run[marks] if marks else b"")
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self.word.__getitem__, text.encode().split()))


@functools.cache
def encoder(path: str) -> WordEncoder:
    """One per worker process."""
    return WordEncoder(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32; ``part`` and ``number`` count within task and length."""

    def make():
        enc, tail, seen = encoder(path), np.array([end], "<u4").tobytes(), {}
        part = TaskContext.get().partitionId()

        def work(ids, texts):
            rows = []
            for doc, text in zip(ids.to_pylist(), texts.to_pylist(), strict=True):
                data = enc.encode(text) + tail
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    cut = data[at : at + 4 * capacity]
                    n = len(cut) // 4
                    number = seen[n] = seen.get(n, -1) + 1
                    rows.append((doc, k, at // 4, n, zlib.crc32(cut), part, number))
            yield list(map(list, zip(*rows, strict=True)))

        return work

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, number long"
    return arrow_map(id_text(docs, id_col, text_col), make, schema)


def recipes(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """The plan: (how many bins, {length: pieces of it in each such bin}), until every piece has a bin."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan = []
    while left.any():
        bin_, gap = {}, capacity
        free = left.copy()
        for length in np.flatnonzero(left)[::-1].tolist():
            if length <= gap and (k := min(gap // length, int(free[length]))):
                bin_[length] = k
                free[length] -= k
                gap -= k * length
        if gap and len(bin_) + sum(bin_.values()) > 2:
            small = min(bin_)
            pair = _tightest_pair(free, gap + small, small)
            if pair:
                bin_[small] -= 1
                for x in pair:
                    bin_[x] = bin_.get(x, 0) + 1
                bin_ = {x: k for x, k in bin_.items() if k}
        times = min(int(left[x]) // k for x, k in bin_.items())
        for x, k in bin_.items():
            left[x] -= times * k
        plan.append((times, bin_))
    return plan


def _tightest_pair(free: np.ndarray, room: int, than: int) -> tuple[int, int] | None:
    """Two unpacked lengths whose sum is the largest that is over ``than`` and at most ``room``."""
    lengths = np.flatnonzero(free)
    first = lengths[lengths < room]
    at = np.searchsorted(lengths, room - first, side="right") - 1
    ok = at >= 0
    first, second = first[ok], lengths[at[ok]]
    same = (first == second) & (free[first] < 2)  # one piece cannot be taken twice: the next shorter one
    lower = at[ok] - 1
    second = np.where(same, np.where(lower >= 0, lengths[np.maximum(lower, 0)], 0), second)
    total = np.where(second > 0, first + second, 0)
    if not len(total) or total.max() <= than:
        return None
    k = int(total.argmax())
    return int(first[k]), int(second[k])


def places(plan: list[tuple[int, dict[int, int]]], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """The plan as arrays, sorted by length and first piece number: where runs of equal pieces go."""
    rows, taken, first_bin = [], {}, 0
    for times, bin_ in plan:
        at = 0
        for length, k in sorted(bin_.items(), reverse=True):
            rows.append((length, taken.get(length, 0), first_bin, k, at))
            taken[length] = taken.get(length, 0) + times * k
            at += k * length
        first_bin += times
    rows.sort()
    names = ("length", "number", "bin", "each", "offset")
    return {n: np.array([r[i] for r in rows], np.int64) for i, n in enumerate(names)}


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut = stored(pieces(docs, path, capacity, end, id_col, text_col))
    by_part = cut.groupBy("length", "part").agg(F.max("number").alias("n"))
    by_part = by_part.withColumn("n", F.col("n") + 1)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = stored(by_part.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    # one row per length: at most ``capacity`` rows
    counts = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(recipes(counts, capacity), capacity)
    ranked = cut.join(by_part.select("length", "part", "before"), ["length", "part"])
    ranked = ranked.withColumn("number", F.col("number") + F.col("before"))

    def make():
        # runs start at sorted (length, number); the last one not after a piece is its own
        lengths = np.searchsorted(table["length"], np.arange(capacity + 2))

        def work(doc, piece, start, length, crc, number):
            size, k = length.to_numpy(), number.to_numpy()
            run = np.empty(len(size), np.int64)
            for x in np.unique(size):
                lo, hi = lengths[x], lengths[x + 1]
                own = size == x
                run[own] = lo + np.searchsorted(table["number"][lo:hi], k[own], side="right") - 1
            j = k - table["number"][run]
            sequence = table["bin"][run] + j // table["each"][run]
            offset = table["offset"][run] + j % table["each"][run] * size
            yield doc, piece, start, length, crc, sequence, offset

        return work

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return arrow_map(ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "number"), make, schema)
