"""Token counts: prefix dynamic programming over byte-level BPE.

For every prefix of a text the exact number of tokens its own encoding has is
stored, as a change per character. Questions about truncation
and budgets are then look-ups; nothing is encoded again.

Method. A sequence of tokens is the encoding of its bytes exactly if every two
neighbours are what the merges make of those two tokens' bytes. So the encoding
of a prefix ends in the longest token t for which the encoding of the rest ends
in a token that t may follow, and count[i] = count[i - len(t)] + 1. The table is
made once per distinct piece of text and kept in a bounded memory.

A prefix that ends in white space has the whole run before its end in one piece,
so one table for a run serves all its prefixes, however long it is. Long pieces
and long words are not remembered.

Null text counts as empty: no tokens. Rows are handled alone, so repeated rows
and an empty table need no care.
"""

from __future__ import annotations

import functools
import json
import re
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, id_text
from .vocab import OVERHEAD, Memo, byte_letters, splitter, units, unreached

FILE = "byte_bpe_50k.json"
LIMIT = 512
MEMORY = 24_000_000  # characters and overhead of remembered pieces
#: What the pattern takes for white space, and the pieces whose prefixes are split in another way.
SPACE = re.compile("[\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+").fullmatch
CONTRACTION = re.compile("'(?:[sdmt]|ll|ve|re)").fullmatch
#: A space or none, Latin letters, and ASCII marks other than an apostrophe: two pieces at most.
WORD = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@[-`{-~]*)").fullmatch


class PrefixCounter:
    """Exact token counts of all prefixes of a text, as the tokenizers library would give for each prefix."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        byte = {c: b for b, c in byte_letters().items()}
        if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or model["type"] != "BPE":
            raise ValueError(f"{path} is not a byte-level BPE file")
        special = [t["content"] for t in spec["added_tokens"]]
        out = {*special, *unreached(model)}
        vocab = {t: i for t, i in model["vocab"].items() if t not in out}
        raw = {bytes(byte[c] for c in t): i for t, i in vocab.items()}
        order = {"".join(m): k for k, m in enumerate(tuple(x) if isinstance(x, list) else x.split(" ") for x in model["merges"])}
        merge = {bytes(byte[c] for c in t): 256 + k for t, k in order.items() if t in vocab} | {bytes([b]): b for b in range(256)}
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        lengths = defaultdict(set)
        for t in raw:
            lengths[t[-2:]].add(len(t))
        self.lengths = {end: sorted(n, reverse=True) for end, n in lengths.items()}
        self.core = tiktoken.Encoding("merges", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merge, special_tokens={})._core_bpe
        self.token = {t: merge[t] for t in raw}
        self.text_of = {i: t for t, i in self.token.items()}
        self.follows = Memo(self._follows, 2_000_000 * (OVERHEAD + 2))
        self.pieces = splitter(public_tokenizers.PATTERN)
        self.table = Memo(self._piece, MEMORY)
        self.unit = Memo(self._unit, MEMORY)

    def _follows(self, pair: tuple[int, int]) -> bool:
        a, b = pair
        return self.core.encode_single_piece(self.text_of[a] + self.text_of[b]) == [a, b]

    def _piece(self, piece: str) -> bytes | list[int]:
        """Counts after each character of one piece; between characters' bytes the table goes on inside."""
        data = piece.encode()
        n, token, follows, lengths = len(data), self.token.get, self.follows, self.lengths
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            for size in lengths.get(data[i - 2 : i], ()) if i > 1 else ():
                j = i - size
                if j < 0:
                    continue
                t = token(data[j:i])
                if t is not None and (not j or follows[last[j], t]):
                    last[i], count[i] = t, count[j] + 1
                    break
            else:  # every byte is a token
                last[i], count[i] = token(data[i - 1 : i]), count[i - 1] + 1
        if n != len(piece):
            count = [0, *(count[i] for i in range(1, n + 1) if i == n or data[i] & 0xC0 != 0x80)]
        return bytes(count[1:]) if n < 256 else count[1:]

    def _unit(self, unit: str) -> bytes:
        """Changes of the count over the prefixes of a unit, each prefix split as if the text ended there."""
        m = WORD(unit)
        if m:
            out = list(self.table[m[1]])
            if m[2]:
                out += [out[-1] + c for c in self.table[m[2]]]
            return array("i", map(int.__sub__, out, [0, *out])).tobytes()
        out, done, run, before_run = [], 0, "", 0
        for piece in self.pieces(unit):
            counts = self.table[piece]
            if SPACE(piece):
                if not run:
                    before_run = done
                run += piece
            else:
                shown = 0
                if run:  # a prefix that ends in white space has it in one piece, up to the space that begins this one
                    shown = piece[0] == " "
                    out += [before_run + c for c in self.table[run + " " * shown]]
                    run = ""
                if CONTRACTION(piece):  # a prefix of it is an apostrophe and letters
                    mark = self.table["'"][0]
                    counts = [mark, *(mark + c for c in self.table[piece[1:]])][: len(piece) - 1] + [counts[-1]]
                out += [done + c for c in counts[shown:]]
            done += self.table[piece][-1]
        if run:
            out += [before_run + c for c in self.table[run]]
        return array("i", map(int.__sub__, out, [0, *out])).tobytes()

    def _plain(self, text: str) -> np.ndarray:
        change = np.frombuffer(b"".join(map(self.unit.__getitem__, units(text))), np.int32)
        return np.cumsum(change, dtype=np.int64)

    def prefix_counts(self, text: str) -> np.ndarray:
        """count[i] is the number of tokens of the first i characters, from i = 0."""
        if not (self.special and "<" in text):
            return np.concatenate(([0], self._plain(text)))
        parts, out, done = [*self.special.split(text), ""], [np.zeros(1, np.int64)], 0
        for part, special in zip(parts[::2], parts[1::2], strict=True):
            # a special string is ordinary text until its last character makes it one token
            counts = done + self._plain(part + special)
            if special:
                done = (counts[len(part) - 1] if part else done) + 1
                counts[-1] = done
            out.append(counts)
        return np.concatenate(out)


@functools.cache
def counter(path: str) -> PrefixCounter:
    """One per worker process."""
    return PrefixCounter(path)


def fits(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix that has at most ``budget`` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1])


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, and fit_chars: characters of the longest prefix within the limit."""

    def make():
        c = counter(path)

        def work(ids, texts):
            rows = []
            for text in texts.to_pylist():
                counts = c.prefix_counts(text)
                rows.append((len(text.encode()), int(counts[-1]), fits(counts, limit)))
            size, tokens, chars = map(list, zip(*rows, strict=True))
            yield ids, size, tokens, [n > limit for n in tokens], chars

        return work

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    return arrow_map(id_text(docs, id_col, text_col), make, schema)


def prefix_tables(docs: DataFrame, path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_chars and ``changes``: the table itself, four little-endian bytes a character."""

    def make():
        c = counter(path)

        def work(ids, texts):
            texts = texts.to_pylist()
            yield ids, [len(t) for t in texts], [np.diff(c.prefix_counts(t)).astype("<i4").tobytes() for t in texts]

        return work

    return arrow_map(id_text(docs, id_col, text_col), make, "doc_id long, n_chars long, changes binary")


def tokens_before(tables: DataFrame, chars: int) -> DataFrame:
    """doc_id and the token count of the first ``chars`` characters, from stored tables."""

    def make():
        def work(ids, changes):
            yield ids, [int(np.frombuffer(b, "<i4")[:chars].sum(dtype=np.int64)) for b in changes.to_pylist()]

        return work

    return arrow_map(tables.select("doc_id", "changes"), make, "doc_id long, n_tokens long")


def longest_prefix(tables: DataFrame, budget: int) -> DataFrame:
    """doc_id and the characters of the longest prefix within ``budget`` tokens, from stored tables."""

    def make():
        def work(ids, changes):
            yield ids, [fits(np.append(0, np.cumsum(np.frombuffer(b, "<i4"), dtype=np.int64)), budget)
                        for b in changes.to_pylist()]

        return work

    return arrow_map(tables.select("doc_id", "changes"), make, "doc_id long, chars long")


def total_tokens(counts: DataFrame) -> DataFrame:
    return counts.agg(F.sum("n_tokens").alias("n_tokens"))
