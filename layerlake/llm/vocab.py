"""Reading tokenizer files, and splitting text as their libraries do.

The files' place is a parameter; nothing of them is copied into this package.
"""

from __future__ import annotations

import base64
import functools
import re

LATIN = re.compile("[\x00-ɏ]*").fullmatch
GAP = re.compile(r" \s|[^\S ] ").search
BEFORE_WORD = re.compile(r"(?<=\S)(?= \S)").split


def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(spare)) for b in range(256)}


def units(text: str) -> list[str]:
    """Cuts before each single space between two words.

    With the pattern of the byte-level files such a space begins a piece
    whatever precedes it, so the pieces of a text, and of each of its
    prefixes, are those of its units in order.
    """
    if GAP(text) or text[-1:] == " ":
        return [u for u in BEFORE_WORD(text) if u]
    head, *rest = text.split(" ")
    out = [" " + x for x in rest]
    return [head, *out] if head else out


@functools.cache
def splitter(pattern: str):
    """A function that gives the matches of ``pattern`` in a short text.

    Letters and numbers are those of the libraries' Unicode tables. The
    ``regex`` module's tables differ for some characters beyond U+024F, so
    texts with such characters are split by the tokenizers library.
    """
    import regex
    from tokenizers import Regex, pre_tokenizers

    plain = regex.compile(pattern).findall
    exact = pre_tokenizers.Split(Regex(pattern), "isolated")
    return lambda text: plain(text) if LATIN(text) else [p for p, _ in exact.pre_tokenize_str(text)]


#: Longer keys are not remembered: they seldom come again.
LONGEST = 256
#: What a key and its value take besides their characters.
OVERHEAD = 16


class Memo(dict):
    """Remembers what ``make`` gave for a key.

    Keys of more than ``LONGEST`` characters are made anew each time. Once the
    keys held have ``most`` characters in all, ``OVERHEAD`` more counted for
    each, it starts anew; values are no larger than a multiple of their keys,
    so memory is bounded whatever the texts are.
    """

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.held = make, most, 0

    def __missing__(self, key):
        value = self.make(key)
        size = len(key)
        if size <= LONGEST:
            self.held += size + OVERHEAD
            if self.held > self.most:
                self.clear()
                self.held = size + OVERHEAD
            self[key] = value
        return value


def unreached(model: dict) -> set[str]:
    """Tokens of a merge file that the merges do not make from their own characters.

    They never occur in an encoding. For all others, merging by the rank of
    the joined string is the same as merging by listed pair.
    """
    from tokenizers import models

    suffix = model.get("end_of_word_suffix") or ""
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    inner = models.BPE(vocab=model["vocab"], merges=merges)
    final = models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=suffix) if suffix else inner
    out = set()
    for token in map("".join, merges):
        ends = suffix and token.endswith(suffix)
        got = final.tokenize(token.removesuffix(suffix)) if ends else inner.tokenize(token)
        if len(got) != 1:
            out.add(token)
    return out
