"""Counting and encoding stay linear in runs of white space, in unbroken letters, and bounded in memory; nothing in gives nothing out."""

from __future__ import annotations

import time

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from layerlake.llm import byte_bpe, token_counts, vocab

PATH = public_tokenizers.path(token_counts.FILE)
LONG = {
    "blanks": "a" + " " * 100_000 + "b", "newlines": "a" + "\n" * 100_000 + "b", "mixed": "a" + " \n\t" * 33_000 + " b",
    "letters": "漢字かな交じり文を続けて" * 30_000, "apostrophes": "'" * 50_000 + "s", "tabs at the end": "x" + "\t" * 50_000,
}


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("name", sorted(LONG))
def test_long_runs(name, library):
    text = LONG[name]
    start = time.perf_counter()
    counts = token_counts.PrefixCounter(PATH).prefix_counts(text)
    assert time.perf_counter() - start < 30  # seconds; the square of the length would take hours
    assert len(counts) == len(text) + 1
    for end in (len(text), len(text) - 1, len(text) // 2, 1_000, 7):
        assert counts[end] == len(library.encode(text[:end], add_special_tokens=False).ids)


@pytest.mark.parametrize("space", [" ", "\n", "\t", "\r\n", " \n", " ", "　 ", "\x85", "\x1c", "\x1f ", "​"])
def test_every_prefix_of_short_runs(space, library):
    c = token_counts.counter(PATH)
    for n in range(1, 13):
        for before, after in (("a", "b"), ("", "b"), ("a", ""), ("!", "'s"), ("1", "."), ("it'", "'ll"), ("é", "日本")):
            text = before + space * n + after + space + "'ve x"
            want = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
            assert c.prefix_counts(text).tolist() == want, (before, n, after)


def test_memory_is_bounded_by_characters():
    made = []
    memo = vocab.Memo(lambda k: made.append(k) or k, 10 * (vocab.OVERHEAD + 100))
    long = "x" * (vocab.LONGEST + 1)
    assert memo[long] == memo[long] == long and made == [long, long] and not memo
    for i in range(100):
        assert memo[f"{i:0100}"] == f"{i:0100}"
        assert len(memo) <= 10
    before = len(made)
    assert memo[f"{99:0100}"] and len(made) == before


def test_long_texts_through_the_codec():
    c = byte_bpe.codec(public_tokenizers.path(byte_bpe.FILE))
    for text in LONG.values():
        assert c.decode(c.encode(text)) == text.encode()


def test_nothing(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string, ids string")
    assert token_counts.token_counts(nothing, PATH).count() == 0
    assert token_counts.prefix_tables(nothing, PATH).count() == 0
    path = public_tokenizers.path(byte_bpe.FILE)
    assert byte_bpe.round_trip(nothing, path).count() == 0
    assert byte_bpe.decoded(byte_bpe.encoded(nothing, path), path).count() == 0
