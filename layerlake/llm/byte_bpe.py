"""Byte-level BPE encoding and decoding with a sentencepiece model made from a rank file.

Every token's bytes become a string of printable characters, one per byte; its
score is the negative rank, so the best-scored merge is the one of lowest rank.
The model file, a protocol buffer, is written directly from the vocabulary:
type BPE, identity normalisation, no dummy prefix, no escaped white space. Its
ids are the ranks; the piece for unknown input comes after them and cannot
occur, since every byte is a piece.

Texts are cut into pre-tokens by the pattern, pre-tokens are encoded by the
model, and ids are decoded by the inverse of the byte mapping. Null text counts
as empty and has no ids. Rows are handled alone.
"""

from __future__ import annotations

import functools
import hashlib

import public_tokenizers
from pyspark.sql import DataFrame

from .common import arrow_map, id_text
from .vocab import Memo, byte_letters, ranks, splitter, units

FILE = "byte_bpe_multi_50k.tiktoken"
MEMORY = 14_000_000  # characters and overhead of remembered pieces


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(number: int, value) -> bytes:
    """A field of a protocol buffer: bytes and messages, floats, or integers and flags."""
    import struct

    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def model_bytes(vocab: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece model whose ids are the ranks of ``vocab``.

    Field numbers are those of sentencepiece_model.proto.
    """
    letters = byte_letters()
    by_rank = {r: t for t, r in vocab.items()}
    if sorted(by_rank) != list(range(len(vocab))) or any(bytes([b]) not in vocab for b in range(256)):
        raise ValueError("ranks must run from 0 without gaps and hold every byte")
    normal, unknown, bpe = 1, 2, 2
    pieces = [
        _field(1, _field(1, "".join(letters[b] for b in by_rank[r]).encode()) + _field(2, float(-r)) + _field(3, normal))
        for r in range(len(vocab))
    ]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)))
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, len(vocab)) + _field(41, -1 % 2**64)
    trainer += _field(42, -1 % 2**64) + _field(43, -1 % 2**64)
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encodes and decodes with the ranks of a file; pre-tokens met before come from a bounded memory."""

    def __init__(self, path: str, pattern: str):
        import sentencepiece

        self.vocab = vocab = ranks(path)
        self.letters = {chr(b): c for b, c in byte_letters().items()}  # Latin-1 characters stand for bytes
        self.letters = str.maketrans(self.letters)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(vocab))
        self.bytes_of = {str(r): t for t, r in vocab.items()}
        self.pieces = splitter(pattern)
        self.piece = Memo(self._piece, MEMORY)
        self.unit = Memo(self._unit, MEMORY)

    def _piece(self, piece: str) -> str:
        data = piece.encode()
        if data in self.vocab:  # a pre-token that is a token is that token, whether merges reach it or not
            return str(self.vocab[data])
        mapped = data.decode("latin-1").translate(self.letters)
        return ",".join(map(str, self.model.encode(mapped)))

    def _unit(self, unit: str) -> str:
        return ",".join([self.piece[p] for p in self.pieces(unit)])

    def encode(self, text: str) -> str:
        """Ids in decimal, joined by commas."""
        return ",".join(map(self.unit.__getitem__, units(text)))

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.split(","))) if ids else b""


@functools.cache
def codec(path: str, pattern: str = public_tokenizers.PATTERN) -> Codec:
    """One per worker process."""
    return Codec(path, pattern)


def encoded(docs: DataFrame, path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id and ``ids``, an array of token ids."""

    def make():
        c = codec(path)

        def work(ids, texts):
            rows = map(c.encode, texts.to_pylist())
            yield ids, [[int(x) for x in r.split(",")] if r else [] for r in rows]

        return work

    return arrow_map(id_text(docs, id_col, text_col), make, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and ``data``, the bytes that ``ids`` stand for; a null list gives no bytes."""

    def make():
        c = codec(path)

        def work(ids, lists):
            yield ids, [c.decode(",".join(map(str, x or []))) for x in lists.to_pylist()]

        return work

    return arrow_map(tokens.select("doc_id", "ids"), make, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids and of what they decode to."""

    def make():
        c = codec(path)

        def work(ids, texts):
            n, of_ids, of_bytes = [], [], []
            for text in texts.to_pylist():
                tokens = c.encode(text)
                n.append(tokens.count(",") + 1 if tokens else 0)
                of_ids.append(hashlib.sha256(tokens.encode()).hexdigest())
                of_bytes.append(hashlib.sha256(c.decode(tokens)).hexdigest())
            yield ids, n, of_ids, of_bytes

        return work

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_map(id_text(docs, id_col, text_col), make, schema)
