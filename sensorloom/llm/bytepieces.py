"""Byte-level BPE through sentencepiece: a model serialised straight from a vocabulary of ranks.

Every byte becomes one letter, every token the piece of its bytes' letters with the score minus its
rank, and normalisation is the identity. sentencepiece joins the neighbours of the highest score
first, the leftmost of equals, which is the order of the ranks. A piece's number is its rank.
"""

from __future__ import annotations

import base64
import codecs
import struct
from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Letters of the bytes: none is a space or a control character.
FIRST = 0x100
LETTERS = "".join(chr(FIRST + byte) for byte in range(256))
#: Pre-tokens a worker remembers, and the longest of them in code points. Others are encoded anew.
REMEMBERED, LONGEST = 1 << 19, 64

# Field numbers and constants of the published sentencepiece model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_KIND = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
MODEL_TYPE, VOCAB_SIZE, BPE = 3, 4, 2
UNK_ID, BOS_ID, EOS_ID, PAD_ID = 40, 41, 42, 43
NORMALIZER_NAME, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES = 1, 3, 4, 5


def read_vocabulary(path: str | Path = VOCABULARY) -> list[bytes]:
    """The tokens of a file of ``base64 rank`` lines, by rank."""
    lines = Path(path).read_bytes().splitlines()
    ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines))
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError("the ranks are not the numbers from 0 on, each once")
    tokens = [token for _, token in ranked]
    if missing := {bytes([byte]) for byte in range(256)} - set(tokens):
        raise ValueError(f"{len(missing)} bytes are no tokens")
    return tokens


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value & (1 << 64) - 1)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _float(field: int, value: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", value)


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def serialised(tokens: Sequence[bytes]) -> bytes:
    """The sentencepiece model of a vocabulary; an unknown piece, never met, comes last."""

    def piece(text: str, score: float, kind: int) -> bytes:
        body = _bytes(PIECE_TEXT, text.encode()) + _float(PIECE_SCORE, score)
        return _bytes(PIECES, body + _number(PIECE_KIND, kind))

    if len(tokens) > 1 << 24:
        raise ValueError("a 32-bit score does not tell more than 2**24 ranks apart")
    pieces = [piece(as_letters(t), -float(rank), NORMAL) for rank, t in enumerate(tokens)]
    trainer = _number(MODEL_TYPE, BPE) + _number(VOCAB_SIZE, len(tokens) + 1)
    trainer += _number(UNK_ID, len(tokens))
    trainer += b"".join(_number(field, -1) for field in (BOS_ID, EOS_ID, PAD_ID))
    identity = _bytes(NORMALIZER_NAME, b"identity")
    identity += b"".join(_number(f, 0) for f in (DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES))
    unknown = piece("<unk>", 0.0, UNKNOWN)
    return b"".join([*pieces, unknown, _bytes(TRAINER, trainer), _bytes(NORMALIZER, identity)])


def as_letters(raw: bytes) -> str:
    return codecs.charmap_decode(raw, "strict", LETTERS)[0]


def as_bytes(piece: str) -> bytes:
    return bytes(ord(letter) - FIRST for letter in piece)


class Encoder(dict):
    """Ids of pre-tokens as little-endian 32-bit numbers, remembered up to a bound."""

    def __init__(self, model: bytes, pattern: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        self.whole, self.merged = self.processor.piece_to_id, self.processor.encode_as_ids
        self.unknown = self.processor.unk_id()

    def __missing__(self, part: str) -> bytes:
        letters = as_letters(part.encode())
        whole = self.whole(letters)
        # a pre-token that is itself a token is that token, even where no merges lead to it
        found = [whole] if whole != self.unknown else self.merged(letters)
        ids = struct.pack(f"<{len(found)}i", *found)
        if len(part) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[part] = ids
        return ids

    def __call__(self, raw: bytes) -> bytes:
        return b"".join(map(self.__getitem__, self.split(raw.decode("utf-8", "replace"))))


@dataclass(frozen=True)
class BytePieces:
    """Encoding and decoding by one vocabulary, as column expressions.

    The model, as large as the vocabulary file, travels with the function. ``pattern`` splits a text
    into pre-tokens; what stands between its matches is lost, as the public patterns leave nothing.
    """

    model: bytes
    pattern: str = PATTERN

    @classmethod
    def read(cls, path: str | Path = VOCABULARY, pattern: str = PATTERN) -> BytePieces:
        return cls(serialised(read_vocabulary(path)), pattern)

    def encode(self, text: Column) -> Column:
        """The ids of a text as an array; a NULL or empty text has none. Bytes that are no UTF-8
        count as U+FFFD."""
        model, pattern, encoder = self.model, self.pattern, []

        @F.arrow_udf("array<int>")
        def ids(raw: pa.Array) -> pa.Array:
            if not encoder:
                encoder.append(Encoder(model, pattern))
            each = [encoder[0](value.as_py() or b"") for value in raw]
            ends = np.cumsum([0, *(len(part) // 4 for part in each)], dtype=np.int32)
            values = pa.array(np.frombuffer(b"".join(each), "<i4"))
            return pa.ListArray.from_arrays(pa.array(ends), values)

        return ids(text.cast("string").cast("binary"))

    def decode(self, ids: Column) -> Column:
        """The bytes that ids stand for; NULL for NULL. An id outside the vocabulary fails."""
        model, pieces = self.model, []

        @F.arrow_udf("binary")
        def raw(ids: pa.Array) -> pa.Array:
            if not pieces:
                processor = sentencepiece.SentencePieceProcessor(model_proto=model)
                known = range(processor.get_piece_size() - 1)
                pieces.append({i: as_bytes(processor.id_to_piece(i)) for i in known})
            token = pieces[0].__getitem__
            return pa.array(
                [None if row is None else b"".join(map(token, row)) for row in map(_list, ids)],
                pa.binary(),
            )

        return raw(ids)


def _list(scalar: pa.Scalar) -> list[int] | None:
    return scalar.values.to_numpy(zero_copy_only=False).tolist() if scalar.is_valid else None


def digests(docs: DataFrame, path: str | Path = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs(doc_id, text)``.

    The ids are hashed as decimals joined by one space, the decoded bytes as they are. A NULL text
    is empty: no ids, and the hash of nothing twice. Repeated rows and NULL ids stay rows of their
    own; other columns, whatever their names, are left out.
    """
    pieces = BytePieces.read(path, pattern)
    # a list of one, exploded, keeps the optimizer from encoding once more inside of the decoding
    ids = F.explode(F.array(pieces.encode(F.col("text")))).alias("ids")
    rows = docs.select("doc_id", ids)
    decimals = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimals.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(pieces.decode(F.col("ids")), 256).alias("decoded_sha256"),
    )
