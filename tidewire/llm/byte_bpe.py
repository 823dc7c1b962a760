"""Encoding of texts by a public byte-level BPE vocabulary.

The vocabulary is serialised as a sentencepiece BPE model: each token's bytes become one character each (bytes that print keep
theirs, the others move up from 256), its score is the negative rank, and the normalisation is the identity. Texts are cut into
pre-tokens first and each pre-token is encoded by itself; decoding is the inverse mapping. Nothing is trained.
"""

from __future__ import annotations

import base64
import os
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pre-token pattern of this family of vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 1 << 19  # pre-tokens a worker remembers before it starts afresh


def default_vocabulary() -> str:
    """TIDEWIRE_TOKENIZERS (a folder), else where the package of public tokenizers lies."""
    folder = os.environ.get("TIDEWIRE_TOKENIZERS", "/opt/tokenizers")
    return os.path.join(folder, "byte_bpe_50k.tiktoken")


@lru_cache(1)
def byte_characters() -> str:
    """256 distinct printing characters, one for each byte: a byte that prints in Latin-1 is its own, the rest follow from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return "".join(chr(b) if b in own else chr(next(spare)) for b in range(256))


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, from lines of base64 and rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(number: int, payload: bytes | int) -> bytes:
    if isinstance(payload, int):
        return _varint(number << 3) + _varint(payload)
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece model whose piece ids are the ranks; the required unknown piece comes after them and is never produced."""
    letters = byte_characters()
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = "".join(letters[b] for b in token).encode()
        out += _field(1, _field(1, piece) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank)) + _field(3, 1))
    out += _field(1, _field(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _field(3, 2))
    out += _field(2, _field(3, 2) + _field(4, len(tokens) + 1))  # model type BPE
    out += _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(out)


class Codec:
    """encode() and decode() of one vocabulary; null and "" both have no ids."""

    def __init__(self, model: bytes):
        import regex
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(PATTERN).findall
        self.letters = byte_characters()
        self.known: dict[str, tuple[int, ...]] = {}

    def _learn(self, pieces: list[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [p for p in dict.fromkeys(pieces) if p not in self.known]
        if new:
            letters = self.letters
            mapped = ["".join([letters[b] for b in p.encode()]) for p in new]
            self.known.update(zip(new, map(tuple, self.sp.encode(mapped, num_threads=1))))

    def encode(self, text: str | None) -> list[int]:
        pieces = self.find(text or "")
        self._learn(pieces)
        return list(chain.from_iterable(map(self.known.__getitem__, pieces)))

    def decode(self, ids: list[int]) -> str:
        at = {c: b for b, c in enumerate(self.letters)}
        return bytes(at[c] for i in ids for c in self.sp.id_to_piece(int(i))).decode("utf-8", "replace")


def encode_texts(df: DataFrame, key: str, text: str, vocabulary: str | None = None) -> DataFrame:
    """`key` and ids (array<int>) of every row, without special tokens.

    Null and empty texts have the empty list; strings that look like special tokens are ordinary text; repeated rows come out as
    often as they went in; any further columns are left out. The model (about 1 MB, bounded by the vocabulary) goes to the workers
    as a broadcast variable; there is no shuffle.
    """
    model = df.sparkSession.sparkContext.broadcast(serialise(read_ranks(vocabulary or default_vocabulary())))
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [codec.encode(t) for t in part.column(1).to_pylist()]
                offsets = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
                flat = pa.array(np.fromiter(chain.from_iterable(ids), np.int32, int(offsets[-1])))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), flat)], names=[key, "ids"])

    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, ids array<int>")
