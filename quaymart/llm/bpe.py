"""Byte-level BPE: texts to token ids and back.

The vocabulary file is a parameter; every task reads it from the place its own
machine has it.  A text is cut by the pattern, and each different piece is encoded
once by the ``tokenizers`` library and kept, up to a bound, for the next ones.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import models

from quaymart.llm.common import quoted, slices, text_or_empty

RANKS = "byte_bpe_50k.tiktoken"
_PIECES, _LONG, _ROWS = 100_000, 64, 256


def byte_characters() -> dict[int, str]:
    """The visible character that stands for each byte.

    Printable Latin-1 bytes stand for themselves, the others for the characters from
    256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Codec:
    """Encoder and decoder for a file of ranks."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        table = byte_characters()
        shown = {token: "".join(map(table.__getitem__, token)) for token in ranks}
        merges = []
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                left, right = self._parts(ranks, token, rank)
                merges.append((shown[left], shown[right]))
        vocabulary = {shown[token]: rank for token, rank in ranks.items()}
        self._model = models.BPE(vocabulary, merges)
        self._shown = table  # code points up to 255 stand for bytes
        self._split = regex.compile(pattern).findall
        # The byte table reversed, once for each token of the vocabulary.
        byte_of = {shown: byte for byte, shown in table.items()}
        self._bytes = {i: bytes(map(byte_of.__getitem__, t)) for t, i in vocabulary.items()}
        self._known: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    @staticmethod
    def _parts(ranks: dict[bytes, int], token: bytes, rank: int) -> tuple[bytes, bytes]:
        """The two tokens that the merges of lower rank leave of a token's bytes."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(
                range(len(parts) - 1),
                key=lambda i: ranks.get(parts[i] + parts[i + 1], rank),
            )
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts[0], parts[1]

    def _learned(self, piece: str) -> bytes:
        """Ids of a piece, as the bytes of 32-bit numbers."""
        shown = piece.encode().decode("latin-1").translate(self._shown)
        return np.array([t.id for t in self._model.tokenize(shown)], np.int32).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; special tokens in a text are ordinary text.

        Known pieces are kept in two generations, so that frequent ones stay when the
        older one goes.
        """
        result = []
        for text in texts:
            pieces = self._split(text)
            found = list(map(self._known.get, pieces))
            if None in found:
                missing = {p for p, x in zip(pieces, found, strict=True) if x is None}
                own = {p: self._old[p] for p in missing if p in self._old}
                own |= {p: self._learned(p) for p in missing - own.keys()}
                found = [own[p] if x is None else x for p, x in zip(pieces, found, strict=True)]
                self._known.update((p, x) for p, x in own.items() if len(p) <= _LONG)
                if len(self._known) > _PIECES:
                    self._known, self._old = {}, self._known
            result.append(np.frombuffer(b"".join(found), np.int32))
        return result

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids; a character split over tokens is whole again."""
        return b"".join(map(self._bytes.__getitem__, ids.tolist()))

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end code point of each token.

        A token that ends within a character counts it; the next token begins with
        the same character.
        """
        data = np.frombuffer(text.encode(), np.uint8)
        starts = np.cumsum((data & 0xC0) != 0x80)  # characters begun up to each byte
        sizes = np.array([len(self._bytes[i]) for i in ids.tolist()], np.int64)
        ends = np.cumsum(sizes)
        return starts[ends - sizes] - 1, starts[ends - 1]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _place(path: str | None) -> str:
    return path or public_tokenizers.path(RANKS)


_NONE = np.empty(0, np.int32)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """An Arrow column of lists from arrays of numbers."""
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(arrays)))


def encode(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    offsets: bool = False,
) -> DataFrame:
    """``doc_id, ids`` of every row, and on request ``first`` and ``end`` of each token.

    A null text is an empty one and has no ids.  Offsets are code points.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(_place(path), pattern)
        for batch in slices(batches, _ROWS):
            texts = batch.column(1).to_pylist()
            ids = coder.encode(texts)
            columns = [batch.column(0), _lists(ids)]
            if offsets:
                spans = [coder.offsets(t, i) for t, i in zip(texts, ids, strict=True)]
                columns += [_lists([s[k] for s in spans]) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "ids", *["first", "end"] * offsets]
    rows = docs.select(
        F.col(quoted(id_column)).cast("long").alias("doc_id"),
        text_or_empty(text_column).alias("text"),
    )
    more = ", first array<long>, end array<long>" if offsets else ""
    return rows.mapInArrow(run, f"doc_id long, ids array<int>{more}")


def decode(
    tokens: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """``doc_id, ids, decoded``: the bytes of the ids, also if they are no whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(_place(path), pattern)
        for batch in slices(batches, _ROWS):
            lists = batch.column(1)
            found = [
                coder.decode(x.values.to_numpy() if x.is_valid else _NONE) for x in lists
            ]
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    schema = "doc_id long, ids array<int>, decoded binary"
    return tokens.select("doc_id", "ids").mapInArrow(run, schema)


def round_trip(docs: DataFrame) -> DataFrame:
    """Ids of every text, with hashes of the ids and of the bytes decoded from them.

    A null or empty text has no ids and decodes to no bytes; a very long one is encoded whole.
    A repeated row has the same result each time, an empty table none; columns other than
    ``doc_id, text`` are ignored, whatever their names.
    """
    return decode(encode(docs)).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "ids",
    )
