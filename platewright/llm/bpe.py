"""Byte-pair encoding and decoding with forced-boundary splitting.

A pair of bytes that stands inside no token of the vocabulary can never be
merged, so a text may be cut there: the fragments are encoded one by one and
their ids are put together. Fragments repeat very often, so each task keeps the
ids of the short ones it has met.

A cut must not change how the tokenizer splits a text into words either. Its
pattern looks at what follows white space and at apostrophes, so a cut is made
only after a visible ASCII character, before the first byte of a character, and
never before an apostrophe. Words of the pattern that reach over such a cut are
letters, digits or symbols on both sides, whose parts the pattern takes as they
are. Special tokens are found first, as the tokenizer does.

Defined results: null and empty texts have no ids and decode to an empty text.
Repeated rows, and rows with null ids, are encoded like any other. Other columns
are kept; a column with the name of an added one is replaced.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from platewright.llm.arrow import kept_by_worker, with_arrow_columns

#: Fragments of so many bytes at most are remembered, and twice so many of them at most.
MEMO_BYTES, MEMO_FRAGMENTS = 64, 150_000
APOSTROPHE = ord("'")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file of a byte-level vocabulary.

    Visible Latin-1 characters stand for themselves, the others are numbered
    from 256 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(rest)}


def token_bytes(tokenizer_json: str) -> list[bytes]:
    """The bytes of each token by id, special tokens included."""
    spec = json.loads(tokenizer_json)
    letters = byte_letters()
    tokens = {i: bytes(letters[c] for c in t) for t, i in spec["model"]["vocab"].items()}
    tokens |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    return [tokens.get(i, b"") for i in range(max(tokens) + 1)]


def cut_table(tokenizer_json: str) -> np.ndarray:
    """For each pair of bytes (first * 256 + second), whether to cut between them."""
    letters = byte_letters()
    inside = np.zeros((256, 256), bool)
    for token in json.loads(tokenizer_json)["model"]["vocab"]:
        codes = [letters[c] for c in token]
        inside[codes[:-1], codes[1:]] = True
    cut = ~inside
    cut[:0x21] = cut[0x7F:] = False
    cut[:, 0x80:0xC0] = False
    cut[:, APOSTROPHE] = False
    return cut.reshape(-1)


class Encoder:
    def __init__(self, tokenizer_json: str, cut: np.ndarray) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cut = cut
        special = sorted((t["content"] for t in json.loads(tokenizer_json)["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.memo: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def fragments(self, data: bytes) -> list[bytes]:
        codes = np.frombuffer(data, np.uint8)
        pairs = codes[:-1].astype(np.uint16) << 8 | codes[1:]
        at = [0, *(np.flatnonzero(self.cut[pairs]) + 1).tolist(), len(data)]
        return [data[a:b] for a, b in zip(at, at[1:])]

    def segment(self, text: str) -> bytes:
        """Ids of a text without special tokens, as little-endian 32-bit numbers."""
        parts = self.fragments(text.encode())
        ids = list(map(self.memo.get, parts))
        if None in ids:
            new = self.learned({p for p, i in zip(parts, ids) if i is None})
            ids = [new[p] if i is None else i for p, i in zip(parts, ids)]
        return b"".join(ids)

    def learned(self, parts: set[bytes]) -> dict[bytes, bytes]:
        """Ids of fragments that are not remembered, which the short ones then are."""
        found = {p: self.before[p] for p in parts if p in self.before}
        rest = [p for p in parts if p not in found]
        encoded = self.tokenizer.encode_batch_fast([p.decode() for p in rest], add_special_tokens=False)
        found.update((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(rest, encoded))
        if len(self.memo) > MEMO_FRAGMENTS:
            # What is used again comes back from the fragments before, the others go with the next turn.
            self.before, self.memo = self.memo, {}
        self.memo.update((p, i) for p, i in found.items() if len(p) <= MEMO_BYTES)
        return found

    def encode(self, text: str) -> bytes:
        pieces = self.special.split(text) if self.special else [text]
        ids = []
        for n, piece in enumerate(pieces):
            if n % 2:
                ids.append(np.array([self.tokenizer.token_to_id(piece)], "<u4").tobytes())
            elif piece:
                ids.append(self.segment(piece))
        return b"".join(ids)


def encode(docs: DataFrame, tokenizer_json: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds ``ids`` (little-endian 32-bit numbers, as binary) and ``n_tokens``.

    ``tokenizer_json`` is the content of a byte-level tokenizer's file; it is
    sent to the tasks, being of a fixed size.
    """
    spec = docs.sparkSession.sparkContext.broadcast((tokenizer_json, cut_table(tokenizer_json)))
    key = ("encode", hash_of(tokenizer_json))

    def make():
        encoder = kept_by_worker(key, lambda: Encoder(*spec.value))

        def encode_batch(batch: pa.RecordBatch) -> list:
            found = [encoder.encode(t) if t else b"" for t in batch.column(text).to_pylist()]
            return [found, [len(x) // 4 for x in found]]

        return encode_batch

    added = T.StructType([T.StructField(ids, T.BinaryType()), T.StructField("n_tokens", T.LongType())])
    return with_arrow_columns(docs, added, make)


def hash_of(tokenizer_json: str) -> str:
    return hashlib.sha256(tokenizer_json.encode()).hexdigest()


def decoder(tokens: list[bytes]):
    """The text of ids given as little-endian 32-bit numbers."""
    token = tokens.__getitem__

    def text(ids: bytes | None) -> str:
        return b"".join(map(token, np.frombuffer(ids or b"", "<u4").tolist())).decode("utf-8", "replace")

    return text


def round_trip(docs: DataFrame, tokenizer_json: str, text: str = "text") -> DataFrame:
    """Adds ``ids``, ``n_tokens`` and the text ``decoded`` from the ids, by one Python worker a task."""
    spec = docs.sparkSession.sparkContext.broadcast((tokenizer_json, cut_table(tokenizer_json)))
    key = ("round_trip", hash_of(tokenizer_json))

    def make():
        encoder, to_text = kept_by_worker(key, lambda: (Encoder(*spec.value), decoder(token_bytes(spec.value[0]))))

        def both(batch: pa.RecordBatch) -> list:
            found = [encoder.encode(t) if t else b"" for t in batch.column(text).to_pylist()]
            return [found, [len(x) // 4 for x in found], [to_text(x) for x in found]]

        return both

    return with_arrow_columns(docs, T.StructType([
        T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("decoded", T.StringType()),
    ]), make)


def decode(docs: DataFrame, tokenizer_json: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the ``decoded`` text of ``ids``; bytes that are no UTF-8 are replaced."""
    tokens = docs.sparkSession.sparkContext.broadcast(token_bytes(tokenizer_json))

    def make():
        to_text = decoder(tokens.value)

        def decode_batch(batch: pa.RecordBatch) -> list:
            return [[to_text(x) for x in batch.column(ids).to_pylist()]]

        return decode_batch

    return with_arrow_columns(docs, T.StructType([T.StructField(decoded, T.StringType())]), make)
