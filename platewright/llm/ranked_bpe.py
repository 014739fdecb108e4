"""Byte-level BPE by ranks, with a two-tier look-up, and decoding.

A pattern splits each text into pre-tokens. The first tier is a minimal perfect
hash of the vocabulary: all pre-tokens of a block are hashed at once, the hash
leads each to the one token that it can be, and their bytes are compared, so a
hit is never wrong. Pre-tokens that are no token go to the second tier: their
bytes are a linked list, and a heap of neighbours gives the pair of least rank
(the first one of ties) until no pair is a token.

Defined results: null and empty texts have no ids and decode to no bytes.
Repeated rows, and rows with null ids, are encoded like any other. Texts of any
length are taken whole, in blocks of pre-tokens; a pre-token of any length is
merged in O(n log n). Other columns are kept; a column with the name of an added
one is replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from platewright.llm.arrow import kept_by_worker, with_arrow_columns

#: Keys of the perfect hash in a bucket, on average, and shifts tried at once for one.
BUCKET, TRIES = 4, 256
#: Pre-tokens encoded at once, and characters of a text that is split in one go.
BLOCK, WHOLE_TEXT = 200_000, 1 << 20
#: Pre-tokens of so many characters at most are remembered, and about twice so many of them.
MEMO_LENGTH, MEMO_PIECES = 32, 200_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Letters and numbers of a Unicode version that the tiktoken library does not
#: have yet, first and last of each range. It takes them for symbols, and so does this module.
UNKNOWN = [
    (0x558, 0x558), (0x58b, 0x58c), (0x88f, 0x88f), (0xc5c, 0xc5c), (0xcdc, 0xcdc), (0x208f, 0x208f),
    (0x209d, 0x209f), (0xa7ce, 0xa7cf), (0xa7d2, 0xa7d2), (0xa7d4, 0xa7d4), (0xa7dd, 0xa7dd), (0xa7e2, 0xa7e2),
    (0xa7f1, 0xa7f1), (0xab6c, 0xab6d), (0x107bb, 0x107bf), (0x10940, 0x10959), (0x10ec5, 0x10ec7),
    (0x10ed9, 0x10eee), (0x11b0a, 0x11b0a), (0x11db0, 0x11ddb), (0x11de0, 0x11de9), (0x11df1, 0x11df1),
    (0x1246f, 0x1246f), (0x12475, 0x1247f), (0x12550, 0x12686), (0x16ea0, 0x16eb8), (0x16ebb, 0x16ed3),
    (0x16ff2, 0x16ff6), (0x187f8, 0x187ff), (0x18cd6, 0x18cda), (0x18d09, 0x18d20), (0x18d80, 0x18df2),
    (0x18e00, 0x19191), (0x191a0, 0x191d2), (0x1b123, 0x1b128), (0x1b168, 0x1b168), (0x1d6a6, 0x1d6a6),
    (0x1df1f, 0x1df24), (0x1df2b, 0x1df81), (0x1df90, 0x1df96), (0x1dfcd, 0x1dfff), (0x1e6c0, 0x1e6de),
    (0x1e6e0, 0x1e6e2), (0x1e6e4, 0x1e6e5), (0x1e6e7, 0x1e6ed), (0x1e6f0, 0x1e6f4), (0x1e6fe, 0x1e6ff),
    (0x2b73a, 0x2b73f), (0x2b81e, 0x2b81e), (0x2cea2, 0x2cead), (0x323b0, 0x33479), (0x3d000, 0x3fc3f),
]
FIRST_UNKNOWN_BYTE = chr(min(UNKNOWN)[0]).encode()[0]
SYMBOL = "\ue000"  # stands for one of these while a text is split


def tokens_of(ranks_file: bytes) -> list[bytes]:
    """The tokens by rank from lines of a token in base 64 and its rank."""
    ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, ranks_file.splitlines())}
    return [ranks[i] for i in range(len(ranks))]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def hashes(data: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """64-bit hashes of pieces that follow one another in ``data``; none is empty."""
    powers = np.full(int(lengths.max()), base, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    return _mix(np.add.reduceat((data + np.uint64(1)) * powers[place], starts))


class PerfectHash:
    """A minimal perfect hash of the tokens: each has a place of its own among as many.

    Tokens are put into buckets by their hash; the buckets, largest first, get the first
    shift that sends all their tokens to free places, single ones a free place at once.
    """

    def __init__(self, tokens: list[bytes]) -> None:
        self.lengths = np.array(list(map(len, tokens)), np.int64)
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.size = np.uint64(len(tokens))
        self.buckets = np.uint64(len(tokens) // BUCKET + 1)
        for base in range(0x1B873593, 0x1B873593 + 64, 2):
            self.base = base
            h = hashes(self.data, self.lengths, base)
            if len(np.unique(h)) == len(h) and self._place(h):
                return
        raise ValueError("no perfect hash found; is a token given twice?")

    def _slots(self, h: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (_mix(h ^ (shift * _ODD)) % self.size).astype(np.int64)

    def _place(self, h: np.ndarray) -> bool:
        bucket = (h % self.buckets).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=int(self.buckets))
        first = np.cumsum(sizes) - sizes
        taken = np.zeros(int(self.size), bool)
        self.shift = np.zeros(int(self.buckets), np.int64)
        self.ids = np.zeros(int(self.size), np.int64)
        singles = []
        for b in np.argsort(-sizes, kind="stable").tolist():
            keys = order[first[b] : first[b] + sizes[b]]
            if len(keys) == 1:
                singles.append((b, int(keys[0])))
                continue
            if not len(keys):
                break
            low = 1
            while True:
                shifts = np.arange(low, low + TRIES, dtype=np.uint64)
                slots = self._slots(h[keys][None, :], shifts[:, None])
                apart = (np.diff(np.sort(slots, axis=1), axis=1) > 0).all(axis=1)
                good = np.flatnonzero(apart & ~taken[slots].any(axis=1))
                if len(good):
                    break
                low += TRIES
                if low > 1 << 20:
                    return False
            self.shift[b] = low + int(good[0])
            taken[slots[good[0]]] = True
            self.ids[slots[good[0]]] = keys
        for (b, key), slot in zip(singles, np.flatnonzero(~taken).tolist()):
            self.shift[b] = -1 - slot
            self.ids[slot] = key
        return True

    def find(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The id of each piece (they follow one another in ``data``), or -1."""
        h = hashes(data, lengths, self.base)
        shift = self.shift[(h % self.buckets).astype(np.int64)]
        slots = np.where(shift < 0, -1 - shift, self._slots(h, shift.astype(np.uint64)))
        ids = self.ids[slots]
        same = self.lengths[ids] == lengths
        if same.any():
            starts, sizes = np.cumsum(lengths) - lengths, lengths[same]
            begin = np.cumsum(sizes) - sizes
            place = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
            equal = data[np.repeat(starts[same], sizes) + place] == self.data[np.repeat(self.starts[ids[same]], sizes) + place]
            same[same] = np.logical_and.reduceat(equal, begin)
        return np.where(same, ids, -1)


class Encoder:
    def __init__(self, tokens: list[bytes], pattern: str, table: PerfectHash) -> None:
        import regex

        self.pattern = regex.compile(pattern)
        self.unknown = regex.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in UNKNOWN) + "]")
        self.table = table
        self.ranks = {token: i for i, token in enumerate(tokens)}
        self.longest = max(map(len, tokens))
        self.memo: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a piece: of all neighbours the pair of least rank is merged, again and again."""
        size, rank_of, longest = len(piece), self.ranks.get, self.longest
        # end[i] is where the part that begins at i ends, 0 once it is part of another.
        end, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, i, i + 2) for i in before[1:] if (r := rank_of(piece[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, stop = heappop(heap)
            middle = end[i]
            if not middle or middle >= size or end[middle] != stop:
                continue  # one of the two has been merged with another
            end[i], end[middle] = stop, 0
            if stop < size:
                before[stop] = i
                last = end[stop]
                if last - i <= longest and (r := rank_of(piece[i:last])) is not None:
                    heappush(heap, (r, i, last))
            first = before[i]
            if first >= 0 and stop - first <= longest and (r := rank_of(piece[first:stop])) is not None:
                heappush(heap, (r, first, stop))
        ids, i = [], 0
        while i < size:
            ids.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def may_have_unknown(self, text: str) -> bool:
        """By the largest byte: that of an unknown character is at least its first one's."""
        return not text.isascii() and np.frombuffer(text.encode(), np.uint8).max() >= FIRST_UNKNOWN_BYTE

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text, in blocks."""
        # Neither splits a text otherwise: a character stands for a character.
        shown = self.unknown.sub(SYMBOL, text) if self.may_have_unknown(text) else text
        if len(text) <= WHOLE_TEXT and shown == text:
            yield self.pattern.findall(text)
            return
        spans = (m.span() for m in self.pattern.finditer(shown))
        while block := [text[a:b] for a, b in islice(spans, BLOCK)]:
            yield block

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of pre-tokens, those in the vocabulary by the hash, the others by merging."""
        joined = "".join(pieces)
        data = np.frombuffer(joined.encode(), np.uint8)
        lengths = np.array(list(map(len, pieces)), np.int64)
        if len(data) != len(joined):
            # From characters to bytes.
            first = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
            lengths = np.diff(first[np.cumsum(lengths)], prepend=0)
        ids = self.table.find(data, lengths)
        whole = ids.astype("<i4").tobytes()
        found = [whole[i : i + 4] for i in range(0, len(whole), 4)]
        for k in np.flatnonzero(ids < 0).tolist():
            found[k] = np.array(self.merged(pieces[k].encode()), "<i4").tobytes()
        return found

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        """The ids of each pre-token as little-endian 32-bit numbers; each is looked up once, while it is remembered."""
        found = list(map(self.memo.get, pieces))
        if None in found:
            missing = {p for p, ids in zip(pieces, found) if ids is None}
            learned = {p: self.before[p] for p in missing if p in self.before}
            new = [p for p in missing if p not in learned]
            if new:
                learned.update(zip(new, self.encode_pieces(new)))
            found = [learned[p] if ids is None else ids for p, ids in zip(pieces, found)]
            if len(self.memo) > MEMO_PIECES:
                # What is used again comes back from those before, the others go with the next turn.
                self.before, self.memo = self.memo, {}
            self.memo.update((p, ids) for p, ids in learned.items() if len(p) <= MEMO_LENGTH)
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        found: list[list[bytes]] = [[] for _ in texts]
        block: list[str] = []
        owners: list[tuple[int, int]] = []

        def flush() -> None:
            ids, at = self.ids_of(block) if block else [], 0
            for k, n in owners:
                found[k].append(b"".join(ids[at : at + n]))
                at += n
            block.clear()
            owners.clear()

        for k, text in enumerate(texts):
            for pieces in self.pieces(text) if text else ():
                block += pieces
                owners.append((k, len(pieces)))
                if len(block) >= BLOCK:
                    flush()
        flush()
        return list(map(b"".join, found))


def _worker(spec) -> tuple[Encoder, list[bytes]]:
    key, tokens, pattern, table = spec.value
    return kept_by_worker(key, lambda: (Encoder(tokens, pattern, table), tokens))


def _spec(docs: DataFrame, ranks_file: bytes, pattern: str):
    tokens = tokens_of(ranks_file)
    key = ("ranked", hashlib.sha256(ranks_file).hexdigest(), pattern)
    return docs.sparkSession.sparkContext.broadcast((key, tokens, pattern, PerfectHash(tokens)))


def _lists(ids: list[bytes]) -> tuple[pa.ListArray, np.ndarray]:
    sizes = np.array(list(map(len, ids)), np.int64) // 4
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    values = np.frombuffer(b"".join(ids), "<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), sizes


def round_trip(docs: DataFrame, ranks_file: bytes, pattern: str, text: str = "text") -> DataFrame:
    """Adds ``ids`` (an array), ``n_tokens`` and the bytes ``decoded`` from the ids.

    ``ranks_file`` is the content of a vocabulary's file; with its perfect hash it is sent to
    the tasks, being of a fixed size. Every single byte must be a token.
    """
    spec = _spec(docs, ranks_file, pattern)

    def make():
        encoder, tokens = _worker(spec)

        def both(batch: pa.RecordBatch) -> list:
            ids, token = encoder.encode(batch.column(text).to_pylist()), tokens.__getitem__
            return [*_lists(ids), [b"".join(map(token, np.frombuffer(i, "<i4").tolist())) for i in ids]]

        return both

    return with_arrow_columns(docs, T.StructType([
        T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()),
        T.StructField("decoded", T.BinaryType()),
    ]), make)


def encode(docs: DataFrame, ranks_file: bytes, pattern: str, text: str = "text") -> DataFrame:
    """Adds ``ids`` (an array) and ``n_tokens``."""
    return round_trip(docs, ranks_file, pattern, text).drop("decoded")


def decode(docs: DataFrame, ranks_file: bytes, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the bytes ``decoded`` of an array of ids; null and empty arrays have none."""
    tokens = docs.sparkSession.sparkContext.broadcast(tokens_of(ranks_file))

    def make():
        token = tokens.value.__getitem__

        def decode_batch(batch: pa.RecordBatch) -> list:
            return [[b"".join(map(token, part or ())) for part in batch.column(ids).to_pylist()]]

        return decode_batch

    return with_arrow_columns(docs, T.StructType([T.StructField(decoded, T.BinaryType())]), make)
