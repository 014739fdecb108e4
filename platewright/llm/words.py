"""Words of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = bytes([0x20, *range(0x09, 0x0E)])
PUNCTUATION = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
#: Bytes of text that are hashed at once, whole texts each time.
CHUNK_BYTES = 1 << 20
LAST = np.uint64(0xFFFF_FFFF_FFFF_FFFF)
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)


def _fold() -> np.ndarray:
    table = np.arange(256, dtype=np.uint64)
    table[ord("A") : ord("Z") + 1] += 32
    return table + np.uint64(1)


LOWER = _fold()


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def separator(characters: bytes = SPACES) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


def _powers(n: int) -> np.ndarray:
    table = np.full(n, _BASE, np.uint64)
    table[:1] = 1
    return np.multiply.accumulate(table)


def hash_words(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts ``data[offsets[i]:offsets[i + 1]]``, A-Z in lower
    case, and where each text's words begin."""
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~sep[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[offsets < len(data)]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    lengths = np.diff(starts, append=len(data))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    values = LOWER[data[starts[0] :]]
    values[~inside[starts[0] :]] = 0
    values *= _powers(int(lengths.max()))[place]
    hashes = mix(np.add.reduceat(values, starts - starts[0]))
    return np.where(hashes == LAST, np.uint64(0), hashes), np.searchsorted(starts, offsets)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column of texts; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), offsets


def hashed(column: pa.Array, sep: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts ``low`` to ``high`` of a column with the hashes of their words and the
    places where each text's words begin (one more than texts)."""
    data, offsets = texts(column)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + CHUNK_BYTES, "right")) - 1)
        part = offsets[low : high + 1]
        yield low, high, *hash_words(data[part[0] : part[-1]], part - part[0], sep)
        low = high


def grams(hashes: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """A hash of the ``n`` words from each place on; ``LAST`` where a text has fewer."""
    out = np.full(len(hashes), LAST)
    size = len(hashes) - n + 1
    if size > 0:
        total = np.zeros(size, np.uint64)
        for j, p in enumerate(_powers(n + 1)[1:]):
            total += hashes[j : j + size] * p
        total = mix(total)
        out[:size] = np.where(total == LAST, np.uint64(0), total)
    for end, begin in zip(offsets[1:], offsets[:-1]):
        out[max(int(begin), int(end) - n + 1) : end] = LAST
    return out
