"""Periodic runs of words, found in a grammar of each text.

A run is a stretch of words with smallest period q (words q apart are equal), long
enough, that no neighbouring word extends. Re-Pair replaces the most frequent pair of
neighbouring symbols by a new one until none occurs twice (of equally frequent pairs
the oldest first), which gives a rule ``X -> Y Z`` per pair; what is left is halved
into a tree. Every run crosses the boundary between Y and Z in the least part of the
derivation that contains it. So the runs that cross a boundary are computed once per
rule, in the text of its first occurrence, moved to all places where the rule is
derived, and intervals of one period that overlap by a period are merged: what was cut
off at the ends of a rule is merged into the whole run, which is among them.

Runs of ``MIN_PERIODS`` periods across a boundary have two of these on one side of it,
and two equal groups of ``GRAM`` words about the boundary one period apart. Periods are
taken from the places of such groups inside the rule, tested by hashes of two
neighbouring blocks, and their ends found by comparing words, so results are exact.
Texts where no group of ``GRAM`` words is there three times have no run and need no grammar.

Defined results: null and empty texts have no words and no runs. Repeated rows, and rows
with null ids, are treated like any other. Texts of any length are taken whole. Other
columns are kept; a column with the name of an added one is replaced.
"""

from __future__ import annotations

from collections import Counter
from heapq import heapify, heappop, heappush
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from platewright.llm.arrow import with_arrow_columns

#: A run has at least so many periods and so many words.
MIN_PERIODS, MIN_WORDS = 4, 6
GRAM = 4
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
ADDED = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
    T.StructField("collapsed", T.StringType()),
])
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def re_pair(ids: list[int]) -> tuple[list[tuple[int, int, list[int]]], list[int]]:
    """Rules and what is left of a sequence.

    A rule is the sizes of its two parts and all places where it was put in, that is, where
    it is derived. The rest is given by the places where its symbols begin.
    """
    n = len(ids)
    symbols, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
    counts: dict[tuple[int, int], int] = {p: c for p, c in Counter(zip(ids, ids[1:])).items() if c > 1}
    places: dict[tuple[int, int], list[int]] = {p: [] for p in counts}
    for i, pair in enumerate(zip(ids, ids[1:])):
        if pair in places:
            places[pair].append(i)
    heap = [(-c, age, p) for age, (p, c) in enumerate(counts.items())]
    heapify(heap)
    age, sizes = len(heap), {}
    rules: list[tuple[int, int, list[int]]] = []
    symbol = max(ids, default=0)
    while heap:
        count, _, pair = heappop(heap)
        now = counts[pair]
        if now < 2:
            continue
        if now != -count:
            heappush(heap, (-now, age, pair))
            age += 1
            continue
        a, b = pair
        found, taken = [], -1
        for i in places.pop(pair):
            j = after[i]
            if symbols[i] == a and j < n and symbols[j] == b and i != taken:
                found.append(i)
                taken = j  # of aaa only the first two are a pair
        counts[pair] = 0
        if len(found) < 2:
            continue
        symbol += 1
        left, right = sizes.get(a, 1), sizes.get(b, 1)
        sizes[symbol] = left + right
        rules.append((left, right, found))
        new: dict[tuple[int, int], None] = {}
        for i in found:
            j = after[i]
            h, k = before[i], after[j]
            symbols[i], symbols[j], after[i] = symbol, -1, k
            if h >= 0:
                old = (symbols[h], a)
                if old in counts:
                    counts[old] -= 1
                made = (symbols[h], symbol)
                counts[made] = counts.get(made, 0) + 1
                places.setdefault(made, []).append(h)
                new[made] = None
            if k < n:
                before[k] = i
                old = (b, symbols[k])
                if old in counts:
                    counts[old] -= 1
                made = (symbol, symbols[k])
                counts[made] = counts.get(made, 0) + 1
                places.setdefault(made, []).append(i)
                new[made] = None
        for made in new:
            if counts[made] > 1:
                heappush(heap, (-counts[made], age, made))
                age += 1
            else:
                places.pop(made, None)
                counts[made] = 0
    rest, i = [], 0
    while i < n:
        rest.append(i)
        i = after[i]
    return rules, rest


def grams_of(ids: np.ndarray) -> np.ndarray | None:
    """Numbers of the groups of ``GRAM`` words from each place on, equal where the groups
    are; None where no group is there three times."""
    pairs = ids[:-1] * (int(ids.max()) + 1) + ids[1:]
    distinct, pairs, counts = np.unique(pairs, return_inverse=True, return_counts=True)
    if counts.max() < 3:
        return None
    _, grams, counts = np.unique(pairs[:-2] * len(distinct) + pairs[2:], return_inverse=True, return_counts=True)
    return grams if counts.max() >= 3 else None


class Text:
    """The words of a text as numbers, with their groups and hashes of all beginnings."""

    def __init__(self, ids: np.ndarray, grams: np.ndarray) -> None:
        self.ids, self.grams = ids, grams
        self.order = np.argsort(grams, kind="stable")
        self.rank = np.empty(len(grams), np.int64)
        self.rank[self.order] = np.arange(len(grams))
        self.first = np.searchsorted(grams[self.order], np.arange(int(grams.max()) + 2))
        self.powers = np.full(len(ids) + 1, _BASE, np.uint64)
        self.powers[0] = 1
        np.multiply.accumulate(self.powers, out=self.powers)
        values = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
        values ^= values >> np.uint64(31)
        self.sums = np.zeros(len(ids) + 1, np.uint64)
        np.cumsum(values * self.powers[:-1], out=self.sums[1:])

    def twice(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether the ``q`` words from ``at`` on come again right after; by hashes, so a yes may be wrong."""
        middle = self.sums[at + q]
        return (middle - self.sums[at]) * self.powers[q] == self.sums[at + 2 * q] - middle

    def with_gram_again(self, low: np.ndarray, middle: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Parts in which one of the two groups about the boundary stands in another place too."""
        some = np.zeros(len(low), bool)
        for at in (middle - 1, middle - GRAM + 1):
            inside = np.flatnonzero((at >= low) & (at + GRAM <= high))
            rank = self.rank[at[inside]]
            gram = self.grams[at[inside]]
            for step in (-1, 1):
                near = np.clip(rank + step, 0, len(self.order) - 1)
                place = self.order[near]
                there = (near != rank) & (self.grams[place] == gram)
                there &= (place >= low[inside]) & (place + GRAM <= high[inside])
                some[inside[there]] = True
        return some

    def periods(self, low: int, middle: int, high: int) -> np.ndarray:
        """Distances of the groups about a boundary to their other places in ``low..high``."""
        found = []
        for at in (middle - 1, middle - GRAM + 1):
            if at >= low and at + GRAM <= high:
                gram = self.grams[at]
                places = self.order[self.first[gram] : self.first[gram + 1]]
                ends = np.searchsorted(places, [low, high - GRAM + 1])
                found.append(np.abs(places[ends[0] : ends[1]] - at))
        q = np.unique(np.concatenate(found))
        return q[(q > 0) & (q * MIN_PERIODS <= high - low)]

    def forward(self, at: int, q: int, high: int) -> int:
        """The end of the period ``q`` that holds up to ``at + q``, in what ends at ``high``."""
        step = 64
        while at + q < high:
            stop = min(at + step, high - q)
            differ = self.ids[at:stop] != self.ids[at + q : stop + q]
            if differ.any():
                return at + q + int(differ.argmax())
            at, step = stop, step * 4
        return high

    def backward(self, at: int, q: int, low: int) -> int:
        """The start of the period ``q`` that holds from ``at`` on, in what starts at ``low``."""
        step = 64
        while at > low:
            start = max(at - step, low)
            differ = self.ids[start:at] != self.ids[start + q : at + q]
            if differ.any():
                return at - int(differ[::-1].argmax())
            at, step = start, step * 4
        return low

    def crossing(self, low: int, middle: int, high: int) -> list[tuple[int, int, int]]:
        """``(start, end, period)`` of the runs in ``low..high`` that cross ``middle``."""
        q = self.periods(low, middle, high)
        right = q[middle + 2 * q <= high]
        left = q[middle - 2 * q >= low]
        found: dict[tuple[int, int], int] = {}
        pairs = [(p, middle) for p in right[self.twice(np.full(len(right), middle), right)].tolist()]
        pairs += [(p, middle - 2 * p) for p in left[self.twice(middle - 2 * left, left)].tolist()]
        for p, at in sorted(pairs):
            if any(p % r == 0 and a <= at and at + 2 * p <= b for (a, b), r in found.items()):
                continue  # a multiple of the period of a run already found
            if not np.array_equal(self.ids[at : at + p], self.ids[at + p : at + 2 * p]):
                continue
            start, end = self.backward(at, p, low), self.forward(at + p, p, high)
            if start < middle < end and end - start >= max(MIN_WORDS, MIN_PERIODS * p):
                found[start, end] = min(p, found.get((start, end), p))
        return [(a, b, p) for (a, b), p in found.items()]


def halves(rest: list[int], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, boundary and end of the inner nodes of a balanced tree over symbols."""
    edges, step = np.array([*rest, n], np.int64), 1
    low, middle, high = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while step < len(rest):
        at = np.arange(0, len(rest) - step, 2 * step)
        low.append(edges[at])
        middle.append(edges[at + step])
        high.append(edges[np.minimum(at + 2 * step, len(rest))])
        step *= 2
    return np.concatenate(low), np.concatenate(middle), np.concatenate(high)


def merged(starts: np.ndarray, ends: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """Intervals of one period that overlap by it are one; rows of start, length and period."""
    order = np.lexsort((starts, periods))
    starts, ends, periods = starts[order], ends[order], periods[order]
    # Intervals of different periods are kept apart by what is added to them.
    group = np.cumsum(np.diff(periods, prepend=periods[:1]) != 0) * (int(ends.max()) + int(periods.max()) + 1)
    reach = np.maximum.accumulate(ends + group)
    first = np.ones(len(starts), bool)
    first[1:] = (starts + group)[1:] + periods[1:] > reach[:-1]
    at = np.flatnonzero(first)
    ends = np.maximum.reduceat(ends, at)
    rows = np.stack([starts[at], ends - starts[at], periods[at]], axis=1)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def runs_of(words: list) -> np.ndarray:
    """Start, length and period of all runs, by start and period."""
    none = np.empty((0, 3), np.int64)
    number: dict = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    if len(ids) < MIN_WORDS or len(ids) - len(number) < MIN_WORDS - 1:
        return none
    array = np.array(ids, np.int64)
    grams = grams_of(array)
    if grams is None:
        return none
    text = Text(array, grams)
    rules, rest = re_pair(ids)
    at = np.array([found[0] for _, _, found in rules], np.int64)
    left, right = (np.array([r[k] for r in rules], np.int64) for k in (0, 1))
    low, middle, high = halves(rest, len(ids))
    low, middle, high = np.append(at, low), np.append(at + left, middle), np.append(at + left + right, high)
    starts, ends, periods = [], [], []
    for k in np.flatnonzero((high - low >= MIN_WORDS) & text.with_gram_again(low, middle, high)).tolist():
        own = int(low[k])
        places = np.array(rules[k][2] if k < len(rules) else [own], np.int64)
        for start, end, period in text.crossing(own, int(middle[k]), int(high[k])):
            starts.append(places + (start - own))
            ends.append(places + (end - own))
            periods.append(np.full(len(places), period))
    return merged(*map(np.concatenate, (starts, ends, periods))) if starts else none


def kept_words(words: list, runs: np.ndarray) -> list:
    """Words that no run contains after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return list(compress(words, (np.cumsum(change[:-1]) == 0).tolist()))


def with_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_words``, the ``runs`` (start, length and period in words, by start and
    period), and ``collapsed``, the text with only the first period of every run."""

    def make():
        def batch_runs(batch: pa.RecordBatch) -> list:
            sizes, found, collapsed = [], [], []
            for value in batch.column(text).to_pylist():
                words = value.encode().split() if value else []
                runs = runs_of(words)
                sizes.append(len(words))
                found.append([dict(zip(RUN.names, r)) for r in runs.tolist()])
                collapsed.append(b" ".join(kept_words(words, runs) if len(runs) else words).decode())
            return [sizes, found, collapsed]

        return batch_runs

    return with_arrow_columns(docs, ADDED, make)
