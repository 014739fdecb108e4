"""Training passages that copy items of a benchmark, also edited or paraphrased ones.

The n-grams of the items are counted over the whole corpus. An item's seeds are its
rarest n-grams of those that occur: all but as many of the most frequent ones as a
passage of the least score with at most one edit in ``EDITS`` words has besides one
more. So such a passage has a seed, and n-grams that stand all over the corpus pair few
items with it. Seeds are joined to the corpus's n-grams. A passage with a seed of an item
is a candidate if it has enough of the item's words to reach the least score in any
order, and Smith-Waterman alignment of its words with the item's gives the score: 1 for
the whole item word by word, less for edits and missing parts. Passages of one item and
document don't overlap.

The corpus is read three times whatever the number of items: to count, to find the
seeds, and to align. Tasks leave out n-grams by a bit map of ``BITS`` address bits, all
that goes through the driver; the joins after it are exact. Items and documents go by
hashes of their texts up to the alignment, so copies of either are matched once. Seeds
and candidates are broadcast if they are few (by their bytes), and shuffled if not;
documents are shuffled only in the latter case, those without a candidate left out by
then where Spark's Bloom filters apply. A document with many candidates is cut into
parts by item.

Words are lower-cased (A-Z) runs without ASCII white space and punctuation, compared
by 64-bit hashes. Defined results: null and empty texts match nothing; items with
fewer than ``n`` words are not looked for; repeated items and documents each give
their rows; a null id stays null in the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewright.llm.arrow import small_batches, with_arrow_columns
from platewright.llm.words import LAST, PUNCTUATION, SPACES, grams, hashed, separator
from platewright.operators.joins import is_small
from platewright.session import shared_folder

NGRAM, MIN_SCORE = 3, 0.5
#: Words to an edit in a passage that must have a seed.
EDITS = 4
MATCH, MISMATCH, GAP = 2, -1, -1
#: Cells of an alignment matrix row for all candidates aligned at once.
CELLS = 1 << 18
#: Words of candidates counted at once, and n-grams counted by a task before they are handed on.
COUNTED = 1 << 20
#: Candidates of a document in a part of it.
PART = 1024
SEPARATOR = separator(SPACES + PUNCTUATION)
#: Address bits of the bit map of n-grams: 8 MB, whatever the number of items.
BITS = 26


def surviving(n: int = NGRAM, min_score: float = MIN_SCORE, edits: int = EDITS) -> tuple[float, int]:
    """``share`` and ``less``: a passage of the least score with at most one edit in
    ``edits`` words has ``share * words - less`` or more n-grams of an item unbroken.

    ``L`` aligned words of the item's ``m``, ``e`` of them edited, score at most ``2 (L - e) - e`` of
    ``2 m`` and leave ``L - (n - 1) - n e`` n-grams. With ``e`` at most ``L / edits`` that is least for the
    shortest such ``L``, if one edit breaks fewer than ``edits`` n-grams, else there is none left.
    """
    lost = 1 / edits
    shortest = min_score * MATCH / (MATCH - (MATCH - MISMATCH) * lost)
    return max(0.0, shortest * (1 - n * lost)), n - 1


class Items:
    """Words of some items one after another, their different words and how often each has them."""

    def __init__(self, words: list[np.ndarray]) -> None:
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.starts = np.r_[0, np.cumsum(self.lengths)]
        self.words = np.concatenate(words)
        self.known, word = np.unique(self.words, return_inverse=True)
        item = np.repeat(np.arange(len(words)), self.lengths)
        self.own, self.times = np.unique(item * len(self.known) + word, return_counts=True)

    def places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that some item has, and their numbers among the different ones."""
        number = np.minimum(np.searchsorted(self.known, words), len(self.known) - 1)
        at = np.flatnonzero(self.known[number] == words)
        return at, number[at]


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The best Smith-Waterman score of each item in its window, and where it ends there."""
    height, width = max(map(len, items)), max(map(len, windows))
    # Padding equals nothing: two different values that no word has beside them in a row.
    item = np.full((len(items), height), LAST)
    window = np.full((len(items), width), LAST - np.uint64(1))
    for n, (x, y) in enumerate(zip(items, windows)):
        item[n, : len(x)] = x
        window[n, : len(y)] = y
    slope = np.arange(width, dtype=np.int32) * -GAP
    row = np.zeros((len(items), width), np.int32)
    best = np.zeros(len(items), np.int32)
    end = np.zeros(len(items), np.int64)
    for i in range(height):
        step = np.where(window == item[:, i : i + 1], MATCH, MISMATCH).astype(np.int32)
        step[:, 1:] += row[:, :-1]
        new = np.maximum(np.maximum(step, row + GAP), 0)
        row = np.maximum.accumulate(new + slope, axis=1) - slope
        top = row.max(axis=1)
        better = top > best
        end[better] = row[better].argmax(axis=1)
        best = np.maximum(best, top)
    return best, end


def promising(index: Items, words: np.ndarray, starts: np.ndarray, found: np.ndarray, min_score: float) -> np.ndarray:
    """``item, doc, low, high`` (words of all texts): the windows with as many of the item's
    words as the least score takes. Those that overlap are one."""
    item, doc, low, high = found
    low = np.maximum(starts[doc] + low, starts[doc])
    high = np.minimum(starts[doc] + high, starts[doc + 1])
    at, word = index.places(words)
    first, last = np.searchsorted(at, low), np.searchsorted(at, high)
    need = np.ceil(min_score * index.lengths[item] - 1e-9)
    enough = last - first >= need
    ends = np.cumsum(np.where(enough, last - first, 0))
    begin = 0
    while begin < len(item):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + COUNTED, "right")))
        some = begin + np.flatnonzero(enough[begin:end])
        size = last[some] - first[some]
        window = np.repeat(np.arange(len(some)), size)
        place = np.arange(len(window)) - np.repeat(np.cumsum(size) - size, size) + first[some][window]
        key = item[some][window] * len(index.known) + word[place]
        number = np.minimum(np.searchsorted(index.own, key), len(index.own) - 1)
        hit = index.own[number] == key
        pair, times = np.unique(window[hit] * len(index.own) + number[hit], return_counts=True)
        common = np.bincount(pair // len(index.own), np.minimum(times, index.times[pair % len(index.own)]), len(some))
        enough[some] = common >= need[some]
        begin = end
    item, doc, low, high = item[enough], doc[enough], low[enough], high[enough]
    if not len(item):
        return np.empty((4, 0), np.int64)
    order = np.lexsort((low, item, doc))
    item, doc, low, high = item[order], doc[order], low[order], high[order]
    group = np.cumsum(np.r_[True, (item[1:] != item[:-1]) | (doc[1:] != doc[:-1])])
    far = len(words) + 1
    end = np.maximum.accumulate(high + group * far) - group * far
    at = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (low[1:] >= end[:-1])])
    return np.stack([item[at], doc[at], low[at], end[np.r_[at[1:] - 1, len(end) - 1]]])


def scores(index: Items, words: np.ndarray, starts: np.ndarray, found: np.ndarray, min_score: float) -> Iterator[tuple]:
    """``item, doc, score, first word, last word`` of each passage with the least score: the
    best of a window, and then those of what is left before and after it."""
    while found.shape[1]:
        item, doc, low, high = found
        order = np.argsort(high - low, kind="stable")
        at, rest = 0, [np.empty((4, 0), np.int64)]
        while at < len(order):
            width = 1 + int((high - low)[order[at]])
            part = order[at : at + max(1, CELLS // (2 * width))]
            part = part[(high - low)[part] <= max(2 * width, 64)]
            at += len(part)
            items = [index.words[index.starts[i] : index.starts[i + 1]] for i in item[part]]
            best, end = align(items, [words[a:b] for a, b in zip(low[part], high[part])])
            size = index.lengths[item[part]]
            score = best / (MATCH * size)
            good = (best > 0) & (score >= min_score)
            part, end, size = part[good], end[good], size[good]
            last = low[part] + end
            first = np.maximum(starts[doc[part]], last - size + 1)
            yield item[part], doc[part], score[good], first - starts[doc[part]], last - starts[doc[part]]
            rest += [np.stack([item[part], doc[part], low[part], first]),
                     np.stack([item[part], doc[part], last + 1, high[part]])]
        found = np.concatenate(rest, axis=1)
        found = found[:, found[3] - found[2] >= np.maximum(1, min_score * index.lengths[found[0]])]


def contaminated(docs: DataFrame, items: DataFrame, n: int = NGRAM, min_score: float = MIN_SCORE,
                 doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
                 edits: int = EDITS, max_broadcast: int = 64 << 20) -> DataFrame:
    """``doc_id``, ``item_id``, ``score``, ``first_word`` and ``last_word`` of every
    passage that scores ``min_score`` or more. The place is that of the alignment's last
    word, and the item's length before it."""
    shared_folder(docs.sparkSession)
    own = small_batches(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL"))
    listed = items.select(F.col(item_id).alias("item_id"), F.xxhash64(item_text).alias("item"), F.col(item_text).alias("text"))
    listed = with_item_words(listed.where("text IS NOT NULL"), n).where("size(grams) > 0").checkpoint()
    known = listed.dropDuplicates(["item"])
    places = known.select("item", F.size("words").alias("size"), F.posexplode("grams").alias("at", "h"))
    seeds = rare_seeds(places, own, n, min_score, edits).checkpoint()

    def some(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if is_small(df, max_broadcast) else df

    hits = corpus_grams(own, bit_map(seeds.select("h")), n, "key long, place int, h long", _hits)
    found = hits.join(some(seeds), "h").select("key", "item", "size", (F.col("place") - F.col("at")).alias("begin"))
    pairs = windows(found.distinct()).join(some(known.select("item", "words")), "item")
    parts = F.ceil(F.count("*").over(Window.partitionBy("key")) / PART)
    pairs = pairs.withColumn("part", F.pmod("item", parts)).groupBy("key", "part").agg(
        F.collect_list(F.struct("item", "words", "windows")).alias("candidates")).drop("part").checkpoint()

    matches = own.withColumn("key", F.xxhash64("text")).join(some(pairs), "key")
    schema = T.StructType([
        T.StructField("doc_id", own.schema["doc_id"].dataType), T.StructField("item", T.LongType()),
        T.StructField("score", T.DoubleType()), T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
    ])
    passages = matches.select("doc_id", "text", "candidates").mapInArrow(_matcher(min_score), schema)
    return passages.join(some(listed.select("item_id", "item")), "item").select(
        "doc_id", "item_id", "score", "first_word", "last_word")


def with_item_words(items: DataFrame, n: int) -> DataFrame:
    """``items`` without ``text``, with hashes of its ``words`` and its ``grams`` in order."""

    def make():
        def split(batch: pa.RecordBatch) -> list:
            words, found = [], []
            for _, _, own, starts in hashed(batch.column("text"), SEPARATOR):
                of = grams(own, starts, n).view(np.int64)
                for a, b in zip(starts[:-1], starts[1:]):
                    words.append(own[a:b].view(np.int64))
                    found.append(of[a : max(a, b - n + 1)])
            return [words, found]

        return split

    longs = T.ArrayType(T.LongType())
    added = T.StructType([T.StructField("words", longs), T.StructField("grams", longs)])
    return with_arrow_columns(items, added, make).drop("text")


def rare_seeds(places: DataFrame, own: DataFrame, n: int, min_score: float, edits: int) -> DataFrame:
    """Of the places of n-grams in items (``item, size, at, h``) those that are seeds."""
    counts = corpus_grams(own, bit_map(places.select("h")), n, "h long, n long", _counts)
    counts = counts.groupBy("h").agg(F.sum("n").alias("n"))
    found = places.join(counts, "h")
    share, less = surviving(n, min_score, edits)
    # One of those that a passage has must stay, so one fewer than these may go.
    spared = F.greatest(F.lit(0), F.ceil(F.col("size") * share - less - 1e-9) - 1)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("n"), "h", "at"))
    return found.withColumn("rank", rank).where(F.col("rank") > spared).select("h", "item", "size", "at")


def bit_map(hashes: DataFrame) -> np.ndarray:
    """A bit per value of the first ``BITS`` bits of the hashes: a row of 64 each comes to the driver."""
    address = F.shiftrightunsigned("h", 64 - BITS)
    rows = hashes.groupBy(F.shiftright(address, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(h, %d) & 63 as int))" % (64 - BITS))).alias("bits"))
    found = rows.toArrow()
    bits = np.zeros(1 << (BITS - 6), np.int64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return bits.view(np.uint8)


def corpus_grams(own: DataFrame, bits: np.ndarray, n: int, schema: str, handed_on) -> DataFrame:
    """What ``handed_on`` makes of the n-grams that the bit map lets through."""
    sent = own.sparkSession.sparkContext.broadcast(bits)

    def through(batches):
        bits = sent.value

        def parts():
            for batch in batches:
                for low, high, words, starts in hashed(batch.column("text"), SEPARATOR):
                    found = grams(words, starts, n)
                    address = found >> np.uint64(64 - BITS)
                    at = np.flatnonzero(bits[address >> np.uint64(3)] >> (address & np.uint64(7)).astype(np.uint8) & 1)
                    at = at[found[at] != LAST]
                    doc = np.searchsorted(starts, at, "right") - 1
                    yield batch.column("key").to_numpy()[low:high][doc], at - starts[doc], found[at].view(np.int64)

        for arrays in handed_on(parts()):
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=[c.split()[0] for c in schema.split(", ")])

    return own.select(F.xxhash64("text").alias("key"), "text").mapInArrow(through, schema)


def _hits(parts: Iterator[tuple]) -> Iterator[tuple]:
    for key, place, h in parts:
        yield key, place.astype(np.int32), h


def _counts(parts: Iterator[tuple]) -> Iterator[tuple]:
    held, size = [], 0
    for _, _, h in parts:
        held.append(h)
        size += len(h)
        if size > COUNTED:
            yield np.unique(np.concatenate(held), return_counts=True)
            held, size = [], 0
    if size:
        yield np.unique(np.concatenate(held), return_counts=True)


def windows(found: DataFrame) -> DataFrame:
    """``key``, ``item`` and ``windows`` (``low`` and ``high``, words of the document): stretches
    where an item (of ``size`` words) may lie, by where its seeds say that it begins."""
    slack = 4 + F.shiftright("size", 2)
    order = Window.partitionBy("key", "item").orderBy("begin")
    new = F.coalesce(F.col("begin") - F.lag("begin").over(order) > slack, F.lit(True)).cast("int")
    found = found.repartition("key").withColumn("new", new).withColumn("n", F.sum("new").over(order))
    each = found.groupBy("key", "item", "n").agg(
        (F.min("begin") - F.first(slack)).cast("long").alias("low"),
        (F.max("begin") + F.first(F.col("size") + slack)).cast("long").alias("high"))
    return each.groupBy("key", "item").agg(F.collect_list(F.struct("low", "high")).alias("windows"))


def _matcher(min_score: float):
    def match(batches):
        for batch in batches:
            ids, candidates = batch.column("doc_id"), batch.column("candidates")
            first = candidates.offsets.to_numpy() - candidates.offsets[0].as_py()
            pairs = candidates.flatten()
            item_words, spans = pairs.field("words"), pairs.field("windows")
            items = pairs.field("item").to_numpy()
            cuts, ends = spans.offsets.to_numpy() - spans.offsets[0].as_py(), spans.flatten()
            low, high = ends.field("low").to_numpy(), ends.field("high").to_numpy()
            word_cuts = item_words.offsets.to_numpy() - item_words.offsets[0].as_py()
            flat = item_words.flatten().to_numpy().view(np.uint64)
            for start, stop, words, starts in hashed(batch.column("text"), SEPARATOR):
                a, b = first[start], first[stop]
                index = Items([flat[word_cuts[k] : word_cuts[k + 1]] for k in range(a, b)])
                pair = np.repeat(np.arange(b - a), np.diff(cuts[a : b + 1]))
                doc = np.searchsorted(first[start : stop + 1], pair + a, "right") - 1
                found = np.stack([pair, doc, low[cuts[a] : cuts[b]], high[cuts[a] : cuts[b]]])
                found = promising(index, words, starts, found, min_score)
                for pair, doc, score, begin, last in scores(index, words, starts, found, min_score):
                    if len(pair):
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array(start + doc)), pa.array(items[a + pair]),
                             pa.array(score), pa.array(begin), pa.array(last)],
                            names=["doc_id", "item", "score", "first_word", "last_word"],
                        )

    return match


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without those that have a contaminated passage. Rows without an id stay."""
    found = contaminated(docs, items, doc_id=doc_id, **options)
    bad = found.select(F.col("doc_id").alias(doc_id)).where(F.col(doc_id).isNotNull()).distinct()
    return docs.join(bad, doc_id, "left_anti")
