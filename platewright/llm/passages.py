"""Passages that documents share, word by word or with edits, by collinear chaining.

Seeds are runs of ``K`` words; of every ``W`` runs in a row the one with the least hash
is taken, so two documents that share ``K + W - 1`` words share a seed. Equal seeds are
matches. Matches of two documents that overlap on one diagonal are a block, and blocks in
the same order in both documents are chained: a Fenwick tree over the places in one
document gives each block its best predecessor, at a cost for the gap. A chain whose blocks
alone make up enough of it is a passage; any other is aligned word by word between its
blocks and beyond its ends, and each part of it with enough equal words is a passage.

A seed that occurs up to ``RARE`` times matches all its occurrences. One that occurs
more often matches each with its first occurrence, and the ``LONG`` words that begin with
it are a seed of their own, matched with the first occurrence of these. Occurrences in
passages with one and the same earlier place that has the seed are of one kind, which stands
for the links between them: groups of copies need no pairs of all with all. All
occurrences of different kinds are then compared, in tiles, by the words around them, and
matched if a passage can hold both: ``AROUND`` words can be aligned, some of them four in
a row apart from the run that holds the seed, or the run alone has ``MIN_WORDS``. What
documents so matched have in common is chained anew. The number of tiles of a seed grows
with the square of its occurrences beyond ``TILE``; what a tile holds is bounded.

Words are lower-cased (A-Z) runs without ASCII white space, compared by hashes of 64 bits
(32 in alignments). Passages have ``MIN_WORDS`` words or more in both documents, of which
``IDENTITY`` are equal.

Defined results: null and empty texts, documents without an id and texts with fewer than
``MIN_WORDS`` words share nothing. Rows with one id are one document, so repeated rows
add nothing. Repeats within a document don't count. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewright.llm.arrow import small_batches
from platewright.llm.words import LAST, SPACES, grams, hashed, mix, separator
from platewright.session import checkpointed, shared_folder

K, W, LONG, RARE = 8, 7, 48, 8
MIN_WORDS, IDENTITY = 50, 0.8
#: Words that a chain's blocks need, the cost of a word of gap, words looked at beyond its ends.
CHAIN_WORDS, GAP_COST, MARGIN = 8, 0.2, 64
#: Gaps up to so many words on each side are aligned by a matrix, longer ones along their diagonal.
MATRIX = 256
#: Words before and after the beginning of a frequent seed that are compared, and how many must be in common.
BEFORE, AFTER, AROUND = 50, 58, 40
#: Occurrences that a side of a tile has on average, pairs made at once, bits of a set of words.
TILE, PAIRS, BITS = 4096, 1 << 21, 2048
#: Occurrences from which on all pairs of a group are gone through if that is less than the pairs its words lead to.
THROUGH = 64
SEPARATOR = separator(SPACES)


def chosen(hashes: np.ndarray, w: int) -> np.ndarray:
    """Places of the least hash of every ``w`` in a row. ``LAST`` is no hash; at least
    ``w - 1`` of them part the texts."""
    padded = np.concatenate([np.full(w - 1, LAST), hashes, np.full(w - 1, LAST)])
    size = len(padded) - w + 1
    least = padded[:size].copy()
    for j in range(1, w):
        np.minimum(least, padded[j : j + size], out=least)
    best = least[:-(w - 1) or None].copy()
    for j in range(1, w):
        np.maximum(best, least[j : j + len(best)], out=best)
    return np.flatnonzero((hashes == best[: len(hashes)]) & (hashes != LAST))


def runs(hashes: np.ndarray, at: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place (in ``at``), words and step of each run of equal seeds in equal steps.

    Text with a period repeats one seed all along; it is one run, not a seed per step.
    """
    step = np.diff(at, prepend=at[:1])
    same = np.r_[False, (hashes[at[1:]] == hashes[at[:-1]]) & (text[1:] == text[:-1]) & (step[1:] <= W)]
    other = np.r_[False, same[1:] & same[:-1] & (step[1:] != step[:-1])]
    first = np.flatnonzero(~same | other)
    last = np.r_[first[1:], len(at)] - 1
    return first, at[last] - at[first] + K, np.where(last > first, step[np.minimum(first + 1, len(at) - 1)], 0)


def seeds(docs: DataFrame) -> DataFrame:
    """``h``, ``doc``, ``place`` (the first word, the words and the step of a run, packed) and
    ``long`` (32 bits of the hash of ``LONG`` words, or -1) of ``doc`` and ``text``."""

    def make(batches):
        for batch in batches:
            ids = batch.column("doc").to_numpy()
            for low, _, words, starts in hashed(batch.column("text"), SEPARATOR):
                short = grams(words, starts, K)
                at = chosen(short, W)
                if not len(at):
                    continue
                text = np.searchsorted(starts, at, "right") - 1
                first, size, step = runs(short, at, text)
                at, text = at[first], text[first]
                place = (at - starts[text]) << 32 | np.minimum(size, (1 << 26) - 1) << 6 | step
                long = (grams(words, starts, LONG)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(short[at].view(np.int64)), pa.array(ids[low + text]), pa.array(place), pa.array(long)],
                    names=["h", "doc", "place", "long"])

    return docs.mapInArrow(make, "h long, doc long, place long, long int")


def _columns(batch: pa.RecordBatch, *names: str) -> np.ndarray:
    return np.stack([batch.column(n).to_numpy().astype(np.int64) for n in names])


def matches(found: DataFrame, rare: int = RARE) -> DataFrame:
    """``a``, ``b``, ``pa``, ``pb``, ``size``: equal words of documents ``a`` < ``b``, with ``h`` and
    ``run`` (words of the run in ``b``) of a frequent seed, else 0. Its first occurrence is there with itself."""
    every = checkpointed(_seed_matches(found, rare))
    # -1 marks rare seeds, and frequent ones with too few words behind them.
    frequent = every.where("long <> -1").select("h", "long", F.col("b").alias("doc"), F.col("pb").alias("pos"))
    firsts = frequent.groupBy("h", "long").agg(F.min(F.struct("doc", "pos")).alias("first"))
    far = frequent.join(firsts, ["h", "long"]).where("doc <> first.doc").select(
        F.col("first.doc").alias("a"), F.col("doc").alias("b"), F.col("first.pos").alias("pa"),
        F.col("pos").alias("pb"), F.lit(LONG).cast("long").alias("size"), F.lit(0).cast("long").alias("h"),
        F.lit(0).cast("long").alias("run"))
    return every.drop("long").unionByName(far)


def _seed_matches(found: DataFrame, rare: int) -> DataFrame:
    """Matches by short seeds, ``h`` and ``long`` being the seeds of ``b`` where the short one
    is frequent; the first occurrence of a frequent one is matched with itself."""
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.repartition(n, "h").sortWithinPartitions("h", "doc", "place")
    names = ["a", "b", "pa", "pb", "size", "h", "long", "run"]
    empty = np.empty((len(names), 0), np.int64)

    def matched(rows: np.ndarray, x: np.ndarray, y: np.ndarray, frequent: bool) -> np.ndarray:
        size = [(rows[2, at] >> 6) & (1 << 26) - 1 for at in (x, y)]
        step = [rows[2, at] & 63 for at in (x, y)]
        none = np.zeros(len(y), np.int64)
        marks = (rows[0, y], rows[3, y], size[1]) if frequent else (none, none - 1, none)
        size = np.where((step[0] > 0) & (step[0] == step[1]), np.minimum(*size), K)
        return np.stack([rows[1, x], rows[1, y], rows[2, x] >> 32, rows[2, y] >> 32, size, *marks])

    def of_groups(rows: np.ndarray, hot: int | None) -> np.ndarray:
        """Matches of whole groups, and of the group ``hot`` beyond its first row."""
        first = np.flatnonzero(np.r_[True, rows[0, 1:] != rows[0, :-1]])
        sizes = np.diff(first, append=rows.shape[1])
        group = np.repeat(np.arange(len(first)), sizes)
        frequent = (sizes > rare) | (rows[0, first] == hot if hot is not None else False)
        out = [empty]
        few = ~frequent[group]
        for lag in range(1, rare):
            at = np.flatnonzero((group[lag:] == group[:-lag]) & few[lag:])
            at = at[rows[1, at] != rows[1, at + lag]]
            if len(at):
                out.append(matched(rows, at, at + lag, False))
            elif not (sizes > lag).any():
                break
        at = np.flatnonzero(frequent[group])
        if hot is not None and rows[0, 0] == hot:
            at = at[at > 0]
        if len(at):
            out.append(matched(rows, first[group[at]], at, True))
        return np.concatenate(out, axis=1)

    def run(batches):
        kept, hot = np.empty((4, 0), np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.hstack([kept, _columns(batch, "h", "doc", "place", "long")])
            begin = np.flatnonzero(np.r_[True, rows[0, 1:] != rows[0, :-1]])[-1]
            if begin:
                yield from emit(of_groups(rows[:, :begin], hot))
                rows, hot = rows[:, begin:], None
            if rows.shape[1] > rare or hot is not None:
                # A frequent seed goes on into the next batch: its first row stays.
                yield from emit(of_groups(rows, hot))
                kept, hot = rows[:, :1], rows[0, 0]
            else:
                kept = rows
        if kept.shape[1] and hot is None:
            yield from emit(of_groups(kept, None))

    def emit(m: np.ndarray):
        if m.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in m], names=names)

    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def classes(every: DataFrame, passages: DataFrame) -> DataFrame:
    """``h``, ``doc``, ``pos``, ``kind`` and ``tiles`` of the occurrences of those frequent seeds that have several
    kinds. An occurrence in passages with earlier documents that have the seed there is of the kind of the
    first such place; any other is of its own kind."""
    seen = every.where("h <> 0").select("h", F.col("b").alias("doc"), F.col("pb").alias("pos"), "run")
    spans = passages.select("a", F.col("b").alias("doc"), "a0", "a1", "b0", "b1")
    inside = seen.join(spans, "doc").where(f"b0 <= pos AND pos + {K} <= b1").select(
        "h", "doc", "pos", "a", "a0", "a1", F.expr("a0 + pos - b0").alias("at"))
    there = inside.join(seen.select("h", F.col("doc").alias("a"), F.col("pos").alias("p")), ["h", "a"])
    there = there.where(f"a0 <= p AND p + {K} <= a1").groupBy("h", "doc", "pos").agg(
        F.min(F.struct("a", F.abs(F.col("p") - F.col("at")).alias("off"), "p")).alias("of"))
    marked = checkpointed(seen.join(there, ["h", "doc", "pos"], "left").select(
        "h", "doc", F.explode(F.array_distinct(F.array("pos", F.expr(f"pos + greatest(run, {K}) - {K}")))).alias("pos"),
        F.expr("xxhash64(coalesce(of.a, doc), coalesce(of.p, pos))").alias("kind")))
    left = marked.groupBy("h").agg(F.count("*").alias("n"), F.min("kind").alias("least"), F.max("kind").alias("most"))
    left = left.where("least <> most").select("h", F.expr(f"cast(ceil(n / {TILE}) as int)").alias("tiles"))
    return marked.join(left, "h")


def surroundings(places: DataFrame, own: DataFrame) -> DataFrame:
    """``h``, ``doc``, ``pos``, ``kind``, ``tiles`` and ``words`` (16 bits of the hash of each word from
    ``BEFORE`` words before the seed to ``AFTER`` words after its beginning; 0 where the text has none)."""
    wanted = places.groupBy("doc").agg(F.collect_list(F.struct("h", "pos", "kind", "tiles")).alias("seeds"))
    both = own.dropDuplicates(["doc"]).join(wanted, "doc")
    around = np.arange(-BEFORE, AFTER)

    def cut(batches):
        for batch in batches:
            ids, lists = batch.column("doc").to_numpy(), batch.column("seeds")
            fields = {f: lists.values.field(f) for f in ("h", "pos", "kind", "tiles")}
            ends, pos = lists.offsets.to_numpy(), fields["pos"].to_numpy()
            for low, high, words, starts in hashed(batch.column("text"), SEPARATOR):
                words = np.maximum((words >> np.uint64(48)).astype(np.uint16), 1)
                for p in range(ends[low], ends[high], 1 << 14):
                    q = min(p + (1 << 14), ends[high])
                    text = np.searchsorted(ends, np.arange(p, q), "right") - 1
                    at = (starts[text - low] + pos[p:q])[:, None] + around
                    inside = (at >= starts[text - low][:, None]) & (at < starts[text - low + 1][:, None])
                    found = np.where(inside, words[np.clip(at, 0, len(words) - 1)], 0).astype(np.uint16)
                    sizes = pa.py_buffer(np.arange(q - p + 1, dtype=np.int32) * (2 * len(around)))
                    packed = pa.Array.from_buffers(pa.binary(), q - p, [None, sizes, pa.py_buffer(found)])
                    yield pa.RecordBatch.from_arrays(
                        [fields["h"][p:q], pa.array(ids[text]), *(fields[f][p:q] for f in ("pos", "kind", "tiles")), packed],
                        names=["h", "doc", "pos", "kind", "tiles", "words"])

    return both.mapInArrow(cut, "h long, doc long, pos long, kind long, tiles int, words binary")


def frequent_matches(places: DataFrame, own: DataFrame) -> DataFrame:
    """``a``, ``b``, ``pa``, ``pb``, ``size``: matches of the occurrences of each frequent seed, all with all
    of other kinds. Tiles of ``TILE`` by ``TILE`` are compared on their own."""
    n = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tile = F.expr("cast(pmod(xxhash64(doc, pos), tiles) as int)")
    rows = surroundings(places, own).withColumn("tile", tile).select(
        "h", "doc", "pos", "kind", "words", F.explode(F.expr(
            "transform(sequence(0, tiles - 1), t -> struct(least(t, tile) AS i, greatest(t, tile) AS j))")).alias("t"))
    dealt = rows.select("h", "t.i", "t.j", "doc", "pos", "kind", "words").repartition(n, "h", "i", "j")
    dealt = dealt.sortWithinPartitions("h", "i", "j")

    def run(batches):
        kept, words = np.empty((6, 0), np.int64), np.empty((0, BEFORE + AFTER), np.uint16)
        for batch in batches:
            if not batch.num_rows:
                continue
            kept = np.hstack([kept, _columns(batch, "h", "i", "j", "doc", "pos", "kind")])
            ends = np.frombuffer(batch.column("words").buffers()[1], np.int32)[batch.column("words").offset :]
            more = np.frombuffer(batch.column("words").buffers()[2], np.uint8)[ends[0] : ends[batch.num_rows]]
            words = np.vstack([words, more.view(np.uint16).reshape(-1, BEFORE + AFTER)])
            begin = np.flatnonzero(np.r_[True, (kept[:3, 1:] != kept[:3, :-1]).any(axis=0)])[-1]
            if begin:
                yield from emit(kept[:, :begin], words[:begin])
                kept, words = kept[:, begin:], words[begin:]
        if kept.shape[1]:
            yield from emit(kept, words)

    def emit(rows: np.ndarray, words: np.ndarray):
        group = np.cumsum(np.r_[False, (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)])
        for m in related(group, rows[3], rows[4], rows[5], words):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in m], names=["a", "b", "pa", "pb", "size"])

    return dealt.mapInArrow(run, "a long, b long, pa long, pb long, size long").distinct()


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Whether each entry of sorted keys differs from the one before."""
    out = np.ones(len(keys[0]), bool)
    if len(out):
        out[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return out


def _spread(new: np.ndarray, part: np.ndarray) -> np.ndarray:
    """How many parts each entry's group has."""
    group = np.cumsum(new) - 1
    return np.bincount(group[part], minlength=1)[group] if len(group) else group


def related(group: np.ndarray, doc: np.ndarray, pos: np.ndarray, kind: np.ndarray,
            words: np.ndarray) -> Iterator[np.ndarray]:
    """Matches (``a, b, pa, pb, size``) of the seeds of each ``group`` by the ``words`` around them.

    Seeds with equal surroundings are matched with the first of them, which stands for them. Seeds in
    ``MIN_WORDS`` equal words are matched with the first that has these. All others can only be in one
    passage if they have four words in a row in common that are not in the run of equal words of both
    around the seed: each pair that has, and can have ``AROUND`` words around the seed aligned, is matched.
    Seeds of one ``kind`` are not. Pairs are found by these words, or, in a group whose seeds have so
    many in common that each pair would be found again and again, by going through all of them once.
    """
    if not len(group):
        return
    powers = np.multiply.accumulate(np.full(words.shape[1], 0x9E3779B97F4A7C15, np.uint64))
    # Sums of hashed words up to each place, so that differences are hashes of stretches.
    sums = np.zeros((len(words), words.shape[1] + 1), np.uint64)
    np.cumsum(mix(words.astype(np.uint64) + np.uint64(1)) * powers, axis=1, out=sums[:, 1:])
    order = np.lexsort((pos, doc, sums[:, -1], group))
    new = _starts(group[order], sums[order, -1])
    first = order[new]
    stands = first[np.cumsum(new) - 1]
    yield from _as_matches(stands, order, doc, pos, words)
    # From here on only those that stand for others.
    group, doc, pos, kind, words, sums = (v[first] for v in (group, doc, pos, kind, words, sums))
    salt = mix(group.astype(np.uint64) + np.uint64(7))[:, None]
    size = words.shape[1]

    begins = np.arange(BEFORE + K - MIN_WORDS, BEFORE + 1)
    # A stretch without missing words lies between the first and the last word.
    low, high = (words != 0).argmax(axis=1)[:, None], size - (words[:, ::-1] != 0).argmax(axis=1)[:, None]
    whole = (begins >= low) & (begins + MIN_WORDS <= high)
    row, column = np.nonzero(whole)
    key = mix((sums[:, begins + MIN_WORDS] - sums[:, begins]) ^ salt)[row, column]
    order = np.lexsort((pos[row], doc[row], key, column))
    new = _starts(column[order], key[order])
    firsts, row = row[order[new]], row[order]
    firsts = firsts[np.cumsum(new) - 1]
    both = np.unique(np.stack([firsts, row])[:, kind[firsts] != kind[row]], axis=1)
    yield from _as_matches(*both, doc, pos, words)

    grams = np.zeros((len(words), size - 3), np.uint64)
    for j in range(4):
        grams |= words[:, j : size - 3 + j].astype(np.uint64) << np.uint64(16 * j)
    at = np.arange(size - 3)
    grams[(at < low) | (at + 4 > high)] = 0
    # Four words on each side of the seed, and all between the seed and their end, at one distance: if both
    # are equal, they are in the run of both.
    sides = []
    for at in (np.arange(0, BEFORE - 4), np.arange(BEFORE + K + 1, size - 3)):
        between = sums[:, at + 4] - sums[:, [BEFORE]] if at[0] else sums[:, [BEFORE]] - sums[:, at]
        sides.append((grams[:, at], between + at.astype(np.uint64)))
    sets = None
    edges = np.flatnonzero(np.r_[_starts(group), True])
    sizes = np.diff(edges)
    group = np.repeat(np.arange(len(sizes)), sizes)
    through = np.zeros(len(sizes), bool)
    # Pairs that other words have led to; a side of a tile bounds them, many small groups have few.
    judged = np.zeros(len(words) ** 2, bool) if len(words) ** 2 <= 1 << 27 else None
    for key, between in sides:
        row, column = np.nonzero((key != 0) & ~through[group][:, None])
        key, between = mix(key ^ salt)[row, column], between[row, column]
        # Only keys that may occur twice are sorted.
        slot = (key >> np.uint64(40)).astype(np.int64)
        twice = np.bincount(slot, minlength=1 << 24)[slot] > 1
        row, key, between = row[twice], key[twice], between[twice]
        order = np.lexsort((between, key))
        row, key, between = row[order], key[order], between[order]
        several = _spread(_starts(key), _starts(key, between)) > 1
        row, key, between = row[several], key[several], between[several]
        if not len(row):
            continue
        begin, sub = np.flatnonzero(_starts(key)), np.flatnonzero(_starts(key, between))
        k0, k1 = (np.repeat(e, np.diff(begin, append=len(row))) for e in (begin, np.r_[begin[1:], len(row)]))
        s0, s1 = (np.repeat(e, np.diff(sub, append=len(row))) for e in (sub, np.r_[sub[1:], len(row)]))
        # All but those of a key's most frequent kind are paired with those between which there are other words.
        order = np.lexsort((kind[row], key))
        alike = np.flatnonzero(_starts(key[order], kind[row[order]]))
        times = np.diff(alike, append=len(row))
        of_key = np.searchsorted(begin, alike, "right") - 1
        best = np.lexsort((times, of_key))
        most = best[np.r_[of_key[best][1:] != of_key[best][:-1], True]]
        paired = np.ones(len(row), bool)
        paired[order[np.repeat(np.isin(np.arange(len(alike)), most), times)]] = False
        own = np.flatnonzero(paired)
        count = (k1 - k0 - (s1 - s0))[own]
        often = np.bincount(group[row[own]], weights=count, minlength=len(sizes)) > sizes * (sizes - 1) // 2
        often &= sizes >= THROUGH
        through |= often
        own, count = own[~often[group[row[own]]]], count[~often[group[row[own]]]]
        ends = np.cumsum(count)
        done = 0
        while done < len(own):
            # Some million pairs at once.
            to = max(done + 1, int(np.searchsorted(ends, ends[done] - count[done] + PAIRS, "right")))
            some, many = own[done:to], count[done:to]
            n = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            other = np.repeat(k0[some], many) + n
            other = np.where(other >= np.repeat(s0[some], many), other + np.repeat((s1 - s0)[some], many), other)
            x, y = np.repeat(row[some], many), row[other]
            other = kind[x] != kind[y]
            x, y = np.minimum(x, y)[other], np.maximum(x, y)[other]
            pair = x * len(words) + y
            if judged is not None:
                pair = pair[~judged[pair]]
                judged[pair] = True
            pair = np.unique(pair)
            x, y = pair // len(words), pair % len(words)
            x, y = x[doc[x] != doc[y]], y[doc[x] != doc[y]]
            if sets is None:
                sets, spare = _sets(words)
            for p in range(0, len(x), 1 << 13):
                u, v = x[p : p + (1 << 13)], y[p : p + (1 << 13)]
                most = K + np.bitwise_count(sets[u] & sets[v]).sum(axis=1, dtype=np.int64) + np.minimum(spare[u], spare[v])
                yield from _as_matches(*_alike(u[most >= AROUND], v[most >= AROUND], words), doc, pos, words)
            done = to
    if through.any() and sets is None:
        sets, spare = _sets(words)
    for low, high in zip(edges[:-1][through].tolist(), edges[1:][through].tolist()):
        while low < high:
            to = min(high, low + max(1, (PAIRS >> 4) // (high - low)))
            most = np.bitwise_count(sets[low:to, None] & sets[None, low:high]).sum(axis=2, dtype=np.uint16)
            most = K + most + np.minimum(spare[low:to, None], spare[None, low:high])
            most *= np.arange(low, to)[:, None] < np.arange(low, high)
            most *= (kind[low:to, None] != kind[None, low:high]) & (doc[low:to, None] != doc[None, low:high])
            x, y = np.nonzero(most >= AROUND)
            for p in range(0, len(x), 1 << 13):
                u, v = _alike(low + x[p : p + (1 << 13)], low + y[p : p + (1 << 13)], words)
                also = _apart(u, v, sides)
                yield from _as_matches(u[also], v[also], doc, pos, words)
            low = to


def _sets(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sets of each row's words before the seed and of those behind it, the repeats of a word being others, as bits,
    and how many words have no bit of their own: rows have no more words in common than bits and the lesser of these."""
    sets = np.zeros((len(words), BITS // 64), np.uint64)
    spare = np.zeros(len(words), np.int64)
    for side, part in enumerate((words[:, :BEFORE], words[:, BEFORE + K :])):
        ranked = np.sort(part, axis=1)
        new = np.ones(ranked.shape, bool)
        new[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
        place = np.arange(ranked.shape[1])
        repeat = place - np.maximum.accumulate(np.where(new, place, 0), axis=1)
        bit = mix(ranked.astype(np.uint64) << np.uint64(8) | repeat.astype(np.uint64)) >> np.uint64(40)
        bit = bit.astype(np.int64) % (BITS // 2) + side * (BITS // 2)
        row, column = np.nonzero(ranked)
        bit = bit[row, column]
        np.bitwise_or.at(sets, (row, bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
        spare += np.bincount(row, minlength=len(words))
    return sets, spare - np.bitwise_count(sets).sum(axis=1, dtype=np.int64)


def _alike(u: np.ndarray, v: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs that have ``AROUND`` words around the seed aligned."""
    both = K + _aligned_words(words[u, :BEFORE], words[v, :BEFORE])
    both += _aligned_words(words[u, BEFORE + K :], words[v, BEFORE + K :])
    return u[both >= AROUND], v[both >= AROUND]


def _aligned_words(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The most words that can be aligned in each row of ``a`` and ``b`` (up to 64), by the bits of one number a row."""
    wide = np.zeros((len(a), 64), a.dtype)
    wide[:, : a.shape[1]] = a
    rest = np.full(len(a), LAST)
    for word in b.T:
        same = np.packbits(wide == word[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
        same = rest & np.where(word != 0, same, 0)
        rest = (rest + same) | (rest - same)
    return np.bitwise_count(~rest).astype(np.int64)


def _apart(u: np.ndarray, v: np.ndarray, sides: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Whether pairs have four words in a row in common that are not in the run around the seed."""
    out = np.zeros(len(u), bool)

    def common(four: np.ndarray, between: np.ndarray, x: tuple, y: tuple) -> np.ndarray:
        return (four[x] == four[y]) & (four[x] != 0) & (between[x] != between[y])

    for four, between in sides:
        n = four.shape[1]
        # Most have some at nearly the same distance from the seed.
        for lag in (0, 1, -1, 2, -2):
            left = np.flatnonzero(~out)
            places = np.arange(max(0, -lag), min(n, n - lag))
            out[left] = common(four, between, (u[left, None], places), (v[left, None], places + lag)).any(axis=1)
    for four, between in sides:
        left = np.flatnonzero(~out)
        for p in range(0, len(left), 1 << 9):
            some = left[p : p + (1 << 9)]
            places = np.arange(four.shape[1])
            x, y = (u[some, None, None], places[:, None]), (v[some, None, None], places)
            out[some] = common(four, between, x, y).any(axis=(1, 2))
    return out


def _as_matches(x: np.ndarray, y: np.ndarray, doc: np.ndarray, pos: np.ndarray, words: np.ndarray) -> Iterator[np.ndarray]:
    """The seeds ``x`` and ``y`` of different documents; one that repeats at once goes on as long as both do."""
    x, y = x[doc[x] != doc[y]], y[doc[x] != doc[y]]
    for p in range(0, len(x), 1 << 14):
        u, v = x[p : p + (1 << 14)], y[p : p + (1 << 14)]
        u, v = np.where(doc[u] < doc[v], u, v), np.where(doc[u] < doc[v], v, u)
        seed = words[u, BEFORE : BEFORE + K]
        again = np.any([(words[u, BEFORE + d : BEFORE + d + K] == seed).all(axis=1) for d in range(1, W + 1)], axis=0)
        other = (words[u, BEFORE + K :] != words[v, BEFORE + K :]) | (words[u, BEFORE + K :] == 0)
        after = np.hstack([other, np.ones((len(u), 1), bool)]).argmax(axis=1)
        yield np.stack([doc[u], doc[v], pos[u], pos[v], K + np.where(again, after, 0)])


def blocks(rows: np.ndarray) -> np.ndarray:
    """Rows ``a, b, pa, pb, size`` with those that overlap on a diagonal merged."""
    order = np.lexsort((rows[3], rows[3] - rows[2], rows[1], rows[0]))
    rows = rows[:, order]
    diagonal = rows[3] - rows[2]
    same = (rows[:2, 1:] == rows[:2, :-1]).all(axis=0) & (diagonal[1:] == diagonal[:-1])
    line = np.cumsum(np.r_[True, ~same])
    # The furthest end so far on the same diagonal.
    far = int((rows[3] + rows[4]).max(initial=0)) + 1
    end = np.maximum.accumulate(rows[3] + rows[4] + line * far) - line * far
    new = np.r_[True, ~same | (rows[3, 1:] > end[:-1])]
    first = np.flatnonzero(new)
    out = rows[:, first]
    out[4] = end[np.r_[first[1:] - 1, rows.shape[1] - 1]] - out[3]
    return out


def chains(pa_: list[int], pb: list[int], size: list[int], cost: float = GAP_COST) -> list[list[int]]:
    """Chains of blocks (places in the lists), best first; no block is in two.

    A block's predecessor ends before it begins in both documents; a Fenwick tree by
    the end in the first holds the best of the blocks that end early enough in the second.
    """
    n = len(pa_)
    ends = sorted({pa_[i] + size[i] for i in range(n)})
    rank = {e: r for r, e in enumerate(ends, 1)}
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (len(ends) + 1)
    from bisect import bisect_right

    score, before = [0.0] * n, [-1] * n
    by_start = sorted(range(n), key=lambda i: (pb[i], pa_[i]))
    by_end = sorted(range(n), key=lambda i: pb[i] + size[i])
    done = 0
    for j in by_start:
        while done < n and pb[by_end[done]] + size[by_end[done]] <= pb[j]:
            i = by_end[done]
            value = (score[i] + cost * (pa_[i] + pb[i] + 2 * size[i]), i)
            r = rank[pa_[i] + size[i]]
            while r < len(tree):
                tree[r] = max(tree[r], value)
                r += r & -r
            done += 1
        best, r = (-1e18, -1), bisect_right(ends, pa_[j])
        while r:
            best = max(best, tree[r])
            r -= r & -r
        gain = best[0] - cost * (pa_[j] + pb[j])
        score[j] = size[j] + max(0.0, gain)
        before[j] = best[1] if gain > 0 else -1
    used, out = [False] * n, []
    for j in sorted(range(n), key=lambda i: -score[i]):
        chain = []
        while j >= 0 and not used[j]:
            used[j] = True
            chain.append(j)
            j = before[j]
        if chain:
            out.append(chain[::-1])
    return out


def chained(found: DataFrame) -> DataFrame:
    """``a``, ``b`` and the blocks (``xs``, ``ys``, ``sizes``) of each chain with enough words."""
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.repartition(n, "a", "b").sortWithinPartitions("a", "b")

    def of_pairs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = blocks(rows)
        first = np.flatnonzero(np.r_[True, (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)])
        last = np.r_[first[1:], rows.shape[1]]
        words = np.add.reduceat(rows[4], first)
        a, b, lists = [], [], []
        for p, q in zip(first[words >= CHAIN_WORDS].tolist(), last[words >= CHAIN_WORDS].tolist()):
            x, y, size = rows[2, p:q].tolist(), rows[3, p:q].tolist(), rows[4, p:q].tolist()
            for chain in [[0]] if q - p == 1 else chains(x, y, size):
                if sum(size[i] for i in chain) >= CHAIN_WORDS:
                    a.append(rows[0, p])
                    b.append(rows[1, p])
                    lists.append([[x[i] for i in chain], [y[i] for i in chain], [size[i] for i in chain]])
        if a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                 *[pa.array([c[k] for c in lists], pa.list_(pa.int64())) for k in range(3)]],
                names=["a", "b", "xs", "ys", "sizes"])

    def run(batches):
        kept = np.empty((5, 0), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.hstack([kept, _columns(batch, "a", "b", "pa", "pb", "size")])
            begin = np.flatnonzero(np.r_[True, (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)])[-1]
            if begin:
                yield from of_pairs(rows[:, :begin])
            kept = rows[:, begin:]
        if kept.shape[1]:
            yield from of_pairs(kept)

    return dealt.mapInArrow(run, "a long, b long, xs array<long>, ys array<long>, sizes array<long>")


def common(a: Sequence[int], b: Sequence[int]) -> int:
    """The most words of ``a`` and ``b`` that can be aligned."""
    if not len(a) or not len(b):
        return 0
    if len(a) > MATRIX or len(b) > MATRIX:
        n, a, b = min(len(a), len(b)), np.asarray(a), np.asarray(b)
        return int(max((a[:n] == b[:n]).sum(), (a[len(a) - n :] == b[len(b) - n :]).sum()))
    # A row of the matrix as bits, 0 where it goes up by one.
    places: dict[int, int] = {}
    for j, word in enumerate(b):
        places[word] = places.get(word, 0) | 1 << j
    row = full = (1 << len(b)) - 1
    for word in a:
        if same := row & places.get(word, 0):
            row = ((row + same) | (row - same)) & full
    return len(b) - row.bit_count()


def extended(a: Sequence[int], b: Sequence[int]) -> tuple[int, int]:
    """How far to go on along the diagonal, and how many words are equal there."""
    worth = equal = most = 0
    best = 0, 0
    for n, (v, w) in enumerate(zip(a, b), 1):
        if v == w:
            worth, equal = worth + 1, equal + 1
            if worth > most:
                most, best = worth, (n, equal)
        else:
            worth -= 3
            # Stop where the worth has fallen too far below its highest.
            if most - worth > 9:
                break
    return best


def parts(x: list[int], y: list[int], size: list[int], a: Sequence[int], b: Sequence[int]) -> list[tuple]:
    """``a0, a1, b0, b1, equal words`` of each part of an aligned chain with enough equal words:
    the one with the most, and then those of the blocks left on both sides of it. Places count
    from the beginnings of ``a`` and ``b``."""
    n = len(x)
    ends = [p + s for p, s in zip(x, size)], [p + s for p, s in zip(y, size)]
    before = extended(a[: x[0]][::-1], b[: y[0]][::-1])
    behind = extended(a[ends[0][-1] :], b[ends[1][-1] :])
    whole = x[0] - before[0], ends[0][-1] + behind[0], y[0] - before[0], ends[1][-1] + behind[0]
    wide = whole[1] - whole[0], whole[3] - whole[2]
    if min(wide) < MIN_WORDS:
        return []
    gaps = [common(a[ends[0][i] : x[i + 1]], b[ends[1][i] : y[i + 1]]) for i in range(n - 1)]
    equal = before[1] + sum(size) + sum(gaps) + behind[1]
    if equal >= IDENTITY * max(wide):
        return [(*whole, equal)]
    if n == 1:
        return []
    x, y, size = (np.array(v, np.int64) for v in (x, y, size))
    ends = np.stack([x + size, y + size])
    through = np.cumsum([0, *(size[:-1] + np.array(gaps, np.int64))])
    # How far a part goes on before its first and after its last block, and the equal words there.
    back, on = (np.zeros((2, n), np.int64) for _ in range(2))

    def stretch(first: int, last: int) -> None:
        back[:, first] = extended(
            a[ends[0, first - 1] if first else 0 : x[first]][::-1], b[ends[1, first - 1] if first else 0 : y[first]][::-1])
        on[:, last] = extended(
            a[ends[0, last] : x[last + 1] if last + 1 < n else None], b[ends[1, last] : y[last + 1] if last + 1 < n else None])

    def best(lows: range, high: int) -> tuple | None:
        """The part with the most equal words that begins with one of the blocks ``lows``."""
        most, found = 0, None
        for i in lows:
            equal = through[i : high + 1] - through[i] + size[i : high + 1] + back[1, i] + on[1, i : high + 1]
            if equal.max() <= most:
                continue
            wide = np.stack([ends[0, i : high + 1] - x[i], ends[1, i : high + 1] - y[i]]) + back[0, i] + on[0, i : high + 1]
            enough = (wide.min(axis=0) >= MIN_WORDS) & (equal >= IDENTITY * wide.max(axis=0))
            at = int(np.where(enough, equal, 0).argmax())
            if enough[at] and equal[at] > most:
                most, found = int(equal[at]), (i, i + at)
        return found

    def cut(i: int, j: int) -> tuple:
        equal = through[j] - through[i] + size[j] + back[1, i] + on[1, j]
        return tuple(int(v) for v in (
            x[i] - back[0, i], ends[0, j] + on[0, j], y[i] - back[0, i], ends[1, j] + on[0, j], equal))

    for i in range(n):
        stretch(i, i)
    out, todo = [], [(0, n - 1)]
    while todo:
        low, high = todo.pop()
        found = best(range(low, high + 1), high)
        if found:
            out.append(cut(*found))
            todo += [(low, found[0] - 1), (found[1] + 1, high)]
    return out


def shared_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``first_word``, ``end_word`` of each passage that an earlier document
    (with a smaller id) ``source_id`` has from ``source_first`` to ``source_end``, and
    ``equal_words``."""
    shared_folder(docs.sparkSession)
    own = small_batches(docs).select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    own = own.where("doc IS NOT NULL AND text IS NOT NULL")
    every = matches(seeds(own))
    found = checkpointed(passages_of(checkpointed(chained(every.where("a <> b"))), own))
    # Occurrences of frequent seeds that have no passage with one and the same place, all with all;
    # what documents have in common is chained once more with these.
    more = checkpointed(frequent_matches(classes(every, found), own))
    pairs = checkpointed(more.select("a", "b").distinct())
    again = every.where("a <> b").select(more.columns).join(pairs, ["a", "b"], "left_semi").unionByName(more)
    found = found.join(pairs, ["a", "b"], "left_anti").unionByName(passages_of(checkpointed(chained(again)), own))
    return found.select(
        F.col("b").alias("doc_id"), F.col("b0").alias("first_word"), F.col("b1").alias("end_word"),
        F.col("a").alias("source_id"), F.col("a0").alias("source_first"), F.col("a1").alias("source_end"),
        F.col("equal").alias("equal_words"),
    ).distinct()


def passages_of(found: DataFrame, own: DataFrame) -> DataFrame:
    """``a``, ``b``, ``a0``, ``a1``, ``b0``, ``b1`` and ``equal`` words of the passages of chains."""
    spans = found.selectExpr(
        "*", "xs[0] AS a0", "ys[0] AS b0", "element_at(xs, -1) + element_at(sizes, -1) AS a1",
        "element_at(ys, -1) + element_at(sizes, -1) AS b1", "aggregate(sizes, 0L, (s, x) -> s + x) AS equal",
    ).withColumn("proven", F.expr(
        f"least(a1 - a0, b1 - b0) >= {MIN_WORDS} AND equal >= {IDENTITY} * greatest(a1 - a0, b1 - b0)"))
    done = spans.where("proven").select("a", "b", "a0", "a1", "b0", "b1", "equal")
    return done.unionByName(_aligned(spans.where("NOT proven"), own))


def _windows(spans: DataFrame, own: DataFrame) -> DataFrame:
    """``doc``, ``low``, ``high`` and the ``words`` (32-bit hashes) of each window of a chain."""
    parts = [spans.select(F.col(s).alias("doc"), f"{s}_low", f"{s}_high").toDF("doc", "low", "high") for s in "ab"]
    wanted = parts[0].unionByName(parts[1]).distinct()
    wanted = wanted.groupBy("doc").agg(F.collect_list(F.struct("low", "high")).alias("windows"))
    both = own.dropDuplicates(["doc"]).join(wanted, "doc")

    def cut(batches):
        for batch in batches:
            ids, lists = batch.column("doc").to_pylist(), batch.column("windows").to_pylist()
            for low, _, words, starts in hashed(batch.column("text"), SEPARATOR):
                words = (words >> np.uint64(32)).astype(np.uint32)
                rows = []
                for n, (p, q) in enumerate(zip(starts, starts[1:])):
                    rows += [(ids[low + n], w["low"], w["high"], words[p + w["low"] : min(q, p + w["high"])].tobytes())
                             for w in lists[low + n]]
                if rows:
                    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["doc", "low", "high", "words"])

    return both.mapInArrow(cut, "doc long, low long, high long, words binary")


def _aligned(spans: DataFrame, own: DataFrame) -> DataFrame:
    # Windows begin and end at multiples of the margin, so that chains share them.
    for s in "ab":
        spans = spans.withColumn(f"{s}_low", F.expr(f"greatest(0L, ({s}0 div {MARGIN}) * {MARGIN} - {MARGIN})"))
        spans = spans.withColumn(f"{s}_high", F.expr(f"({s}1 div {MARGIN}) * {MARGIN} + 2 * {MARGIN}"))
    windows = checkpointed(_windows(spans, own))
    both = spans.select("a", "b", "xs", "ys", "sizes", "a_low", "a_high", "b_low", "b_high")
    for s in "ab":
        both = both.join(windows.toDF(s, f"{s}_low", f"{s}_high", f"{s}_words"), [s, f"{s}_low", f"{s}_high"])

    def align(batches):
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("a", "b", "xs", "ys", "sizes", "a_low", "b_low", "a_words", "b_words"))
            for a, b, xs, ys, sizes, a_low, b_low, a_words, b_words in zip(*columns):
                found = parts([x - a_low for x in xs], [y - b_low for y in ys], sizes,
                              memoryview(a_words).cast("I"), memoryview(b_words).cast("I"))
                rows += [(a, b, a_low + a0, a_low + a1, b_low + b0, b_low + b1, equal) for a0, a1, b0, b1, equal in found]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)], names=["a", "b", "a0", "a1", "b0", "b1", "equal"])

    return both.mapInArrow(align, "a long, b long, a0 long, a1 long, b0 long, b1 long, equal long")
