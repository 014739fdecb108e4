"""Near duplicates by SimHash, found with anchor-point covering.

Fingerprints of 64 bits are laid out in blocks. The anchors of a block are the
words of the perfect Hamming code over its bits (31 bits for distances up to 3):
a covering code, every value is within 1 bit of exactly one anchor, its home. Of
two fingerprints within the distance, one block differs in one bit at most. So a
value that is sent to all anchors within the covering radius plus that one bit
(16 of them at most) meets the other at the other's home. Fingerprints are
compared per anchor, by all 64 bits, and each comparison of a group hands on only
links that join parts of it, not all pairs.

Equal fingerprints are one row before anything is compared. An anchor with many
fingerprints is cut into tiles of pairs of chunks, so a group of any size is
compared wholly, in tasks of bounded memory.

Defined results: a null or empty text has fingerprint zero and is linked like any
other; fewer words than the shingle length are one shingle. Repeated rows give a
row each. A null id is never the smallest of a component that has another.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewright.llm.arrow import with_arrow_columns
from platewright.llm.components import components
from platewright.session import shared_folder

#: Fingerprints in a chunk of an anchor with many; groups up to LAGS are compared pair by pair.
CHUNK, LAGS = 1024, 24
#: Shingles whose bits are counted at once.
PIECE = 1 << 16


def fingerprint(words: list[bytes], joined: bytes, shingle: int, seed: int) -> int:
    """The bits set in over half the hashes; ``joined`` has the words with single spaces."""
    from xxhash import xxh64_intdigest

    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    hashes = np.fromiter(
        (xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends)), np.uint64, len(ends)
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), PIECE):
        bits = np.unpackbits(hashes[at : at + PIECE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """Adds ``fingerprint`` (64 bits as a long) of the whole text: A-Z in lower
    case, words between ASCII white space, shingles hashed with XXH64."""

    def make():
        def of(value: str | None) -> int:
            words = (value or "").encode().lower().split()
            return fingerprint(words, b" ".join(words), shingle, seed)

        def batch_prints(batch: pa.RecordBatch) -> list:
            prints = [of(t) for t in batch.column(text).to_pylist()]
            return [pa.array(np.array(prints, np.uint64).view(np.int64))]

        return batch_prints

    return with_arrow_columns(docs, T.StructType([T.StructField("fingerprint", T.LongType())]), make)


def _layout(distance: int) -> tuple[int, int]:
    """Blocks and bits of a Hamming code so that one block differs in a bit at most."""
    for r in (5, 4, 3):
        blocks = 64 >> r
        if distance < 2 * blocks:
            return blocks, (1 << r) - 1
    raise ValueError(f"a distance of {distance} bits is more than the codes cover")


def anchors(prints: DataFrame, distance: int, print_: str = "fingerprint") -> DataFrame:
    """``anchor`` (with its block), ``print``, ``home``: a row per anchor within reach."""
    blocks, bits = _layout(distance)
    r = bits.bit_length()
    every = []
    for block in range(blocks):
        value = F.shiftrightunsigned(F.col(print_), block * (bits + 1)).bitwiseAND(F.lit((1 << bits) - 1))
        syndrome = F.lit(0)
        for j in range(r):
            mask = sum(1 << (i - 1) for i in range(1, bits + 1) if i >> j & 1)
            odd = F.bit_count(value.bitwiseAND(F.lit(mask))).bitwiseAND(F.lit(1))
            syndrome = syndrome + odd * (1 << j)
        every.append((f"v{block}", value, f"s{block}", syndrome))
    found = prints.select(F.col(print_).alias("print"), *[v.alias(n) for n, v, _, _ in every],
                          *[s.alias(n) for _, _, n, s in every])
    lists = []
    for block in range(blocks):
        value, syndrome, mark = f"v{block}", f"s{block}", f"shiftleft({block}L, {bits + 1})"
        home = f"CASE WHEN {syndrome} = 0 THEN {value} ELSE {value} ^ shiftleft(1L, {syndrome} - 1) END"
        near = (
            f"transform(filter(sequence(1, {bits}), i -> {syndrome} > 0 AND (i ^ {syndrome}) > i),"
            f" i -> {value} ^ shiftleft(1L, i - 1) ^ shiftleft(1L, (i ^ {syndrome}) - 1))"
        )
        lists.append(
            f"transform(concat(array({home}), {near}),"
            f" (x, n) -> named_struct('anchor', x | {mark}, 'home', n = 0))"
        )
    return found.select("print", F.expr(f"inline(concat({', '.join(lists)}))"))


def _tiles(members: DataFrame, chunk: int) -> DataFrame:
    """``members`` with ``i`` and ``j``, the tile of an anchor: (0, 0) unless it has
    more than ``chunk`` fingerprints. A chunk meets every other chunk in one tile."""
    heavy = members.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > chunk)
    heavy = heavy.select("anchor", F.ceil(F.col("n") / chunk).cast("int").alias("k"))
    cut = members.join(heavy, "anchor", "left").withColumn("k", F.coalesce("k", F.lit(1)))
    cut = cut.withColumn("c", F.pmod(F.xxhash64("print"), F.col("k")).cast("int"))
    return cut.select(
        "anchor", "print", "home",
        F.expr("inline(transform(sequence(0, k - 1), x -> named_struct('i', least(x, c), 'j', greatest(x, c))))"),
    )


def _forest(prints: np.ndarray, home: np.ndarray, distance: int) -> np.ndarray:
    """Links that join each fingerprint of a tile to the first of its part."""
    near = np.bitwise_count(prints[home][:, None] ^ prints[None, :]) <= distance
    at = np.flatnonzero(home)
    label = np.arange(len(prints))
    while True:
        low = np.where(near, label[None, :], len(prints)).min(axis=1)
        new = label.copy()
        np.minimum.at(new, at, low)
        new = np.minimum(new, np.where(near, low[:, None], len(prints)).min(axis=0))
        new = np.minimum(new, new[new])
        if np.array_equal(new, label):
            joined = np.flatnonzero(label != np.arange(len(prints)))
            return np.stack([prints[joined], prints[label[joined]]], axis=1)
        label = new


def links(prints: DataFrame, distance: int, chunk: int = CHUNK) -> DataFrame:
    """``a`` and ``b``: enough links of distinct fingerprints within ``distance``
    to join all that are reachable from each other."""
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Each row becomes some thirty, so small partitions are not put together before.
    members = _tiles(anchors(prints.repartition(n, prints.columns[0]), distance), chunk)
    order = ["anchor", "i", "j", "print"]
    dealt = members.repartition(n, "anchor", "i", "j").sortWithinPartitions(*order)

    def compare(batches):
        kept: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("anchor", "i", "j")])
            rows = np.vstack([key, batch.column("print").to_numpy(),
                              batch.column("home").to_numpy(zero_copy_only=False).astype(np.int64)])
            rows = np.hstack([*kept, rows])
            starts = np.flatnonzero(np.r_[True, (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)])
            yield from of_groups(rows[:, : starts[-1]], starts)
            kept = [rows[:, starts[-1] :]]
        if kept:
            yield from of_groups(kept[0], np.array([0, kept[0].shape[1]]))

    def of_groups(rows: np.ndarray, starts: np.ndarray):
        if not rows.shape[1]:
            return
        starts = np.unique(np.r_[starts[starts < rows.shape[1]], rows.shape[1]])
        sizes = np.diff(starts)
        group = np.repeat(np.arange(len(sizes)), sizes)
        prints_, home = rows[3].view(np.uint64), rows[4] > 0
        small = (sizes <= LAGS)[group]
        found = []
        for lag in range(1, LAGS):
            if not (sizes > lag).any():
                break
            at = np.flatnonzero((group[lag:] == group[:-lag]) & small[lag:] & (home[lag:] | home[:-lag]))
            at = at[np.bitwise_count(prints_[at] ^ prints_[at + lag]) <= distance]
            found.append(np.stack([prints_[at + lag], prints_[at]], axis=1))
        for g in np.flatnonzero(sizes > LAGS):
            part = slice(starts[g], starts[g + 1])
            if home[part].any():
                found.append(_forest(prints_[part], home[part], distance))
        pairs = np.concatenate(found).view(np.int64) if found else np.empty((0, 2), np.int64)
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, distance: int = 3, shingle: int = 3, seed: int = 42,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) and ``component_id`` (the smallest id
    reachable over links of ``distance`` bits or fewer), a row per document."""
    shared_folder(docs.sparkSession)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = with_fingerprint(own, shingle=shingle, seed=seed).drop("text").checkpoint()
    distinct = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    joined = components(links(distinct.select("fingerprint"), distance))
    rooted = distinct.join(joined, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = rooted.join(least, "root").select("fingerprint", "component_id")
    return prints.join(of_print, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, distance: int = 3, shingle: int = 3, seed: int = 42,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near duplicates: that with the smallest id.

    Rows with one id are one document, of which one row stays. Rows without an id
    cannot be named by any group and stay.
    """
    found = near_duplicates(docs, distance, shingle, seed, doc_id, text)
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias(doc_id)).distinct()
    kept = docs.where(F.col(doc_id).isNotNull()).join(first, doc_id, "left_semi")
    return kept.dropDuplicates([doc_id]).unionByName(docs.where(F.col(doc_id).isNull()))
