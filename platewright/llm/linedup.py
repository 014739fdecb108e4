"""Lines shared between documents, deleted from the later one by pairwise alignment.

Documents are compared as sequences of line hashes. Those that share a line are
aligned with a patience diff: lines that occur once in either document and in the
same order are fixed points, between which the same is done again. Blocks of aligned
lines with enough words are deleted from the document with the larger id.

Pairs come from shared units: a line with enough words, or two lines in a row of
which one has too few. A rare unit (of up to ``RARE`` occurrences) pairs all
documents that have it. An occurrence of a frequent one is paired by its contexts: with the first
document that has the unit, that has it as often before, that has it after, before and
between the same frequent units, and that has few (``FEW``) frequent units beside it which it could
cross. So the pairs grow with the occurrences of units, not with
their square. Only lines that are aligned in some pair are deleted; a frequent line that
aligns in none of these pairs, but would with a document that none of its
contexts names, stays. Equal sequences are one before anything is paired.

Lines are compared without white space at their ends; a line without words is blank
and is neither compared nor deleted. A hash has 64 bits, of which 6 hold the number of
words up to 63.

Defined results: null and empty texts, and documents without an id, are left as they
are. Rows with one id are one document as far as pairs go. Repeats within a document
stay. A document that loses all its lines with words is dropped with
``drop_emptied``, otherwise its blank lines are left. Other columns are kept.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewright.llm.arrow import with_arrow_columns
from platewright.session import shared_folder

RARE = 16
#: Numbers of different frequent units of a document up to which it is a partner of its own.
FEW = (1, 2, 4)
#: Words that a block needs to be deleted.
BLOCK_WORDS = 5
SPACE = b" \t\r\f\v"


def line_hashes(text: str) -> list[int]:
    """A hash for each line, 0 for a blank one; the lowest 6 bits have its words."""
    from xxhash import xxh64_intdigest

    found = []
    for line in text.encode().split(b"\n"):
        line = line.strip(SPACE)
        found.append(xxh64_intdigest(line) & ~63 | min(len(line.split()), 63) if line else 0)
    return found


def units(lines: list[int], block_words: int) -> list[tuple[int, int, int]]:
    """Hash, line and last line of each unit."""
    from xxhash import xxh64_intdigest

    found, last = [], -1
    for n, h in enumerate(lines):
        if not h:
            continue
        if h & 63 >= block_words:
            found.append((h, n, n))
        if last >= 0 and min(h & 63, lines[last] & 63) < block_words:
            both = xxh64_intdigest(lines[last].to_bytes(8, "big") + h.to_bytes(8, "big"))
            found.append((both, last, n))
        last = n
    return found


def sequences(docs: DataFrame, block_words: int = BLOCK_WORDS, doc_id: str = "doc_id",
              text: str = "text") -> DataFrame:
    """``doc_id``, ``lines`` (array of hashes) and ``units`` of documents with an id and a text."""

    def make():
        unit = pa.list_(pa.struct([("h", pa.int64()), ("line", pa.int32()), ("last", pa.int32())]))

        def hashes(batch: pa.RecordBatch) -> list:
            lists, found = [], []
            for text in batch.column("text").to_pylist():
                lines = line_hashes(text)
                lists.append(np.array(lines, np.uint64).view(np.int64))
                found += [units(lines, block_words)]
            sizes = np.cumsum([0, *map(len, found)])
            flat = np.array([u for one in found for u in one], object).reshape(-1, 3)
            struct = pa.StructArray.from_arrays(
                [pa.array(flat[:, 0].astype(np.uint64).view(np.int64)), pa.array(flat[:, 1].astype(np.int32)),
                 pa.array(flat[:, 2].astype(np.int32))], fields=list(unit.value_type))
            return [pa.array(lists, pa.list_(pa.int64())),
                    pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), struct)]

        return hashes

    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    own = own.where("doc_id IS NOT NULL AND text IS NOT NULL")
    unit = T.StructType([T.StructField("h", T.LongType()), T.StructField("line", T.IntegerType()),
                         T.StructField("last", T.IntegerType())])
    added = T.StructType([T.StructField("lines", T.ArrayType(T.LongType())), T.StructField("units", T.ArrayType(unit))])
    return with_arrow_columns(own, added, make).drop("text")


def longest_rising(values: list[int]) -> list[int]:
    """Places of a longest strictly rising subsequence."""
    tails, at, before = [], [], []
    for n, v in enumerate(values):
        k = bisect_left(tails, v)
        before.append(at[k - 1] if k else -1)
        tails[k : k + 1] = [v]
        at[k : k + 1] = [n]
    chain, n = [], at[-1] if at else -1
    while n >= 0:
        chain.append(n)
        n = before[n]
    return chain[::-1]


def _once(values: list[int], low: int, high: int) -> dict[int, int]:
    places: dict[int, int] = {}
    twice = set()
    for n in range(low, high):
        if places.setdefault(values[n], n) != n:
            twice.add(values[n])
    return {v: n for v, n in places.items() if v not in twice}


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of places of the aligned values, rising in both."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_b = _once(b, b0, b1)
        both = [(n, in_b[v]) for v, n in _once(a, a0, a1).items() if v in in_b]
        both.sort()
        fixed = [both[n] for n in longest_rising([y for _, y in both])]
        if fixed:
            ends = [(a0 - 1, b0 - 1), *fixed, (a1, b1)]
            found += fixed
            todo += [(x + 1, x2, y + 1, y2) for (x, y), (x2, y2) in zip(ends, ends[1:])]
    return sorted(found)


def aligned_blocks(a: np.ndarray, b: np.ndarray, block_words: int = BLOCK_WORDS) -> list[int]:
    """Line numbers of ``b`` in aligned blocks of enough words; blank lines don't part a block."""
    places_a = np.flatnonzero(np.isin(a, b) & (a != 0))
    places_b = np.flatnonzero(np.isin(b, a) & (b != 0))
    rank_a, rank_b = np.cumsum(a != 0), np.cumsum(b != 0)
    pairs = patience(a[places_a].tolist(), b[places_b].tolist())
    deleted, block, words, last = [], [], 0, None
    for x, y in [*pairs, (None, None)]:
        at = None if x is None else (int(rank_a[places_a[x]]), int(rank_b[places_b[y]]))
        if last and (at is None or (at[0] - last[0], at[1] - last[1]) != (1, 1)):
            deleted += block if words >= block_words else []
            block, words = [], 0
        if at:
            block.append(int(places_b[y]))
            words += int(b[places_b[y]]) & 63
        last = at
    return deleted


def shared_units(lines: DataFrame) -> DataFrame:
    """``h``, ``doc_id``, ``line``, ``last``, ``n`` and ``first``: the units that occur
    more than once, with how often and the smallest id."""
    every = lines.select("doc_id", F.expr("inline(units)"))
    counts = every.groupBy("h").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where("n > 1")
    # Written, so that the join shuffles both sides anew and can split a unit that very many have.
    return every.join(counts.checkpoint(), "h")


def line_pairs(shared: DataFrame, rare: int = RARE) -> DataFrame:
    """``a`` < ``b``: the documents to align."""
    few = shared.where(F.col("n") <= rare).groupBy("h").agg(F.sort_array(F.collect_set("doc_id")).alias("d"))
    few = few.select(F.explode("d").alias("a"), "d").select("a", F.explode("d").alias("b")).where("a < b")
    frequent = shared.where(F.col("n") > rare)
    by_first = frequent.select(F.col("first").alias("a"), F.col("doc_id").alias("b")).where("a < b")
    keys = contexts(frequent).checkpoint()
    firsts = keys.where("named").groupBy("context").agg(F.min("doc_id").alias("a"))
    # Written, so that the join shuffles both sides anew and can split a context that very many have.
    by_context = keys.join(firsts.checkpoint(), "context")
    by_context = by_context.select("a", F.col("doc_id").alias("b")).where("a < b")
    return by_first.unionByName(by_context).unionByName(few).distinct()


def contexts(frequent: DataFrame) -> DataFrame:
    """``doc_id``, ``context`` and ``named``: hashes of each occurrence with how often its document has
    the unit before it (if it has), with the frequent units next to it, either and both, and
    with each of ``FEW``. The document is ``named`` by the contexts that hold for it."""
    own = Window.partitionBy("doc_id").orderBy("line", "last")
    before, after = F.lag("h").over(own), F.lead("h").over(own)
    times = F.row_number().over(Window.partitionBy("doc_id", "h").orderBy("line", "last"))
    found = frequent.select("doc_id", "h", "line", "last").withColumns({"before": before, "after": after, "times": times})
    found = found.withColumn("different", F.sum((F.col("times") == 1).cast("int")).over(Window.partitionBy("doc_id")))
    few = [F.struct(F.xxhash64(F.lit("few"), "h", F.lit(c)).alias("context"), (F.col("different") <= c).alias("named")) for c in FEW]
    near = F.transform(F.filter(F.array(
        F.when(F.col("times") > 1, F.xxhash64(F.lit("times"), "h", "times")),
        F.when(F.col("before").isNotNull(), F.xxhash64(F.lit("before"), "before", "h")),
        F.when(F.col("after").isNotNull(), F.xxhash64(F.lit("after"), "h", "after")),
        F.when(F.col("before").isNotNull() & F.col("after").isNotNull(),
               F.xxhash64(F.lit("both"), "before", "h", "after")),
    ), lambda x: x.isNotNull()), lambda x: F.struct(x.alias("context"), F.lit(True).alias("named")))
    return found.select("doc_id", F.inline(F.concat(near, F.array(*few)))).distinct()


def deleted_lines(docs: DataFrame, rare: int = RARE, block_words: int = BLOCK_WORDS,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``deleted`` (numbers of lines, from 0) of documents that lose some."""
    shared_folder(docs.sparkSession)
    all_lines = sequences(docs, block_words, doc_id, text).checkpoint()
    same = [F.xxhash64("lines").alias("key"), F.size("lines").alias("n_lines")]
    classes = all_lines.select("doc_id", *same).groupBy("key", "n_lines").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Only classes of several, and written, so that the join can split one of very many.
    own = all_lines.select("*", *same).join(classes.checkpoint(), ["key", "n_lines"], "left").select(
        "doc_id", F.coalesce("first", "doc_id").alias("first"), "lines", "units")
    # Written, so that the joins of pairs shuffle both sides anew and can split a document that
    # very many others have as their partner.
    firsts = own.where("doc_id = first").select("doc_id", "lines", "units").dropDuplicates(["doc_id"]).checkpoint()

    shared = shared_units(firsts).checkpoint()
    pairs, firsts = line_pairs(shared, rare), firsts.drop("units")
    # The earlier side last: what is shuffled once more is the later one's lines, whose partners are
    # bounded by its own units, and not those of a document that very many others begin with.
    sides = pairs.join(firsts.toDF("b", "lines_b"), "b").join(firsts.toDF("a", "lines_a"), "a")

    def align(batches):
        for batch in batches:
            first, second = batch.column("lines_a"), batch.column("lines_b")
            found = [
                aligned_blocks(x.values.to_numpy(), y.values.to_numpy(), block_words) for x, y in zip(first, second)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("b"), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "deleted"]
            )

    aligned = sides.select("b", "lines_a", "lines_b").mapInArrow(align, T.StructType([
        T.StructField("doc_id", firsts.schema["doc_id"].dataType), T.StructField("deleted", T.ArrayType(T.IntegerType())),
    ]))
    aligned = aligned.select("doc_id", F.explode("deleted").alias("line")).distinct()
    aligned = aligned.groupBy("doc_id").agg(F.sort_array(F.collect_list("line")).alias("deleted"))

    copies = own.where("doc_id > first").dropDuplicates(["doc_id"]).select(
        "doc_id",
        F.expr("filter(transform(lines, (x, i) -> if(x = 0, -1, i)), x -> x >= 0)").alias("deleted"),
        F.expr("aggregate(lines, 0L, (s, x) -> s + (x & 63L))").alias("words"),
    )
    return aligned.unionByName(copies.where(F.col("words") >= block_words).drop("words"))


def without_lines(docs: DataFrame, deleted: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  drop_emptied: bool = True) -> DataFrame:
    """``docs`` with the ``deleted`` lines taken out of the texts."""
    columns = docs.columns
    packed = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("doc_id"))
    packed = packed.join(deleted.select("doc_id", "deleted"), "doc_id", "left")
    packed = packed.select("row", F.col(f"row.`{text}`").alias("text"), "deleted")

    def make():
        def cut(batch: pa.RecordBatch) -> list:
            texts, left = [], []
            for t, numbers in zip(batch.column("text").to_pylist(), batch.column("deleted")):
                if t is not None and numbers.is_valid:
                    gone = set(numbers.values.to_pylist())
                    t = "\n".join([x for n, x in enumerate(t.split("\n")) if n not in gone])
                    left.append(bool(t.strip(" \t\n\r\f\v")))
                else:
                    left.append(True)
                texts.append(t)
            return [texts, left]

        return cut

    added = T.StructType([T.StructField("text", T.StringType()), T.StructField("left", T.BooleanType())])
    done = with_arrow_columns(packed, added, make)
    if drop_emptied:
        done = done.where("left")
    return done.select(*[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in columns])
