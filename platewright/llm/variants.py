"""Spelling variants of words by a dictionary of pairs of trie nodes.

The nodes of the trie of all words and of the trie of all reversed words are numbered.
A word that skips one of its positions leaves a beginning and an end, which are a pair
of numbers; a word cut at a place is such a pair as well. Words that differ in one
replaced letter share the pair of a skipped position, and a word with one letter more
has the pair at which the shorter one is cut. So equal pairs give exactly the words at
one edit, and no two strings are compared.

Numbering is done in sorted order, where the words below a node follow one another: a
word and the one before it share the nodes of their common beginning. Sorting spreads
words over tasks by ranges. Nodes that reach over the end of a range are beginnings of
the first word of a range; those words (one a task) are numbered beforehand and sent to
all tasks, and what else a task numbers is its own. A node with one word below it is in no
equal pair, and gets no number: a word has numbers only for the beginnings it shares.

A pair's words differ in one letter (and one may lack it), so there are no more of them
than letters in use. Each word gets from a pair its number of partners and the best one;
the partners are not written out. A word that lacks a letter of a run of equal letters
would meet the longer word at each of these; only the first of them counts.

Defined results: null words are left out, and counts of repeated words are added up (null
counts are 0). The empty word is a word. Words of any length are taken whole. An empty table
gives an empty table. Only the two named columns are used, so others cannot clash.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewright.llm.arrow import small_batches
from platewright.session import shared_folder

#: Numbers that a range of words may use; the lowest ones are those of its first words.
NUMBERS = 40
#: Words of which the pairs are sent on at once.
CHUNK = 5_000
NUMBERED = "word string, n long, rank long, nodes array<long>"
PAIRS = "head long, tail long, side tinyint, rank long, n long"
#: A word cut at a place, a word without a position, and the same where that is the first of equal letters.
CUT, SKIP, FIRST_SKIP = 0, 1, 2


def common(a: str, b: str) -> int:
    """The length of the common beginning."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size
    for i in range(0, size, 64):
        if a[i : i + 64] != b[i : i + 64]:
            break
    while a[i] == b[i]:
        i += 1
    return i


def first_nodes(firsts: list[str]) -> list[list[int]]:
    """The numbers of all beginnings of sorted words, from 0, the root, on."""
    found: list[list[int]] = []
    last, number = "", 1
    for word in firsts:
        shared = found[-1][: common(last, word) + 1] if found else [0]
        new = len(word) + 1 - len(shared)
        found.append(shared + list(range(number, number + new)))
        last, number = word, number + new
    return found


def numbered(rows: Iterator[tuple], firsts: list[str], nodes_of: list[list[int]]) -> Iterator[tuple]:
    """Rows that begin with a word, sorted, of whole ranges: each with the word's number
    in sorted order, and the numbers of those of its beginnings that another word has."""
    row = next(rows, None)
    last, nodes, range_of, used, place = None, [], -1, 0, 0
    while row is not None:
        word = row[0]
        k = bisect_right(firsts, word) - 1
        following = next(rows, None)
        if k != range_of:
            last, nodes, range_of, used, place = None, [], k, 0, 0
        after = firsts[k + 1] if k + 1 < len(firsts) else None
        here, there = common(word, firsts[k]), common(word, after) if after is not None else 0
        first = nodes_of[k] if here >= there else nodes_of[k + 1]
        depth = max(here, there)
        # What the first word of a range shares with the word before it is not known here.
        before = len(word) if last is None else common(last, word)
        next_shared = there if following is None else common(word, following[0])
        shared = max(before, next_shared)
        own = first[: min(depth, shared) + 1]
        if before > depth and last is not None:
            own = own + nodes[depth + 1 : before + 1]
        new = shared + 1 - len(own)
        low = ((k + 1) << NUMBERS) + used
        nodes = own + list(range(low, low + new))
        used += max(new, 0)
        yield row, ((k + 1) << NUMBERS) + place, nodes
        last, row, place = word, following, place + 1


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _chunks(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], size: int) -> Iterator[pa.RecordBatch]:
    columns: list[list] = [[] for _ in names]

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for row in rows:
        for column, value in zip(columns, row):
            column.append(value)
        if len(columns[0]) >= size:
            yield batch()
            columns = [[] for _ in names]
    if columns[0]:
        yield batch()


def _sorted(rows: DataFrame, by: str) -> tuple[DataFrame, list[str]]:
    """Rows in ranges of words, sorted, kept as they are; and the first word of each range."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared_folder(rows.sparkSession)
    ranges = rows.repartitionByRange(parts, by).sortWithinPartitions(by).checkpoint()
    firsts = ranges.groupBy(F.spark_partition_id()).agg(F.min(by).alias("first")).collect()
    return small_batches(ranges), sorted(r["first"] for r in firsts)


def pairs_of(word: str, n: int, rank: int, heads: list[int], tails: list[int]) -> Iterator[tuple]:
    """Pairs of numbers of a word's beginnings and ends, as far as both are shared."""
    size, last = len(word), len(tails) - 1
    for i in range(max(0, size - 1 - last), min(size, len(heads))):
        side = FIRST_SKIP if i == 0 or word[i] != word[i - 1] else SKIP
        yield heads[i], tails[size - 1 - i], side, rank, n
    for i in range(max(0, size - last), min(size + 1, len(heads))):
        yield heads[i], tails[size - i], CUT, rank, n


def node_pairs(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``word``, ``n`` and ``rank`` of each word, and the pairs of numbers of all words."""
    spark = words.sparkSession
    ranges, firsts = _sorted(words, "word")
    known = spark.sparkContext.broadcast((firsts, first_nodes(firsts)))

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((*row, rank, nodes) for row, rank, nodes in numbered(_rows(batches), *known.value))
        yield from _chunks(found, ["word", "n", "rank", "nodes"],
                           [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())], CHUNK)

    heads = ranges.mapInArrow(forward, NUMBERED)
    turned, lasts = _sorted(heads.select(F.reverse("word").alias("turned"), "n", "rank", "nodes"), "turned")
    known_lasts = spark.sparkContext.broadcast((lasts, first_nodes(lasts)))

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (
            pair for (word, n, rank, nodes), _, tails in numbered(_rows(batches), *known_lasts.value)
            for pair in pairs_of(word[::-1], n, rank, nodes, tails)
        )
        yield from _chunks(found, ["head", "tail", "side", "rank", "n"],
                           [pa.int64(), pa.int64(), pa.int8(), pa.int64(), pa.int64()], 10 * CHUNK)

    return turned.select(F.reverse("turned").alias("word"), "n", "rank"), turned.mapInArrow(backward, PAIRS)


def neighbours(pairs: DataFrame) -> DataFrame:
    """``rank``, ``n_near`` and the ``best`` of each word with a word at one edit: the most
    frequent, of ties the first."""
    member = F.struct("n", (-F.col("rank")).alias("back"), "side")
    groups = pairs.groupBy("head", "tail").agg(F.sort_array(F.collect_list(member), asc=False).alias("words"))
    groups = groups.filter(F.size("words") > 1)

    def of(sides: Column) -> Column:
        return F.filter("words", lambda w: w.side.isin(sides) if isinstance(sides, list) else w.side == sides)

    skips, firsts, cut = of([SKIP, FIRST_SKIP]), of(FIRST_SKIP), of(CUT)
    one = groups.select(
        F.size(skips).alias("skips"), F.size(firsts).alias("firsts"), F.get(firsts, F.lit(0)).alias("first"),
        F.get(skips, F.lit(0)).alias("top"), F.get(skips, F.lit(1)).alias("second"), F.get(cut, F.lit(0)).alias("cut"),
        F.explode("words").alias("w"),
    )
    other = F.when(F.col("w") == F.col("top"), F.col("second")).otherwise(F.col("top"))
    shorter = F.when(F.col("w.side") == FIRST_SKIP, F.col("cut"))
    is_cut = F.col("w.side") == CUT

    def key(member: Column) -> Column:
        return F.when(member.isNotNull(), F.struct(member["n"].alias("n"), member["back"].alias("back")))

    near = F.when(is_cut, F.col("firsts")).otherwise(F.col("skips") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0))
    best = F.when(is_cut, key(F.col("first"))).otherwise(F.greatest(key(other), key(shorter)))
    found = one.select((-F.col("w.back")).alias("rank"), near.alias("near"), best.alias("best")).filter("near > 0")
    return found.groupBy("rank").agg(F.sum("near").cast("long").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``rank`` and ``form`` followed to the last, each round twice as far as the one before.

    A form is more frequent than its word, so there is an end; and no more words have one
    form than there are words at one edit."""
    while True:
        more = forms.select(F.col("rank").alias("form"), F.col("form").alias("next"))
        step = forms.join(more, "form", "left").select("rank", F.coalesce("next", "form").alias("form"), "next").checkpoint()
        forms = step.drop("next")
        if step.filter("next is not null").isEmpty():
            return forms


def variants(words: DataFrame, word: str = "word", n: str = "n", ratio: int = 10) -> DataFrame:
    """``word``, ``n``, ``n_near`` (words at one edit), ``form`` (the most frequent of them, if
    more frequent and at least ``ratio`` times so), ``form_n``, and ``root`` (forms followed to the last)."""
    count = F.coalesce(F.col(n).cast("long"), F.lit(0).cast("long"))
    each = words.select(F.col(word).alias("word"), count.alias("n")).filter("word is not null")
    ranked, pairs = node_pairs(each.groupBy("word").agg(F.sum("n").alias("n")))
    near = neighbours(pairs)
    found = ranked.join(near, "rank", "left").withColumn(
        "form", F.when((F.col("best.n") >= ratio * F.col("n")) & (F.col("best.n") > F.col("n")), -F.col("best.back"))
    ).withColumn("form_n", F.when(F.col("form").isNotNull(), F.col("best.n"))).drop("best").checkpoint()
    last = roots(found.filter("form is not null").select("rank", "form"))
    names = ranked.select("rank", "word")
    formed = (
        found.filter("form is not null").select("rank", "form").join(last.withColumnRenamed("form", "last"), "rank")
        .join(names.toDF("form", "form_word"), "form").join(names.toDF("last", "last_word"), "last")
        .select("rank", F.col("form_word").alias("form"), F.col("last_word").alias("root"))
    )
    return found.drop("form").join(formed, "rank", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n",
        F.coalesce("root", "word").alias("root"),
    )
