"""Shards of near equal bytes by a k-d tree over the documents' metadata.

All rows start in one node. Each level cuts every node across the dimension along
which it is widest, relative to the whole table, at the weighted median (or where the
bytes part as the numbers of leaves on the two sides do), until a node's leaves are
one. Medians are exact to a small part of the node and found without gathering rows:
sums of weights by 1,024 ranges of the node's values, then by 1,024 ranges of the
range that holds the median, and so on. The driver sees a row per node.

A dimension's value is a number of 40 bits followed by 22 bits of a hash of the row,
so that a value that many rows share is cut too; no group has to stay whole.

Numbers are taken as they are (0 for null, negative numbers as 0, at most 2**40 - 1), texts
by their first five bytes. Slots number the rows of a shard without gaps; they are
counted by buckets of a hash, so no shard is sorted in one task.

Defined results: a null text has 0 bytes and weighs 1; repeated rows are rows of
their own; an empty table gives an empty result. Other columns are kept; a column with
the name of an added one is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from platewright.session import shared_folder

TIE_BITS, RANGES = 22, 1024
#: A cut may miss its place by so large a part of the node.
TOLERANCE = 1 / 4096
BUCKET_ROWS = 4096


def number(value: Column) -> Column:
    """A numeric column as 40 bits that keep its order."""
    return F.greatest(F.lit(0), F.least(F.coalesce(value.cast("long"), F.lit(0)), F.lit((1 << 40) - 1)))


def prefix(value: Column) -> Column:
    """The first five bytes of a text as 40 bits."""
    hexed = F.rpad(F.substring(F.hex(F.coalesce(value, F.lit("")).cast("binary")), 1, 10), 10, "0")
    return F.conv(hexed, 16, 10).cast("long")


@dataclass
class Node:
    """Leaves ``first`` to ``first + leaves - 1``; the search for its cut."""

    first: int
    leaves: int
    dim: int = -1
    low: int = 0
    step: int = 1
    below: int = 0
    goal: float = 0.0
    total: int = 0
    cut: int | None = None


def with_shards(rows: DataFrame, dims: dict[str, Column], weight: Column, leaves: int | None = None,
                target_bytes: int | None = None) -> DataFrame:
    """Adds ``shard`` (from 0), for a number of ``leaves`` or as many as need ``target_bytes`` each."""
    spark = rows.sparkSession
    shared_folder(spark)
    keep = [c for c in rows.columns if c.lower() not in ("shard",)]
    tie = F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{c}`") for c in keep]), 64 - TIE_BITS)
    keys = [(F.shiftleft(value, TIE_BITS) + tie).alias(f"_d{n}") for n, value in enumerate(dims.values())]
    names = [f"_d{n}" for n in range(len(dims))]
    points = rows.select(*[F.col(f"`{c}`") for c in keep], weight.cast("long").alias("_w"), F.lit(0).alias("_n"), *keys)
    points = points.checkpoint()

    whole = _extents(points, names).first()
    if whole is None:
        return points.select(*keep, F.lit(0).alias("shard"))
    if leaves is None:
        leaves = max(1, -(-whole["w"] // target_bytes))
    spans = [max(1, (whole[f"high{n}"] >> TIE_BITS) - (whole[f"low{n}"] >> TIE_BITS)) for n in range(len(names))]
    nodes = {0: Node(0, leaves)}
    while any(node.leaves > 1 for node in nodes.values()):
        open_ = {i: node for i, node in nodes.items() if node.leaves > 1}
        for row in _extents(points, names).where(F.col("_n").isin(list(open_))).collect():
            _aim(open_[row["_n"]], row, spans)
        open_ = {i: node for i, node in open_.items() if node.dim >= 0}
        todo = dict(open_)
        while todo:
            for row in _ranges(points, todo, names).collect():
                node = todo[row["_n"]]
                if _narrow(node, row):
                    del todo[row["_n"]]
        cuts = _table(spark, {i: (node.first + node.leaves // 2, node.dim, node.cut) for i, node in open_.items()},
                      "right", "dim", "cut")
        points = points.join(F.broadcast(cuts), "_n", "left")
        above = F.expr(f"array({', '.join(names)})[dim] >= cut")
        points = points.withColumn("_n", F.when(above, F.col("right").cast("int")).otherwise(F.col("_n")))
        points = points.drop("right", "dim", "cut").checkpoint()
        halves = {}
        for node in nodes.values():
            left = node.leaves // 2
            if node.leaves == 1 or node.dim < 0:
                halves[node.first] = Node(node.first, 1)
            else:
                halves[node.first] = Node(node.first, left)
                halves[node.first + left] = Node(node.first + left, node.leaves - left)
        nodes = halves
    return points.select(*[f"`{c}`" for c in keep], F.col("_n").alias("shard"))


def _extents(points: DataFrame, names: list[str]) -> DataFrame:
    ends = [f(c).alias(f"{a}{n}") for n, c in enumerate(names) for f, a in ((F.min, "low"), (F.max, "high"))]
    return points.groupBy("_n").agg(F.sum("_w").alias("w"), *ends)


def _aim(node: Node, row, spans: list[int]) -> None:
    widths = [((row[f"high{n}"] >> TIE_BITS) - (row[f"low{n}"] >> TIE_BITS)) / s for n, s in enumerate(spans)]
    node.dim = max(range(len(spans)), key=lambda n: (widths[n], row[f"high{n}"] - row[f"low{n}"], -n))
    node.low, high = row[f"low{node.dim}"], row[f"high{node.dim}"]
    node.step = max(1, -(-(high - node.low + 1) // RANGES))
    node.total, node.below = row["w"], 0
    node.goal = row["w"] * (node.leaves // 2) / node.leaves


def _table(spark, rows: dict[int, tuple], *names: str) -> DataFrame:
    """A row per node: bounded by the number of shards."""
    schema = T.StructType([T.StructField("_n", T.IntegerType())] + [T.StructField(n, T.LongType()) for n in names])
    return spark.createDataFrame([(i, *values) for i, values in rows.items()], schema)


def _ranges(points: DataFrame, todo: dict[int, Node], names: list[str]) -> DataFrame:
    """For each node the range of values in which the goal is reached: ``at``, the
    weight ``w`` in it and ``before`` it."""
    aims = _table(points.sparkSession, {i: (n.dim, n.low, n.step, int(n.goal) - n.below) for i, n in todo.items()},
                  "dim", "low", "step", "goal")
    key = f"array({', '.join(names)})[dim]"
    sums = (
        points.join(F.broadcast(aims), "_n").where(f"{key} >= low")
        .withColumn("at", F.expr(f"({key} - low) div step")).where(f"at < {RANGES}")
        .groupBy("_n", "at").agg(F.sum("_w").alias("w"), F.first("goal").alias("goal"))
    )
    run = Window.partitionBy("_n").orderBy("at")
    sums = sums.withColumn("through", F.sum("w").over(run)).withColumn("before", F.col("through") - F.col("w"))
    sums = sums.withColumn("last", F.max("through").over(Window.partitionBy("_n")))
    return sums.where("before <= least(goal, last - 1) AND through > least(goal, last - 1)").select("_n", "at", "w", "before")


def _narrow(node: Node, row) -> bool:
    """Takes up the range that holds the goal; true once the cut is found."""
    before, through = node.below + row["before"], node.below + row["before"] + row["w"]
    start = node.low + row["at"] * node.step
    if node.step == 1 or row["w"] <= node.total * TOLERANCE:
        node.cut = start if node.goal - before <= through - node.goal else start + node.step
        return True
    node.low, node.below = start, before
    node.step = max(1, -(-node.step // RANGES))
    return False


def with_slots(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``slot``, a number of the row in its ``shard``, without gaps from 0."""
    n = rows.count()
    buckets = max(1, n // BUCKET_ROWS)
    rows = rows.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("shard", "_b").agg(F.count("*").alias("_c"))
    run = Window.partitionBy("shard").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_b", F.coalesce(F.sum("_c").over(run), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("shard", "_b").orderBy(*order))
    rows = rows.withColumn("_place", place).join(starts, ["shard", "_b"])
    return rows.withColumn("slot", F.col("_start") + F.col("_place") - 1).drop("_b", "_start", "_place")


def write_shards(docs: DataFrame, shards: DataFrame, path: str, doc_id: str = "doc_id") -> None:
    """The documents in folders by shard; ``shards`` has a row per document id."""
    placed = docs.join(shards.select(doc_id, "shard"), doc_id)
    placed.repartition("shard", F.pmod(F.xxhash64(doc_id), F.lit(64))).write.partitionBy("shard").parquet(path)
