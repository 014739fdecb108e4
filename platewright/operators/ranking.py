"""Dense numbers and medians without one task per group.

Numbering or ranking rows with one window per group puts a whole group into
one task. To number rows, a key is cut twice (by 42 and by 21 bits), rows are
counted per bucket, and offsets are running sums over buckets. No window then
sees more than 2**22 rows, whatever the size of the group. For medians, quantile
summaries leave a few thousandths of a group to rank. Both results are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder

# Of quantile summaries: ranks are right to 1 / ACCURACY of a group.
ACCURACY = 10_000
FINE_BITS = 21
COARSE_BITS = 42


def _buckets(key: Column) -> dict[str, Column]:
    """Bucket numbers of a key that is never NULL.

    Declared so, the joins on them add no filters, and the branches of a plan
    that count buckets and that rank rows share what is below them.
    """
    none = F.lit(0).cast("bigint")
    return {
        "_coarse": F.coalesce(F.shiftright(key, COARSE_BITS), none),
        "_fine": F.coalesce(F.shiftright(key, FINE_BITS), none),
    }


def present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without NULL in the columns, said column by column for the optimizer."""
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def _rows_before(n: str, partition: Sequence[str], order: str) -> Column:
    """Sum of ``n`` over the earlier rows of the partition, 0 for the first."""
    window = Window.partitionBy(*partition).orderBy(order)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(earlier), F.lit(0))


def dense_number(
    df: DataFrame, group: Sequence[str], order: str, name: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Add ``name``: 1..n per group, without gaps, by the whole number ``order``.

    ``order`` should be (nearly) unique within a group; ``ties`` settle the rest.
    """
    keys = list(group) or ["_all"]
    rows = df.withColumns(_buckets(F.col(order)))
    if not group:
        rows = rows.withColumn("_all", F.lit(0))
    bucket = [*keys, "_coarse", "_fine"]

    fine = rows.groupBy(*bucket).agg(F.count("*").alias("_n"))
    coarse = fine.groupBy(*keys, "_coarse").agg(F.sum("_n").alias("_n"))
    coarse = coarse.select(
        *keys, "_coarse", _rows_before("_n", keys, "_coarse").alias("_before_coarse")
    )
    offsets = (
        fine.withColumn("_before_fine", _rows_before("_n", [*keys, "_coarse"], "_fine"))
        .join(coarse, [*keys, "_coarse"])
        .select(*bucket, (F.col("_before_fine") + F.col("_before_coarse")).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy(*bucket).orderBy(order, *ties))
    return (
        rows.join(offsets, bucket)
        .withColumn(name, (within + F.col("_before")).cast("bigint"))
        .select(*df.columns, name)
    )


def grouped_medians(
    df: DataFrame, group: Sequence[str], columns: Sequence[str], more: Sequence[Column] = ()
) -> DataFrame:
    """Exact interpolated medians of several columns: a row per group with ``_group`` (a
    struct), the aggregates in ``more``, and ``n_<c>`` and ``median_<c>`` per column.

    Two readings. The first makes a quantile summary of bounded size per group and
    column, whose error is known: it gives two values that the median lies between.
    The second counts what is below them, and counts each value between them, which
    are a few thousandths of a group; only those are ranked. Nulls and NaN don't count.
    The group is one struct, which is never NULL itself, so groups with a NULL in them
    are kept by the join.
    """
    shared_folder(df.sparkSession)
    df = df.withColumn("_group", F.struct(*group))
    values = {c: F.when(~F.isnan(c), F.col(c)) for c in columns}
    margin = 2 / ACCURACY
    around = F.array(F.lit(0.5 - margin), F.lit(0.5 + margin))
    found = df.groupBy("_group").agg(
        *more, *[F.count(v).alias(f"n_{c}") for c, v in values.items()],
        *[F.percentile_approx(v, around, ACCURACY).alias(f"_between_{c}") for c, v in values.items()],
    )
    found = found.checkpoint()  # a row per group, read twice

    near = df.select("_group", *[v.alias(c) for c, v in values.items()]).join(
        found.select("_group", *[f"_between_{c}" for c in columns]), "_group")
    # Values below are all counted as NULL, values above not at all.
    entries = [
        F.when(F.col(c) <= F.get(f"_between_{c}", F.lit(1)), F.struct(
            F.lit(k).alias("column"),
            F.when(F.col(c) >= F.get(f"_between_{c}", F.lit(0)), F.col(c).cast("double")).alias("value"),
        ))
        for k, c in enumerate(columns)
    ]
    entry = F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("_entry")
    counted = near.select("_group", entry).groupBy("_group", "_entry.column", "_entry.value").agg(F.count("*").alias("_n"))
    sizes = F.array(*[F.col(f"n_{c}") for c in columns])
    ranked = counted.withColumn("_before", _rows_before("_n", ["_group", "column"], "value"))
    ranked = ranked.join(found.select("_group", sizes.alias("_sizes")), "_group")

    def holds(c: int, place: Column) -> Column:
        inside = (place >= F.col("_before")) & (place < F.col("_before") + F.col("_n"))
        return F.max(F.when((F.col("column") == c) & inside, F.col("value")))

    size = F.get("_sizes", F.col("column"))
    low, high = F.floor((size - 1) / 2), F.floor(size / 2)
    middles = ranked.groupBy("_group").agg(*[
        (holds(k, low) * 0.5 + holds(k, high) * 0.5).alias(f"median_{c}") for k, c in enumerate(columns)
    ])
    joined = found.join(middles, "_group", "left").drop(*[f"_between_{c}" for c in columns])
    missing = F.raise_error(F.lit("a median lies outside of its bounds")).cast("double")
    return joined.withColumns({
        f"median_{c}": F.when((F.col(f"n_{c}") > 0) & F.col(f"median_{c}").isNull(), missing).otherwise(F.col(f"median_{c}"))
        for c in columns
    })
