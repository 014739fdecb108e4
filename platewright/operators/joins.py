"""Left joins of a large table to a table that is unique on the keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key with more rows than this, and with more than this part of all rows, is
# spread over several tasks. The part bounds the number of such keys.
SPLIT_ROWS = 1_000_000
SPLIT_PART = 1 / 10_000
# Largest table that is broadcast, in bytes of its values.
MAX_BROADCAST_BYTES = 128 << 20
# Times of a key that an as-of join orders together.
ASOF_SPAN = 1 << 16


def hot_keys(counts: DataFrame, keys: Sequence[str], split_rows: int = SPLIT_ROWS) -> DataFrame:
    """All keys with too many rows, and the number of parts to cut each into.

    ``counts`` has one row per key with its row count in ``n``. There are fewer
    than 1 / ``SPLIT_PART`` such keys, whatever the size of the table.
    """
    total = counts.select(F.sum("n")).scalar()
    many = F.greatest(F.lit(split_rows), F.ceil(total * SPLIT_PART))
    return (
        counts.withColumn("_many", many)
        .filter(F.col("n") > F.col("_many"))
        .select(*keys, F.ceil(F.col("n") / F.col("_many")).alias("_parts"))
    )


def split_left_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    counts: DataFrame | None = None,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """``facts LEFT JOIN dim`` where ``dim`` is unique on ``keys``.

    Hot keys are cut into parts: their fact rows get a part number, their dim
    row one copy per part. Only the list of hot keys is broadcast, and it is
    bounded (``SPLIT_PART``). Rows with a NULL key match nothing and are
    spread out. ``facts`` must come straight from files or a written table:
    the part comes from the row's place in its input split, which then is the
    same when a task runs again (a hash of the row would not split copies).
    """
    keys = list(keys)
    if counts is None:
        counts = facts.groupBy(*keys).agg(F.count("*").alias("n"))
    hot = F.broadcast(hot_keys(counts.dropna(subset=keys), keys, split_rows))
    place = F.monotonically_increasing_id()
    part = (
        F.when(_any_null(keys), F.col("_place"))
        .when(F.col("_parts").isNotNull(), F.pmod("_place", "_parts"))
        .otherwise(F.lit(0).cast("bigint"))
    )
    left = (
        facts.withColumn("_place", place)
        .join(hot, keys, "left")
        .withColumn("_part", part)
        .drop("_place", "_parts")
    )
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1)) - 1)
    right = (
        dim.join(hot, keys, "left").withColumn("_part", F.explode(copies)).drop("_parts")
    )
    added = [c for c in dim.columns if c not in keys]
    return left.join(right, [*keys, "_part"], "left").select(*facts.columns, *added)


def is_small(dim: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a table may be broadcast, by the bytes of its values.

    For written tables, where one more reading is cheap.
    """
    return (dim.agg(F.sum(_row_bytes(dim))).first()[0] or 0) <= max_bytes


def _row_bytes(dim: DataFrame) -> Column:
    """About the bytes of a row's values; of arrays, maps and structs those of their text."""
    size = F.lit(16 * len(dim.columns))
    for name, kind in dim.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0))
    return size


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, value: str, span: int = ASOF_SPAN
) -> DataFrame:
    """``left`` with ``value`` of the last row of ``right`` at or before its ``time``, by key.

    Both have the keys and a whole-number ``time``; of several rows of ``right`` with one
    key and time the largest value counts. Rows with a NULL key or time get NULL. Both sides are put
    in one order per key, so there is no range join; a key with many times is cut into
    spans of them, and the last value before each span is found from one row per span.
    ``left`` should have few rows with one key and time: they are ordered together.
    """
    keys, spans = list(keys), [*keys, "_span"]
    cut = F.floor(F.col(time) / span)
    latest = right.dropna(subset=[*keys, time]).groupBy(*keys, time).agg(F.max(value).alias("_value"))
    latest = latest.withColumn("_span", cut)
    rows = left.withColumn("_span", cut)
    # The last value of each span, and before it.
    last = latest.groupBy(*spans).agg(F.max_by("_value", time).alias("_last"))
    wanted = rows.select(*spans).dropna().distinct().withColumn("_last", F.lit(None).cast(latest.schema["_value"].dataType))
    by_span = last.unionByName(wanted).groupBy(*spans).agg(F.max("_last").alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    before = by_span.select(*spans, F.last("_last", ignorenulls=True).over(earlier).alias("_before")).filter("_before is not null")
    # Within a span: a value counts for what is at its time or later.
    marked = rows.withColumn("_left", F.lit(1)).unionByName(latest.withColumn("_left", F.lit(0)), allowMissingColumns=True)
    upto = Window.partitionBy(*spans).orderBy(time, "_left").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = marked.withColumn("_within", F.last("_value", ignorenulls=True).over(upto)).filter("_left = 1")
    found = found.join(before, spans, "left")
    known = F.when(F.col(time).isNotNull(), F.coalesce("_within", "_before")).alias(value)
    return found.select(*left.columns, known)


def _any_null(keys: Sequence[str]) -> Column:
    null = F.col(keys[0]).isNull()
    for key in keys[1:]:
        null = null | F.col(key).isNull()
    return null


def fill_if_null(
    df: DataFrame, new: DataFrame, keys: Sequence[str], column: str, value: str
) -> DataFrame:
    """Set ``column`` from ``new.value`` by key, only where it is still NULL."""
    joined = df.join(new.select(*keys, F.col(value).alias("_new")), list(keys), "left")
    return joined.withColumn(column, F.coalesce(F.col(column), F.col("_new"))).select(*df.columns)
