"""Image numbers, and bringing them onto the object tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.wells import with_wells
from ..schema import IMAGE_KEYS, PLATE, SEQ
from .joins import split_left_join
from .ranking import dense_number, present


def image_keys(index: DataFrame, plate_type: int = 96, given: DataFrame | None = None) -> DataFrame:
    """One row per image: keys, ImageNumber, well columns and index row count.

    Images are numbered 1..n per plate in the order they are first seen, by
    ``seq``. An index without ``seq`` is numbered by Row, Column, Field. Rows
    with a NULL key are passed over. Images in ``given`` (keys and ImageNumber of earlier
    times) keep their numbers, and new ones go on after the largest of their plate; numbers
    of images that are gone are not given again.
    """
    if SEQ not in index.columns:
        by_position = F.shiftleft("Row", 42) + F.shiftleft("Column", 21) + F.col("Field")
        index = index.withColumn(SEQ, by_position)
    images = (
        present(index, IMAGE_KEYS)
        .groupBy(*IMAGE_KEYS)
        .agg(F.min(SEQ).alias("first_seq"), F.count("*").alias("index_rows"))
    )
    if given is None:
        return with_wells(dense_number(images, [PLATE], "first_seq", "ImageNumber", ties=IMAGE_KEYS), plate_type)
    kept = images.join(given.select(*IMAGE_KEYS, "ImageNumber"), IMAGE_KEYS)
    new = images.join(given.select(*IMAGE_KEYS), IMAGE_KEYS, "left_anti")
    largest = given.groupBy(PLATE).agg(F.max("ImageNumber").alias("_largest"))
    new = dense_number(new, [PLATE], "first_seq", "ImageNumber", ties=IMAGE_KEYS).join(largest, PLATE, "left")
    new = new.withColumn("ImageNumber", F.col("ImageNumber") + F.coalesce("_largest", F.lit(0))).drop("_largest")
    return with_wells(kept.unionByName(new), plate_type)


def number_index(index: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """Every index row with its ImageNumber (NULL where a key is NULL)."""
    images = image_keys(index) if images is None else images
    counts = images.select(*IMAGE_KEYS, F.col("index_rows").alias("n"))
    return split_left_join(index, images.select(*IMAGE_KEYS, "ImageNumber"), IMAGE_KEYS, counts)


def attach_keys(
    objects: DataFrame, images: DataFrame, plate_type: int = 96, small: bool = False
) -> DataFrame:
    """Objects with ImageNumber and the well columns; one row per object.

    The wells come from the object's own Row and Column, so an object without
    an image keeps them. ``small`` says that ``images`` has been found small
    enough to broadcast (``joins.is_small``); the objects then stay where they
    are. Otherwise both sides are shuffled, hot images in parts.
    """
    numbers = images.select(*IMAGE_KEYS, "ImageNumber")
    if small:
        joined = objects.join(F.broadcast(numbers), IMAGE_KEYS, "left")
        joined = joined.select(*objects.columns, "ImageNumber")
    else:
        joined = split_left_join(objects, numbers, IMAGE_KEYS)
    return with_wells(joined, plate_type)


# Bytes of text, and plates, that a task of ``attach_keys_by_plate`` has on average at most.
TASK_BYTES, TASK_PLATES = 64 << 20, 500


def attach_keys_by_plate(objects: DataFrame, images: DataFrame, parts: DataFrame, plate_type: int = 96) -> DataFrame:
    """``attach_keys`` for many plates, with one shuffle of the objects that leaves each plate
    in as many tasks as it has ``_parts``, or fewer (a row per plate, also with the ``_bytes`` of its text).
    A task has many small plates: tasks grow in number with the text, not with the plates.

    Objects and image keys are both cut by plate and part, and the join, which is on more
    columns than those, takes them as they lie. ``objects`` must come straight from files
    or a written table: the part is that of the row's place in its split.
    """
    spark = objects.sparkSession
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    parts = F.broadcast(parts)  # a row per plate whose files the driver has listed
    size = F.sum("_bytes") if "_bytes" in parts.columns else F.sum("_parts") * TASK_BYTES
    plates, text = parts.agg(F.count("*"), size).first()
    total = math.ceil((text or 0) / TASK_BYTES) + math.ceil(plates / TASK_PLATES)
    total += int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = parts.drop("_bytes")
    by = [PLATE, "_part"]
    left = objects.withColumn("_place", F.monotonically_increasing_id()).join(parts, PLATE, "left")
    left = left.withColumn("_part", F.pmod("_place", F.coalesce("_parts", F.lit(1)))).drop("_place", "_parts").repartition(total, *by)
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1)) - 1))
    right = images.select(*IMAGE_KEYS, "ImageNumber").join(parts, PLATE).withColumn("_part", each).drop("_parts").repartition(total, *by)
    joined = left.join(right.hint("merge"), [*by, *IMAGE_KEYS[1:]], "left").select(*objects.columns, "ImageNumber")
    return with_wells(joined, plate_type)


def fanout_counts(objects: DataFrame, index: DataFrame, by: Sequence[str]) -> DataFrame:
    """Object rows before and after two joins to the raw index.

    The index has one row per channel, plane and timepoint, so each join
    multiplies an object by its image's index rows. The copies are counted
    per image and never made.
    """
    per_image = objects.groupBy(*by, *IMAGE_KEYS).agg(F.count("*").alias("_n"))
    rows = index.dropna(subset=IMAGE_KEYS).groupBy(*IMAGE_KEYS).agg(F.count("*").alias("_k"))
    copies = F.coalesce(F.col("_k"), F.lit(1))
    return (
        per_image.join(rows, IMAGE_KEYS, "left")
        .groupBy(*by)
        .agg(F.sum("_n").alias("n_objects"), F.sum(F.col("_n") * copies * copies).alias("n_joined"))
    )


def unmatched_counts(objects: DataFrame, images: DataFrame, by: Sequence[str]) -> DataFrame:
    """Objects without an image, counted per ``by``; counted before the join."""
    per_image = objects.groupBy(*by, *IMAGE_KEYS).agg(F.count("*").alias("_n"))
    return (
        per_image.join(images.select(*IMAGE_KEYS), IMAGE_KEYS, "left_anti")
        .groupBy(*by)
        .agg(F.sum("_n").alias("n_unmatched"))
    )


def rename_object_columns(objects: DataFrame, population: str) -> DataFrame:
    """ObjectNo, X, Y (and Z) under their population names, at the end."""
    renames = {
        "ObjectNo": f"{population}_Number_Object_Number",
        "X": f"{population}_Location_Center_X",
        "Y": f"{population}_Location_Center_Y",
        "Z": f"{population}_Location_Center_Z",
    }
    present = {old: new for old, new in renames.items() if old in objects.columns}
    kept = [c for c in objects.columns if c not in present]
    return objects.select(*kept, *[F.col(old).alias(new) for old, new in present.items()])


def add_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add NULL columns of the given types; present ones stay as they are."""
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df
