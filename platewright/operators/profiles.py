"""Counts and means per image, median and deviation per well."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import prefixed_names
from ..schema import FILE, IMAGE_KEYS, PLATE, PROFILE_KEYS
from .images import flatten_images
from .ranking import grouped_medians


def mean(column: str, decimals: int | None = None) -> Column:
    """Mean of a column; with ``decimals`` through an exact decimal sum.

    The exact form gives the same bits in every run, whatever the order of the
    rows, for values of at most that many decimals.
    """
    if decimals is None:
        return F.avg(column)
    total = F.sum(F.col(column).cast(f"decimal(18,{decimals})")).cast("double")
    return total / F.nullif(F.count(column), F.lit(0))


def field_profile(
    objects: DataFrame,
    measures: Sequence[str],
    count_name: str,
    by: Sequence[str] = PROFILE_KEYS,
    decimals: int | None = None,
    prefix: str = "Per_Field",
) -> DataFrame:
    """Object count and all means per image, in one scan and one shuffle."""
    names = prefixed_names(measures, prefix)
    means = [mean(m, decimals).alias(n) for m, n in zip(measures, names)]
    return objects.groupBy(*by).agg(F.count("*").alias(count_name), *means)


def profile_states(
    objects: DataFrame, measures: Sequence[str], decimals: int, by: Sequence[str] = (*IMAGE_KEYS, FILE)
) -> DataFrame:
    """What counts and means are made of, by image and file: ``n``, and per measure the
    exact sum ``sum_<m>`` and the number of values ``n_<m>``.

    States add up in any order to the same bits, so a table of them is kept up to date by
    those of the files that came and went (``changed_states``)."""
    values = {m: F.col(m).cast(f"decimal(18,{decimals})") for m in measures}
    return objects.groupBy(*by).agg(
        F.count("*").alias("n"), *[F.sum(v).alias(f"sum_{m}") for m, v in values.items()],
        *[F.count(m).alias(f"n_{m}") for m in measures],
    )


def changed_states(states: DataFrame, gone: DataFrame, came: DataFrame) -> DataFrame:
    """States without those of the files in ``gone`` (by plate and file), and with those that ``came``.

    A file that changed is in both. Only the objects of files that came have been read."""
    keys = [PLATE, FILE]
    return states.join(gone.select(*keys).distinct(), keys, "left_anti").unionByName(came)


def profile_of_states(
    states: DataFrame, measures: Sequence[str], count_name: str, by: Sequence[str] = IMAGE_KEYS, prefix: str = "Per_Field"
) -> DataFrame:
    """Count and means per image from states; the same as ``field_profile`` of all objects."""
    means = [
        (F.sum(f"sum_{m}").cast("double") / F.nullif(F.sum(f"n_{m}"), F.lit(0))).alias(name)
        for m, name in zip(measures, prefixed_names(measures, prefix))
    ]
    return states.groupBy(*by).agg(F.sum("n").alias(count_name), *means)


def add_profile(
    images: DataFrame,
    profile: DataFrame,
    zero_fill: Sequence[str] = (),
    by: Sequence[str] = PROFILE_KEYS,
) -> DataFrame:
    """Per-image values onto every image row with the same keys.

    Images without objects keep NULL; counts in ``zero_fill`` become 0.
    """
    joined = images.join(profile, list(by), "left")
    if zero_fill:
        joined = joined.fillna(0, subset=list(zero_fill))
    added = [c for c in profile.columns if c not in by]
    return joined.select(*images.columns, *added)


def image_table(
    index: DataFrame,
    files: DataFrame,
    links: Mapping[str, str],
    images: DataFrame,
    objects: Mapping[str, DataFrame],
    measures: Mapping[str, Sequence[str]],
    decimals: int | None = None,
    zero_fill: bool = False,
    plane: bool = False,
    times: bool = False,
) -> DataFrame:
    """The per-image table: paths, counts and means of every population.

    Counts and means join the image keys, one row on either side, and come
    along when the keys join the planes and timepoints of the images.
    """
    images = with_profiles(images, objects, measures, decimals, zero_fill)
    return flatten_images(index, files, links, images, plane, times)


def with_profiles(
    images: DataFrame,
    objects: Mapping[str, DataFrame],
    measures: Mapping[str, Sequence[str]],
    decimals: int | None = None,
    zero_fill: bool = False,
) -> DataFrame:
    """Image keys with counts and means of every population.

    Grouped by row and column rather than by the well they stand for, so that
    no label is made per object, and all joins share one partitioning.
    """
    prefixed_names([m for p in objects for m in measures[p]])
    for population, rows in objects.items():
        count_name = f"Image_Count_{population}"
        profile = field_profile(rows, measures[population], count_name, IMAGE_KEYS, decimals)
        images = add_profile(images, profile, [count_name] if zero_fill else [], IMAGE_KEYS)
    return images


def well_profile(
    objects: DataFrame, measures: Sequence[str], by: Sequence[str] = (PLATE, "Well")
) -> DataFrame:
    """``Median_<m>`` and ``Std_<m>`` of every measure per well, exact.

    Deviations come with the first of the two readings that medians take.
    """
    deviations = [F.stddev_samp(m).alias(n) for m, n in zip(measures, prefixed_names(measures, "Std"))]
    found = grouped_medians(objects, list(by), list(measures), deviations)
    medians = {f"median_{m}": n for m, n in zip(measures, prefixed_names(measures, "Median"))}
    return found.select("_group.*", *prefixed_names(measures, "Std"), *medians).withColumnsRenamed(medians)
