"""Channels, image files and the per-image table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import file_name, folder
from ..schema import FLATTEN_KEYS, IMAGE_KEYS, PLATE, SEQ
from ..session import shared_folder
from .joins import asof_join, split_left_join
from .ranking import dense_number

FILE_KEYS = [*IMAGE_KEYS, "ChannelID"]
# Attributes of an image that are not part of its key.
IMAGE_ATTRIBUTES = ["Sequence", "ChannelType", "ImageSizeX", "ImageSizeY", "PositionXm", "PositionYm"]


def channel_names(index: DataFrame) -> DataFrame:
    return index.select("ChannelName").distinct()


def channel_ids(index: DataFrame) -> DataFrame:
    """``(plate, ChannelName, ChannelID)``; a name with two ids is an error."""
    low, high = F.min("ChannelID"), F.max("ChannelID")
    message = F.concat(F.lit("two ids for channel "), F.col("ChannelName"))
    one = F.when(low == high, low).when(low.isNotNull(), F.raise_error(message).cast("bigint"))
    return index.groupBy(PLATE, "ChannelName").agg(one.alias("ChannelID"))


def image_sizes(index: DataFrame) -> DataFrame:
    return index.select(PLATE, "ImageSizeX", "ImageSizeY", "ChannelName").distinct()


def population_sizes(links: DataFrame, sizes: DataFrame) -> DataFrame:
    """Image width and height of each plate's populations, one row for each.

    Of several sizes for one channel the largest is taken.
    """
    largest = sizes.groupBy(PLATE, "ChannelName").agg(
        F.max(F.struct("ImageSizeX", "ImageSizeY")).alias("_size")
    )
    return links.join(largest, [PLATE, "ChannelName"], "left").select(
        *links.columns,
        F.col("_size.ImageSizeX").alias("image_width"),
        F.col("_size.ImageSizeY").alias("image_height"),
    )


def require_links(populations: Sequence[str], links: Mapping[str, str]) -> None:
    missing = [p for p in populations if p not in links]
    if missing:
        raise KeyError(f"no channel is linked to {missing}")


def number_folders(files: DataFrame, seq: str = SEQ) -> DataFrame:
    """``(folder, n_images, FolderNumber)``, numbered in first-seen order.

    Files without ``seq`` are numbered by folder name.
    """
    listed = files.withColumn("folder", folder(F.col("path"))).groupBy("folder")
    if seq in files.columns:
        folders = listed.agg(F.count("*").alias("n_images"), F.min(seq).alias("_first"))
    else:
        ordered = listed.agg(F.count("*").alias("n_images")).orderBy("folder")
        shared_folder(files.sparkSession)
        # the places in the sorted order must not change between two readings
        folders = ordered.withColumn("_first", F.monotonically_increasing_id()).checkpoint()
    return dense_number(folders, [], "_first", "FolderNumber", ties=["folder"]).drop("_first")


def latest_files(files: DataFrame, plane: bool = False) -> DataFrame:
    """One file per image and channel: the last by position, cycle and path.

    With ``plane`` the position in the file name counts as the plane, and each
    plane keeps its file.
    """
    keys = [*FILE_KEYS, "Plane"] if plane else FILE_KEYS
    if plane:
        files = files.withColumn("Plane", F.col("Position"))
    last = F.max_by("path", F.struct("Position", "Cycle", "path"))
    reduced = files.groupBy(*keys).agg(last.alias("Image__URL"))
    return reduced.withColumn("Image_Path", folder(F.col("Image__URL")))


def files_by_cycle(files: DataFrame, plane: bool = False) -> DataFrame:
    """One file per image, channel and cycle, with the cycle as ``Timepoint``: the last by
    position and path."""
    keys = [*FILE_KEYS, "Plane"] if plane else FILE_KEYS
    if plane:
        files = files.withColumn("Plane", F.col("Position"))
    return files.groupBy(*keys, F.col("Cycle").alias("Timepoint")).agg(
        F.max_by("path", F.struct("Position", "path")).alias("Image__URL"))


def attach_paths_in_time(rows: DataFrame, files: DataFrame, plane: bool = False) -> DataFrame:
    """Rows with the file of the last cycle at or before their time point.

    ``rows`` are index rows, or the index reduced to image, channel and time point."""
    keys = [*FILE_KEYS, "Plane"] if plane else FILE_KEYS
    found = asof_join(rows, files_by_cycle(files, plane), keys, "Timepoint", "Image__URL")
    return found.withColumn("Image_Path", folder(F.col("Image__URL")))


def attach_paths(index: DataFrame, files: DataFrame, plane: bool = False) -> DataFrame:
    """Index rows with the path and folder of their image file."""
    keys = [*FILE_KEYS, "Plane"] if plane else FILE_KEYS
    return split_left_join(index, latest_files(files, plane), keys)


def _path_columns(links: Mapping[str, str]) -> list[Column]:
    columns = []
    for population, channel in links.items():
        linked = F.col("ChannelName") == channel
        columns.append(F.max(F.when(linked, F.col("Image_Path"))).alias(f"Image_Path_{population}"))
        columns.append(F.max(F.when(linked, F.col("Image__URL"))).alias(f"Image__URL_{population}"))
    return columns


def has_planes(index: DataFrame) -> bool:
    """Whether any image of the index has a plane beside another."""
    ends = index.agg(F.min("Plane").alias("low"), F.max("Plane").alias("high")).first()
    return ends["low"] != ends["high"]


def layouts(index: DataFrame) -> DataFrame:
    """``(plate, plane, times)``: whether a plate has several planes, and time points."""
    return index.groupBy(PLATE).agg(
        F.coalesce(F.min("Plane") != F.max("Plane"), F.lit(False)).alias("plane"),
        F.coalesce(F.min("Timepoint") != F.max("Timepoint"), F.lit(False)).alias("times"),
    )


def _channel_rows(
    index: DataFrame, files: DataFrame, grain: Sequence[str], kept: Mapping[str, Column], plane: bool, times: bool = False
) -> DataFrame:
    """The index reduced to ``grain`` and channel, with the channel's file.

    Reduced before the join, and joined to files reduced to the same keys, so
    that no key has many rows on either side.
    """
    channels = (
        index.dropna(subset=IMAGE_KEYS)
        .groupBy(*grain, "ChannelID", "ChannelName")
        .agg(*[c.alias(n) for n, c in kept.items()])
    )
    if times:
        return attach_paths_in_time(channels, files, plane)
    keys = [*FILE_KEYS, "Plane"] if plane else FILE_KEYS
    return channels.join(latest_files(files, plane), keys, "left")


def flatten_images(
    index: DataFrame, files: DataFrame, links: Mapping[str, str], images: DataFrame, plane: bool = False,
    times: bool = False,
) -> DataFrame:
    """One row per plate, image, plane and timepoint, with paths by population.

    With ``plane`` the position in a file's name is its plane, and each plane
    gets its own file. With ``times`` each time point gets the file of the last cycle at
    or before it; otherwise all get the last file.

    All populations come out of one aggregation. ``images`` has one row per
    image (``keys.image_keys``); columns added to it come along.
    """
    grain = [*IMAGE_KEYS, "Plane", "Timepoint"]
    kept = {c: F.max(c) for c in IMAGE_ATTRIBUTES}
    rows = _channel_rows(index, files, grain, kept, plane, times)
    flat = rows.groupBy(*grain).agg(*[c.alias(n) for n, c in kept.items()], *_path_columns(links))
    numbered = flat.join(images.drop("first_seq", "index_rows"), IMAGE_KEYS)
    urls = [c for p in links for c in (f"Image_Path_{p}", f"Image__URL_{p}")]
    names = {f"Image_FileName_{p}": file_name(F.col(f"Image__URL_{p}")) for p in links}
    added = [c for c in numbered.columns if c not in {PLATE, *FLATTEN_KEYS, *urls}]
    return numbered.withColumns(names).select(PLATE, *FLATTEN_KEYS, *urls, *names, *added)


def flatten_15(
    index: DataFrame, files: DataFrame, links: Mapping[str, str], images: DataFrame, plane: bool = False
) -> DataFrame:
    """The literal grouping by all 15 index columns (and the plate).

    Channels of different type come out as separate rows of one image.
    """
    derived = ["ImageNumber", "Well", "WellRow", "WellColumn"]
    grain = [PLATE, *[k for k in FLATTEN_KEYS if k not in derived]]
    rows = _channel_rows(index, files, grain, {"_n": F.count("*")}, plane)
    flat = rows.groupBy(*grain).agg(*_path_columns(links))
    numbered = flat.join(images.select(*IMAGE_KEYS, *derived), IMAGE_KEYS)
    urls = [c for p in links for c in (f"Image_Path_{p}", f"Image__URL_{p}")]
    return numbered.select(PLATE, *FLATTEN_KEYS, *urls)


def first_values(reference: DataFrame, keys: Sequence[str], value: str, seq: str = SEQ) -> DataFrame:
    """First non-NULL value per complete key, in ``seq`` order."""
    return (
        reference.dropna(subset=[*keys, value])
        .groupBy(*keys)
        .agg(F.min_by(value, seq).alias(value))
    )
