"""Image file paths: keys in the file name, file name, folder, plate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# r<row>c<column>f<field>p<position>-ch<channel>sk<cycle>...tiff (fixed pattern)
IMAGE_NAME = r"^.*[\\/]r([0-9]+)c([0-9]+)f([0-9]+)p([0-9]+)-ch([0-9]+)sk([0-9]+).*[.]tiff$"
MARK = "\u0001"
IMAGE_FIELDS = ["Row", "Column", "Field", "Position", "ChannelID", "Cycle"]

# A file belongs to the plate folder above it; evaluation and image
# sub-folders are passed over.
PLATE_FOLDER = r"([^\\/]+)[\\/](?:(?:Evaluation ?[0-9]*|Images)[\\/])?[^\\/]+$"


def file_name(path: Column) -> Column:
    """Text after the last separator; NULL where there is none."""
    return F.nullif(F.regexp_extract(path, r"([^\\/]+)$", 1), F.lit(""))


def folder(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"^(.*)[\\/][^\\/]+$", 1), F.lit(""))


def plate_of(path: Column, pattern: str = PLATE_FOLDER) -> Column:
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))


def decoded(path: Column) -> Column:
    """A path from file metadata without its percent escapes."""
    return F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def parse_image_paths(files: DataFrame, path: str = "path") -> DataFrame:
    """Add the six numbers of the image name; other files are dropped.

    The pattern runs once per path. The numbers come out of a generator, so
    that no later filter on them is moved below and repeats the pattern.
    """
    marked = F.regexp_replace(path, IMAGE_NAME, "".join(f"{MARK}${i}" for i in range(1, 7)))
    parts = F.filter(F.array(F.split(marked, MARK)), lambda p: F.size(p) == 7)

    def numbers(p: Column) -> Column:
        return F.struct(*[p[i].try_cast("bigint").alias(f) for i, f in enumerate(IMAGE_FIELDS, 1)])

    return files.select("*", F.inline(F.transform(parts, numbers)))
