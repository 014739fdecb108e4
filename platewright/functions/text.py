"""Small text and NULL helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def from_marker(text: Column, marker: str = "Row") -> Column:
    """Text from the first marker on; unchanged where there is none."""
    at = F.instr(text, F.lit(marker))
    return F.when(at > 0, F.substr(text, at)).otherwise(text)


#: What text that a cast takes for a number begins with, among other text.
NUMBER_START = r"^[\x00-\x20]*+[+-]?(?:\.?[0-9]|[iI][nN][fF]|[nN][aA][nN])"


def as_double(text: Column) -> Column:
    """``text.try_cast("double")``. The cast raises and catches an error for each text that is no
    number, at a hundred times the cost of a number, so it is spared those that cannot be one. Most
    numbers begin with a digit, which is seen without a pattern."""
    digit = (text >= "0") & (text < ":")
    return F.when(digit | text.rlike(NUMBER_START), text.try_cast("double"))


#: All that a cast takes for a whole number, and short ones, which are the same by way of a double.
WHOLE = r"\A[\x00-\x20\x7f]*+[+-]?[0-9]++[\x00-\x20\x7f]*+\z"
SHORT_WHOLE = r"\A[+-]?[0-9]{1,15}\z"


def as_long(text: Column) -> Column:
    """``text.try_cast("bigint")``, which raises an error for each text that is no whole number."""
    return F.when(text.rlike(WHOLE), text.try_cast("bigint"))


def as_whole(text: Column) -> Column:
    """A number cut to a whole one: ``text.try_cast("double").try_cast("bigint")``."""
    return F.when(text.rlike(SHORT_WHOLE), text.try_cast("bigint")).otherwise(as_double(text).try_cast("bigint"))


def first_word(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"^\s*(\S+)", 1), F.lit(""))


def starts_with_word(text: Column, word: str = "Row") -> Column:
    return F.coalesce(first_word(text) == word, F.lit(False))


def pair_parts(line: Column) -> Column:
    """``[key, value]`` of a line with exactly one tab, trimmed; else NULL."""
    parts = F.split(line, "\t")
    trimmed = F.transform(parts, lambda part: F.regexp_replace(part, r"^\s+|\s+$", ""))
    return F.when(F.size(parts) == 2, trimmed)


def metadata_pairs(lines: DataFrame, max_lines: int = 7) -> DataFrame:
    """Key and value of the first lines of each file: ``(file, key, value)``.

    ``lines`` has ``file``, ``line_no`` (from 0) and ``value``. A key given
    twice keeps its last value.
    """
    return (
        lines.filter(F.col("line_no") < max_lines)
        .withColumn("_pair", pair_parts(F.col("value")))
        .filter(F.col("_pair").isNotNull())
        # Text is aggregated by sorting: not all rows of a split at once, but those of a part of the files.
        .repartition("file")
        .groupBy("file", F.col("_pair")[0].alias("key"))
        .agg(F.max_by(F.col("_pair")[1], F.col("line_no")).alias("value"))
    )


def fill_nulls(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace NULL by a constant, each column on its own."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def bounding_box(text: Column) -> Column:
    """Struct of corners, width, height and area from ``[x1,y1,x2,y2]`` text.

    NULL for text of another shape or with corners the wrong way round.
    """
    box = F.from_json(text, "array<double>")
    x1, y1, x2, y2 = (box[i] for i in range(4))
    whole = (F.size(box) == 4) & (x2 >= x1) & (y2 >= y1)
    return F.when(whole, F.struct(
        x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"),
        (x2 - x1).alias("width"), (y2 - y1).alias("height"),
        ((x2 - x1) * (y2 - y1)).alias("area"),
    ))


def with_bounding_box(df: DataFrame, column: str = "BoundingBox") -> DataFrame:
    parts = ["x1", "y1", "x2", "y2", "width", "height", "area"]
    return (
        df.withColumn("_box", bounding_box(F.col(column)))
        .withColumns({f"{column}_{p}": F.col("_box")[p] for p in parts})
        .drop("_box")
    )
