"""Well labels and padded well coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Highest plate row that gets a label, by plate type (fixed values). Rows
# beyond H are labelled on 96-well plates too, up to L.
LABELLED_ROWS = {96: 12, 384: 16, 1536: 32}


def whole_number(value: Column) -> Column:
    """Text or number cut to a whole number; NULL where it is neither."""
    return value.try_cast("double").try_cast("bigint")


def two_digits(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.between(0, 9), F.concat(F.lit("0"), text)).otherwise(text)


def row_letters(row: Column, plate_type: int = 96) -> Column:
    """A..Z, AA..AF for rows 1..26, 27..32; NULL outside the plate type."""
    low = F.chr(F.lit(65) + (row - 1) % 26)
    high = F.when(row > 26, F.chr(F.lit(64) + F.floor((row - 1) / 26))).otherwise(F.lit(""))
    return F.when(row.between(1, LABELLED_ROWS[plate_type]), F.concat(high, low))


def well_label(row: Column, column: Column, plate_type: int = 96) -> Column:
    return F.concat(row_letters(row, plate_type), two_digits(column))


def padded(value: Column) -> Column:
    """``'01'``..``'09'``, ``'10'``...; NULL for NULL and negative numbers."""
    return F.when(value >= 0, two_digits(value))


def with_wells(df: DataFrame, plate_type: int = 96) -> DataFrame:
    """Add Well, WellRow and WellColumn from the row's own coordinates."""
    row, column = F.col("Row"), F.col("Column")
    return df.withColumns({
        "Well": well_label(row, column, plate_type),
        "WellRow": padded(row),
        "WellColumn": padded(column),
    })
