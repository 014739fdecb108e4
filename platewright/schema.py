"""Column names, key lists and declared types shared by all modules."""

from __future__ import annotations

PLATE = "plate"
SEQ = "seq"
FILE = "source_file"
WELL_KEYS = ["Row", "Column"]
IMAGE_KEYS = [PLATE, "Row", "Column", "Field"]
PROFILE_KEYS = [PLATE, "Well", "Field"]
WELL_COLUMNS = ["Well", "WellRow", "WellColumn"]

# The literal flatten key of the per-image table (without the plate).
FLATTEN_KEYS = [
    "ImageNumber", "Row", "Column", "Plane", "Timepoint", "Sequence", "Field",
    "ChannelType", "ImageSizeX", "ImageSizeY", "PositionXm", "PositionYm",
    "Well", "WellRow", "WellColumn",
]

# Declared types. Columns named here are read as such in every export file;
# everything else is a measurement (double) or free text.
LONG_COLUMNS = {
    "Row", "Column", "Plane", "Timepoint", "Sequence", "Field", "ObjectNo",
    "ChannelID", "ImageSizeX", "ImageSizeY",
}
DOUBLE_COLUMNS = {"X", "Y", "Z", "PositionXm", "PositionYm", "PositionZm"}

# Strings that mean "no value" in an export cell (fixed values).
NA_STRINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

INDEX_TABLE = "Index_file"
PLATE_RESULTS_TABLE = "PlateResults"
