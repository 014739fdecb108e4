"""Casts that raise no errors, and types that are found while rows are written."""

from pyspark.sql import functions as F

from platewright.functions import text
from platewright.sources import exports

CELLS = ["1", " 2 ", "-3", "+4", "5.", "5.5", "", " ", "x", "16259.22", "1e3", "9223372036854775807", "9223372036854775808", "123456789012345",
         "9007199254740993", "1D", "0x1", "\t7\n", "1\x7f", "\x7f1", "1 2", "--1", "+", "\x001", "١", "1 ", "1\n", "-0", "NaN", "inf"]


def test_whole_numbers_are_those_of_the_cast(spark):
    cells = spark.createDataFrame([(c,) for c in CELLS] + [(None,)], "c string")
    cell = F.col("c")
    got = cells.select("c", text.as_long(cell), cell.try_cast("bigint"), text.as_whole(cell), cell.try_cast("double").try_cast("bigint")).collect()
    assert [(r[0], r[1], r[3]) for r in got] == [(r[0], r[2], r[4]) for r in got]
    # The cast raises an error for a number that is not whole; it is spared those.
    assert not cells.filter(cell.isin("5.5", "16259.22", "x", "1e3", "") & cell.rlike(text.WHOLE)).count()


def test_objects_are_not_read_again_for_their_types(spark):
    columns = {"plate": "string", "Row": "bigint", "A": "double", "B": "string", "C": "bigint"}
    rows = spark.createDataFrame([("P", 1, 1.0, "1", 1), ("P", 1, 2.5, "2.5", None), ("P", 1, None, "x", 3), ("P", 1, 4.0, "2D", 3)],
                                 "plate string, Row long, A double, B string, C long")
    found = rows.agg(*exports.kind_counts(columns)).first().asDict(recursive=True)
    assert sorted(exports.written_kinds(found, {"A": 2, exports.REAL + "C": 1, exports.TEXT + "C": 5})) == [
        ("A", 2, 1, 2), ("B", 1, 1, 2), ("C", 2, 1, 5)]
