import pytest
from pyspark.sql import functions as F

from platewright.functions import paths, text, wells


@pytest.mark.parametrize("row, column, kind, label, well_row, well_column", [
    (1, 1, 96, "A01", "01", "01"),
    (8, 12, 96, "H12", "08", "12"),
    (12, 10, 96, "L10", "12", "10"),
    (13, 1, 96, None, "13", "01"),
    (0, 1, 96, None, "00", "01"),
    (None, 1, 96, None, None, "01"),
    (-1, 3, 96, None, None, "03"),
    (2, 123, 96, "B123", "02", "123"),
    (16, 24, 384, "P24", "16", "24"),
    (26, 1, 1536, "Z01", "26", "01"),
    (27, 5, 1536, "AA05", "27", "05"),
    (32, 48, 1536, "AF48", "32", "48"),
])
def test_wells(spark, row, column, kind, label, well_row, well_column):
    df = spark.createDataFrame([(row, column)], "Row long, Column long")
    got = wells.with_wells(df, kind).first()
    assert (got["Well"], got["WellRow"], got["WellColumn"]) == (label, well_row, well_column)


@pytest.mark.parametrize("value, number", [("1.0", 1), ("2.9", 2), ("-3.7", -3), ("x", None), (None, None), ("1e30", None)])
def test_whole_number(spark, value, number):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(wells.whole_number(F.col("v")).alias("n")).first()["n"] == number


PATHS = [
    r"C:\img\P1\r01c02f03p04-ch5sk6fk1fl1.tiff",
    "/data/P2/Images/r10c12f103p01-ch2sk1.tiff",
    r"C:\img\P1\thumb.tiff",
    r"C:\img\P1\r01c02f03p04-ch5sk6fk1fl1.tif",
    "r01c02f03p01-ch1sk1.tiff",
]


def test_image_paths(spark):
    files = spark.createDataFrame([(p,) for p in PATHS], "path string")
    got = {r["path"]: tuple(r[f] for f in paths.IMAGE_FIELDS) for r in paths.parse_image_paths(files).collect()}
    assert got == {PATHS[0]: (1, 2, 3, 4, 5, 6), PATHS[1]: (10, 12, 103, 1, 2, 1)}


def test_path_parts(spark):
    files = spark.createDataFrame([(p,) for p in PATHS], "path string")
    p = F.col("path")
    got = files.select(paths.file_name(p), paths.folder(p), paths.plate_of(p)).collect()
    assert tuple(got[0]) == ("r01c02f03p04-ch5sk6fk1fl1.tiff", r"C:\img\P1", "P1")
    assert tuple(got[1]) == ("r10c12f103p01-ch2sk1.tiff", "/data/P2/Images", "P2")
    assert tuple(got[4]) == ("r01c02f03p01-ch1sk1.tiff", None, None)


def test_plate_of_evaluation_folder(spark):
    path = "file:/in/Plate A+B__x-Measurement 1/Evaluation 6/Objects_Population - 1.txt"
    got = spark.range(1).select(
        paths.plate_of(F.lit(path)).alias("p"),
        paths.decoded(F.lit("a%20b+c%2Bd")).alias("d"),
    ).first()
    assert tuple(got) == ("Plate A+B__x-Measurement 1", "a b+c+d")


def test_markers(spark):
    df = spark.createDataFrame([("xx Row 1",), ("none",), ("Row\t1",), ("  Row x",), ("",)], "t string")
    got = df.select(
        text.from_marker(F.col("t")).alias("cut"), text.first_word(F.col("t")).alias("word"),
        text.starts_with_word(F.col("t")).alias("is_row"),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("Row 1", "xx", False), ("none", "none", False), ("Row\t1", "Row", True),
        ("Row x", "Row", True), ("", None, False),
    ]


def test_metadata_pairs(spark):
    lines = [" Plate Name \t P1 ", "a\tb\tc", "", "k\tfirst", "k\tlast", "x\t", "alone", "late\tno"]
    df = spark.createDataFrame([("f", i, l) for i, l in enumerate(lines)], "file string, line_no int, value string")
    got = {r["key"]: r["value"] for r in text.metadata_pairs(df).collect()}
    assert got == {"Plate Name": "P1", "k": "last", "x": ""}


def test_fill_nulls(spark):
    df = spark.createDataFrame([(None, None), (1, "a")], "a int, b string")
    assert [tuple(r) for r in text.fill_nulls(df, {"a": 0, "b": "none"}).collect()] == [(0, "none"), (1, "a")]


def test_bounding_box(spark):
    boxes = ["[1,2,4,8]", "[4,2,1,8]", "[1,2,3]", "junk", None, "[1.5, 2, 2.5, 3]"]
    df = spark.createDataFrame([(b,) for b in boxes], "BoundingBox string")
    got = [r["BoundingBox_area"] for r in text.with_bounding_box(df).collect()]
    assert got == [18.0, None, None, None, None, 1.0]


def test_no_local_folder_on_a_cluster():
    from types import SimpleNamespace

    from platewright.session import shared_folder

    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(cluster)
