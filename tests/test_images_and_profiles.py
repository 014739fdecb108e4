import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from platewright.functions.paths import parse_image_paths
from platewright.operators import images as im
from platewright.operators import keys, profiles
from platewright.plans import manifest
from platewright.sources import synthetic

INDEX = """plate string, seq long, Row long, Column long, Plane long, Timepoint long, Sequence long,
Field long, ChannelID long, ChannelName string, ChannelType string, ImageSizeX long, ImageSizeY long,
PositionXm double, PositionYm double"""
LINKS = {"Hoechst": "HOECHST 33342", "O4Final": "Alexa 647"}


def row(plate, seq, r, c, f, channel, name, kind="Fluorescence", plane=1):
    return (plate, seq, r, c, plane, 1, 1, f, channel, name, kind, 1080, 1080, 0.5 * (f or 0), 1.0)


@pytest.fixture()
def index(spark):
    """Two plates; on P1 the second well is seen first; one row lacks its Field."""
    rows = [
        row("P1", 1, 1, 2, 1, 1, "HOECHST 33342"), row("P1", 2, 1, 2, 1, 2, "Alexa 647", "Confocal"),
        row("P1", 3, 1, 1, 1, 1, "HOECHST 33342"), row("P1", 4, 1, 1, 1, 2, "Alexa 647", "Confocal"),
        row("P1", 5, 1, 1, 2, 1, "HOECHST 33342"), row("P1", 6, 1, 1, None, 1, "HOECHST 33342"),
        row("P2", 1, 1, 1, 1, 1, "HOECHST 33342"), row("P2", 2, 1, 1, 1, 1, "HOECHST 33342", plane=2),
    ]
    return spark.createDataFrame(rows, INDEX)


@pytest.fixture()
def files(spark):
    names = [
        ("P1", r"C:\i\P1\r01c02f01p01-ch1sk1a.tiff"), ("P1", r"C:\i\P1\r01c02f01p02-ch1sk1a.tiff"),
        ("P1", r"C:\i\P1\r01c02f01p01-ch2sk1a.tiff"), ("P1", r"C:\i\P1\r01c01f01p01-ch2sk1a.tiff"),
        ("P1", r"C:\i\P1\readme.tiff"), ("P2", "/i/P2/r01c01f01p01-ch1sk1a.tiff"),
    ]
    return parse_image_paths(spark.createDataFrame(names, "plate string, path string"))


@pytest.fixture()
def objects(spark):
    """P1 A01: three objects with 1, 3 and no value; A02 none; one without image."""
    rows = [
        ("P1", 1, 1, 1, 1, 1.0), ("P1", 1, 1, 1, 2, 3.0), ("P1", 1, 1, 1, 3, None),
        ("P1", 7, 7, 1, 1, 9.0), ("P2", 1, 1, 1, 1, 5.0), ("P2", None, 1, 1, 1, 5.0),
    ]
    return spark.createDataFrame(rows, "plate string, Row long, Column long, Field long, ObjectNo long, HoechstArea double")


def numbers(df):
    return {(r["plate"], r["Row"], r["Column"], r["Field"]): r["ImageNumber"] for r in df.collect()}


def test_image_numbers_by_first_seen(index):
    assert numbers(keys.image_keys(index)) == {
        ("P1", 1, 2, 1): 1, ("P1", 1, 1, 1): 2, ("P1", 1, 1, 2): 3, ("P2", 1, 1, 1): 1,
    }
    assert [r["ImageNumber"] for r in keys.number_index(index).orderBy("plate", "seq").collect()] == [
        1, 1, 2, 2, 3, None, 1, 1,
    ]


def test_image_numbers_without_seq(index):
    assert numbers(keys.image_keys(index.drop("seq")))[("P1", 1, 2, 1)] == 3


@pytest.mark.parametrize("small", [True, False])
def test_attach_keys_keeps_every_object(index, objects, small):
    got = keys.attach_keys(objects, keys.image_keys(index), small=small)
    assert got.count() == objects.count()
    rows = {(r["plate"], r["Row"], r["ObjectNo"]): (r["ImageNumber"], r["Well"]) for r in got.collect()}
    assert rows[("P1", 1, 3)] == (2, "A01")
    assert rows[("P1", 7, 1)] == (None, "G07")
    assert rows[("P2", None, 1)] == (None, None)


def test_fanout_of_three_index_rows(spark):
    index = spark.createDataFrame([row("P", i, 1, 1, 1, i, f"c{i}") for i in range(3)], INDEX)
    objects = spark.createDataFrame([("P", 1, 1, 1)] * 3 + [("P", 2, 1, 1)], "plate string, Row long, Column long, Field long")
    got = keys.fanout_counts(objects.withColumn("p", F.lit("x")), index, ["p"]).first()
    assert (got["n_objects"], got["n_joined"]) == (4, 28)


def test_unmatched(index, objects):
    got = keys.unmatched_counts(objects, keys.image_keys(index), ["plate"]).collect()
    assert {r["plate"]: r["n_unmatched"] for r in got} == {"P1": 1, "P2": 1}


def test_latest_file_and_plane(index, files):
    urls = {(r["plate"], r["Column"], r["Field"], r["ChannelID"]): r["Image__URL"] for r in im.latest_files(files).collect()}
    assert urls[("P1", 2, 1, 1)].endswith("p02-ch1sk1a.tiff")
    by_plane = im.attach_paths(index, files, plane=True).orderBy("plate", "seq").collect()
    assert by_plane[0]["Image__URL"].endswith("p01-ch1sk1a.tiff")
    assert by_plane[0]["Image_Path"] == r"C:\i\P1"
    assert by_plane[7]["Image__URL"] is None


def test_flatten(index, files):
    flat = im.flatten_images(index, files, LINKS, keys.image_keys(index))
    got = {(r["plate"], r["ImageNumber"], r["Plane"]): r for r in flat.collect()}
    assert set(got) == {("P1", 1, 1), ("P1", 2, 1), ("P1", 3, 1), ("P2", 1, 1), ("P2", 1, 2)}
    first = got["P1", 1, 1]
    assert first["Image_FileName_Hoechst"] == "r01c02f01p02-ch1sk1a.tiff"
    assert first["Image__URL_O4Final"] == r"C:\i\P1\r01c02f01p01-ch2sk1a.tiff"
    assert got["P1", 2, 1]["Image__URL_Hoechst"] is None
    assert got["P1", 2, 1]["Image_FileName_Hoechst"] is None


def test_flatten_by_15_columns_splits_channel_types(index, files):
    got = im.flatten_15(index, files, LINKS, keys.image_keys(index))
    per_image = {(r["plate"], r["ImageNumber"]): r["count"] for r in got.groupBy("plate", "ImageNumber").count().collect()}
    assert per_image == {("P1", 1): 2, ("P1", 2): 2, ("P1", 3): 1, ("P2", 1): 2}


def test_channels(spark, index):
    assert {r[0] for r in im.channel_names(index).collect()} == set(LINKS.values())
    assert im.channel_ids(index).count() == 3
    two = index.union(spark.createDataFrame([row("P1", 9, 1, 1, 1, 5, "Alexa 647")], INDEX))
    with pytest.raises(PySparkException, match="two ids"):
        im.channel_ids(two).collect()


def test_folders(spark):
    files = spark.createDataFrame([(r"C:\b\1.tiff", 1), (r"C:\a\1.tiff", 2), (r"C:\b\2.tiff", 3)], "path string, seq long")
    got = [tuple(r) for r in im.number_folders(files).orderBy("FolderNumber").collect()]
    assert got == [(r"C:\b", 2, 1), (r"C:\a", 1, 2)]
    by_name = [tuple(r) for r in im.number_folders(files.drop("seq")).orderBy("FolderNumber").collect()]
    assert by_name == [(r"C:\a", 1, 1), (r"C:\b", 2, 2)]


def test_field_profile_counts_and_means(objects):
    from platewright.functions.wells import with_wells

    for decimals in (None, 4):
        rows = profiles.field_profile(with_wells(objects), ["HoechstArea"], "n", decimals=decimals).collect()
        got = {(r["plate"], r["Well"]): (r["n"], r["Per_Field_HoechstArea"]) for r in rows}
        assert got[("P1", "A01")] == (3, 2.0)


def test_image_table_keeps_empty_images(index, files, objects):
    from platewright.functions.wells import with_wells

    images = keys.image_keys(index)
    for zero_fill, empty in ((False, None), (True, 0)):
        table = profiles.image_table(
            index, files, LINKS, images, {"Hoechst": with_wells(objects)}, {"Hoechst": ["HoechstArea"]},
            zero_fill=zero_fill,
        )
        got = {(r["plate"], r["ImageNumber"], r["Plane"]): r["Image_Count_Hoechst"] for r in table.collect()}
        assert got == {("P1", 1, 1): empty, ("P1", 2, 1): 3, ("P1", 3, 1): empty, ("P2", 1, 1): 1, ("P2", 1, 2): 1}


def test_well_profile(spark):
    rows = [("P", "A01", v) for v in (1.0, 2.0, 10.0, None)] + [("P", "A02", 4.0), ("P", "A03", None), ("P", None, 8.0)]
    df = spark.createDataFrame(rows, "plate string, Well string, Area double")
    got = {r["Well"]: (r["Median_Area"], r["Std_Area"]) for r in profiles.well_profile(df, ["Area"]).collect()}
    assert got["A01"] == (2.0, pytest.approx(4.932882862))
    assert got["A02"] == (4.0, None)
    assert got["A03"] == (None, None)
    assert got[None] == (8.0, None)


def test_object_columns_renamed_to_the_end(objects):
    got = keys.rename_object_columns(objects.withColumn("Z", F.lit(1.0)), "Hoechst")
    assert got.columns == [
        "plate", "Row", "Column", "Field", "HoechstArea", "Hoechst_Number_Object_Number", "Hoechst_Location_Center_Z",
    ]
    added = keys.add_columns(objects, {"New": "string", "Row": "long"})
    assert added.columns == [*objects.columns, "New"]


def test_links_must_be_complete(spark):
    populations = spark.createDataFrame([("P", "Hoechst"), ("P", "Other")], "plate string, population string")
    with pytest.raises(PySparkException, match="no channel is linked to Other"):
        manifest.links_frame(populations, LINKS).collect()
    with pytest.raises(KeyError):
        im.require_links(["Other"], LINKS)


def test_manifest(spark, index):
    populations = spark.createDataFrame([("P1", "Hoechst"), ("P1", "O4Final"), ("P2", "Hoechst")], "plate string, population string")
    rows = manifest.manifest_long(manifest.links_frame(populations, LINKS), im.image_sizes(index), "db").collect()
    got = {(r["plate"], r["population"], r["key"]): r["value"] for r in rows}
    assert got["P1", "O4Final", "image_path_cols"] == "Image_Path_Hoechst,Image_Path_O4Final"
    assert got["P1", "O4Final", "image_channel_colors"] == "blue,red"
    assert got["P2", "Hoechst", "image_names"] == "Hoechst"
    assert got["P1", "Hoechst", "image_width"] == "1080"
    assert got["P1", "O4Final", "object_id"] == "O4Final_Number_Object_Number"
    assert got["P1", "O4Final", "plate_id"] == "Plane"


def test_colors_start_again(spark):
    got = spark.range(1, 9).select(manifest.color_at(F.col("id")).alias("c")).collect()
    assert [r["c"] for r in got] == [*manifest.COLORS, "blue"]


def test_generated_objects_do_not_depend_on_partitions(spark):
    images = synthetic.random_images(spark, plates=2, fields=2)
    assert images.count() == 2 * 96 * 2
    once = synthetic.random_objects(images, "O4", 5)
    again = synthetic.random_objects(images.repartition(7), "O4", 5)
    assert once.exceptAll(again).isEmpty() and again.exceptAll(once).isEmpty()
    limits = once.agg(F.min("O4Aream"), F.max("O4Aream"), F.min("X"), F.max("X"), F.avg("O4Aream")).first()
    assert 50 <= limits[0] and limits[1] <= 200 and 10 <= limits[2] and limits[3] <= 800
    assert limits[4] == pytest.approx(125, abs=5)
    assert once.count() == 2 * 96 * 2 * 5


def test_generated_objects_beyond_one_run(spark, monkeypatch):
    monkeypatch.setattr(synthetic, "RUN", 3)
    images = synthetic.random_images(spark, plates=1).limit(2)
    numbers = synthetic.random_objects(images, "O4", 8).groupBy("Row", "Column").agg(
        F.array_sort(F.collect_list("ObjectNo")).alias("n")
    ).collect()
    assert all(r["n"] == list(range(1, 9)) for r in numbers) and len(numbers) == 2
