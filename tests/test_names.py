import pytest

from platewright.functions import names
from platewright.schema import INDEX_TABLE
from pyspark.sql import functions as F


@pytest.mark.parametrize("raw, clean", [
    ("Position X [µm]", "PositionXm"),
    ("O4 Final - O4 Area [µm²]", "O4FinalO4Aream"),
    ("Object No", "ObjectNo"),
    ("Unnamed: 18", "Unnamed18"),
])
def test_clean_name(raw, clean):
    assert names.clean_name(raw) == clean


def test_legacy_styles():
    assert names.clean_name("O4 - Group % [µm²]", "index") == "O4_Group_idpercentum"
    assert names.clean_name("A/B [s]", "results") == "A_Bs"


def test_cleaned_names_must_differ():
    with pytest.raises(ValueError, match="collide"):
        names.clean_names(["A-B", "ab"])


def test_cap_and_collision():
    long = "M" * 60
    assert len(names.prefixed(long)) == 64
    assert names.prefixed("Area") == "Per_Field_Area"
    with pytest.raises(ValueError, match="64"):
        names.prefixed_names([long + "a", long + "b"])


@pytest.mark.parametrize("file, table", [
    ("Objects_Population - O4 Final_trimmed.csv", "O4Final"),
    ("Objects_Population - O4 Final.txt", "O4Final"),
    ("Index.txt", INDEX_TABLE),
    ("PlateResults.txt", "PlateResults"),
])
def test_table_name(spark, file, table):
    row = spark.range(1).select(names.table_name_col(F.lit(file)).alias("t")).first()
    assert row["t"] == table


def test_rename_and_select_measures(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], ["Row", "O4 - Area [µm²]", "Other"])
    clean = names.rename_clean(df)
    assert clean.columns == ["Row", "O4Aream", "Other"]
    assert names.measurement_columns(clean, "O4") == ["O4Aream"]
    assert names.measurement_columns(clean, "o4") == []


def test_harmony_style():
    assert names.clean_name("Group - Cells [µm²] 5%", "harmony") == "Group_id___Cell_s_um_5"
