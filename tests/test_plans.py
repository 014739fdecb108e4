"""The plans that the large tables depend on."""

import pytest
from pyspark.sql import functions as F

from platewright.functions.paths import parse_image_paths
from platewright.functions.wells import with_wells
from platewright.operators import keys, profiles
from platewright.plans import screen


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_attaching_small_keys_does_not_shuffle_objects(spark, sf_dir, tmp_path):
    keys.image_keys(screen.index_view(spark, sf_dir)).write.parquet(f"{tmp_path}/keys")
    images = spark.read.parquet(f"{tmp_path}/keys")
    text = plan(keys.attach_keys(screen.objects_view(spark, sf_dir), images, small=True))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_profile_is_one_scan_and_one_shuffle(spark, sf_dir):
    objects = screen.population_view(spark, sf_dir, "Hoechst")
    measures = screen.measure_names("Hoechst")
    text = plan(profiles.field_profile(with_wells(objects), measures, "n"))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
    assert "partial_count" in text and "partial_avg" in text
    read = text.split("ReadSchema: ")[1].split(">")[0]
    assert "l_extendedprice" in read and "l_partkey" not in read and "l_shipdate" not in read


def test_medians_read_the_objects_once_after_the_summaries(spark, sf_dir):
    found = profiles.well_profile(screen.objects_view(spark, sf_dir), ["Area", "Intensity"], ["plate", "population", "Row", "Column"])
    assert plan(found).count("FileScan") == 1


@pytest.mark.parametrize("query", ["image_table", "attach_keys", "image_number", "well_median_std", "image_flatten"])
def test_no_cross_joins_and_no_python(spark, sf_dir, query):
    import __spark_entry__ as entry

    text = plan(entry.queries()[query](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "Python" not in text and "Pandas" not in text


def test_image_names_are_matched_once(spark):
    files = spark.createDataFrame([("P", "x")], "plate string, path string")
    other = spark.createDataFrame([(1, 1)], "Row long, Column long")
    joined = other.join(parse_image_paths(files).filter(F.col("Row") > 0), ["Row", "Column"], "left")
    assert plan(joined).count("regexp_replace(") == 1
