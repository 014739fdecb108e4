"""Work that grows with the rows and the files, not with their number in one task or on the driver."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from platewright.functions import text
from platewright.operators import keys
from platewright.session import listed_in_few_tasks
from platewright.sources import exports, records, tables


def tasks_of(spark, action):
    """Tasks of the stages that an action runs."""
    sc, group = spark.sparkContext, f"counted-{os.urandom(4).hex()}"
    sc.setJobGroup(group, group)
    try:
        action()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    return [tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)]


def many_plates(spark, n=200):
    return spark.range(n).selectExpr("format_string('P%04d', id) AS plate", "id AS v")


def test_small_tables_are_written_by_several_tasks(spark, tmp_path):
    """F1-F3: folders and files take the time, and all of them went to one task."""
    settings = many_plates(spark).selectExpr("plate", "'H' AS population", "1 AS position", "'k' AS key", "string(v) AS value")
    tables.write_manifest(settings, f"{tmp_path}/manifest_text", [], "ab12")
    files = glob.glob(f"{tmp_path}/manifest_text/*/*/run-ab12-*")
    assert len(files) == 200
    assert len({re.search(r"run-ab12-(\d+)-", f)[1] for f in files}) > 4


def test_listing_takes_few_tasks(spark, tmp_path):
    """F1-F3, F5: a task per folder, each with its result for the driver."""
    many_plates(spark).write.partitionBy("plate").parquet(f"{tmp_path}/t/")
    like = many_plates(spark).select("v", "plate")
    assert max(tasks_of(spark, lambda: tables.read_table(spark, f"{tmp_path}/t", like))) <= 16
    paths = sorted(glob.glob(f"{tmp_path}/t/*/*.parquet"))
    assert max(tasks_of(spark, lambda: records.read_lines(spark, paths))) <= 16
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), listed_in_few_tasks(spark):
        raise RuntimeError
    assert spark.conf.get(name) == before


def test_tasks_do_not_grow_with_the_plates(spark):
    """F1-F3, F5: joining the keys took a task per plate, whatever the plates' size."""
    objects = many_plates(spark, 900).selectExpr("plate", "1L AS `Row`", "1L AS `Column`", "1L AS Field", "v")
    images = objects.select("plate", "Row", "Column", "Field", F.col("v").alias("ImageNumber"))
    parts = objects.select("plate", F.lit(1).cast("bigint").alias("_parts"), F.lit(1000).cast("bigint").alias("_bytes"))
    joined = keys.attach_keys_by_plate(objects, images, parts)
    assert joined.rdd.getNumPartitions() <= 10
    assert joined.filter("v = ImageNumber").count() == 900


def test_places_of_files_are_no_part_of_the_plan(spark, tmp_path):
    """the rank of each later file of a plate was a literal in the scan's expressions."""
    for plate in range(40):
        for part in "ab":
            path = tmp_path / f"part={part}" / f"plate=P{plate}" / "table=T"
            path.mkdir(parents=True)
            (path / "x.txt").write_text("Row\tColumn\tV\n" + "".join(f"1\t1\t{part}{i}\n" for i in range(3)))
    files = exports.ExportFiles(str(tmp_path), r"plate=([^/]+)/", r"table=([^/]+)/")
    heads = exports.export_heads(exports.list_exports(spark, files)).checkpoint()
    raw, = exports.read_raw(spark, files, heads, "T")
    assert "part=b" not in raw._jdf.queryExecution().analyzed().toString().replace("LocalRelation", "")
    rows = exports.typed(raw, {}).orderBy("plate", "seq").groupBy("plate").agg(F.collect_list("V").alias("v")).collect()
    assert len(rows) == 40 and {tuple(r["v"]) for r in rows} == {("a0", "a1", "a2", "b0", "b1", "b2")}


def test_text_of_joined_records_is_read_twice(spark, tmp_path):
    """F8: each reading of the records read the text a dozen times."""
    path = tmp_path / "x.txt"
    path.write_text('Row\tColumn\tNote\n1\t1\t"a\nb"\n1\t2\tc\n')
    lines = records.numbered(records.read_lines(spark, [str(path)]))
    header = spark.createDataFrame([(lines.first()[records.FILE], 1)], f"{records.FILE} string, _header long")
    found = records.joined(lines, header)
    assert "text" not in re.findall(r"FileScan (\w+)", found._jdf.queryExecution().executedPlan().toString())
    assert sorted(r[records.LINE] for r in found.collect()) == ["1\t1\t\"a\nb\"", "1\t2\tc", "Row\tColumn\tNote"]


CELLS = ["1", " 2 ", "-3.5", "+.5", "5.", ".", "", " ", "none", "NaN", " nan", "+inf", "-Infinity", "inf", "infinite", "1e3", "1E-3x",
         "e5", "0x1p3", "1D", "2f", "x", "[1,2]", "\t7\n", " 8", "⁠1", "9223372036854775808", "1,5", "--1", "+ 1", "\x001", "İnf"]


def test_numbers_are_those_of_the_cast(spark):
    """F6-F10: a cast of text to a number raises an error each time."""
    cells = spark.createDataFrame([(c,) for c in CELLS] + [(None,)], "c string")
    got = cells.select("c", text.as_double(F.col("c")).alias("a"), F.col("c").try_cast("double").alias("b")).collect()
    assert [(r["c"], str(r["a"])) for r in got] == [(r["c"], str(r["b"])) for r in got]
    spared = cells.filter(F.col("c").isin("none", "x", "[1,2]", "", "e5") & F.col("c").rlike(text.NUMBER_START))
    assert not spared.count()


def test_cells_are_cast_once(spark):
    """of each cell the cast was done for every count of it."""
    raw = spark.createDataFrame([("1", True), ("2.5", True), ("x", True), (None, True), ("NA", True), ("3", False)], "V string, _is_row boolean")
    kinds = exports.cell_kinds([raw])
    assert [tuple(r) for r in kinds.collect()] == [("V", 1, 1, 1)]
    plan = kinds._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"cast\(V#\d+ as double\)", plan)) == 1


def test_metadata_is_not_sorted_by_whole_splits(spark):
    """text is aggregated by sorting, so a split's rows are dealt to parts before."""
    lines = spark.createDataFrame([("f", 0, "a\tb"), ("f", 1, "a\tc"), ("g", 0, "a\tb"), ("g", 7, "z\tb")], "file string, line_no int, value string")
    assert sorted(map(tuple, text.metadata_pairs(lines).collect())) == [("f", "a", "c"), ("g", "a", "b")]
    plan = text.metadata_pairs(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("SortAggregate") < plan.index("Exchange")


def test_lines_are_split_once(spark, tmp_path):
    """F6-F10: the filter on a row's cells was moved below their making, and made them again for each use."""
    path = tmp_path / "plate=P" / "table=T"
    path.mkdir(parents=True)
    (path / "x.txt").write_text("Row\tColumn\tV\n1\t1\ta\n1\tx\tb\n")
    files = exports.ExportFiles(str(tmp_path), r"plate=([^/]+)/", r"table=([^/]+)/")
    heads = exports.export_heads(exports.list_exports(spark, files)).checkpoint()
    rows = exports.read_objects(spark, files, heads, "T", types={"V": "string"})
    assert rows.select("V").collect() == [("a",)]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 2
