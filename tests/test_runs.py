"""Plates that are replaced by a switch, changed plates, wider types, tables in buckets."""

import pytest
from pyspark.sql import functions as F

import plates
from platewright.operators import keys
from platewright.plans import convert as plan
from platewright.sources import bucketed, exports, tables

LINE = plates.object_line


def convert(spark, root, out, images=None, **options):
    none = spark.createDataFrame([], "plate string, path string")
    files = exports.ExportFiles(str(root))
    return plan.convert(spark, files, none if images is None else str(images), plates.LINKS, str(out), **options)


def write(root, plate, area, images=((1, 1, 1),)):
    plates.write_plate(root, plate, plate, list(images), [LINE(1, 1, 1, 1, [area, 1])], [LINE(1, 1, 1, 1, [60.0, 1.0])])


def areas(df):
    return {r["plate"]: r["Per_Field_HoechstAream"] for r in df.collect()}


def test_a_run_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    root, out = tmp_path / "in", tmp_path / "out"
    for plate, area in (("A", 1.0), ("7", 2.0)):
        write(root, plate, area)
    convert(spark, root, out)
    before = {n: sorted(map(str, rows.collect())) for n, rows in tables.written_tables(spark, str(out)).items()}
    assert len(before) == 8
    write(root, "A", 100.0)

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patched:
        patched.setattr(tables, "switch", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            convert(spark, root, out, overwrite=True)
    assert before == {n: sorted(map(str, rows.collect())) for n, rows in tables.written_tables(spark, str(out)).items()}
    files = spark.read.format("binaryFile").load(f"{out}/objects_Hoechst/*/*").count()
    assert files > 2
    tables.remove_broken_off(spark, str(out))
    assert spark.read.format("binaryFile").load(f"{out}/objects_Hoechst/*/*").count() == 2
    # Rows of earlier runs are not seen while they are there.
    for path in (root / "7").rglob("*.txt"):
        path.unlink()
    done = convert(spark, root, out, overwrite=True, clean=False)
    assert areas(done["images"]) == {"A": 100.0, "7": 2.0} == areas(tables.read_current(spark, str(out), "images"))
    assert spark.read.parquet(f"{out}/images").count() == 3


def test_two_switches_at_once(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    plates_a = spark.createDataFrame([("A",)], "plate string")
    tables.switch(spark, out, plates_a, "aa")
    monkeypatch.setattr(tables, "_version", lambda *args: 0)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        tables.switch(spark, out, plates_a, "bb")
    monkeypatch.undo()
    assert [tuple(r) for r in tables.current_runs(spark, out).collect()] == [("A", "aa")]


def test_only_changed_plates_are_converted(spark, tmp_path):
    root, out, pictures = tmp_path / "in", tmp_path / "out", tmp_path / "pictures"
    for plate in "ABCD":
        write(root, plate, 1.0)
        plates.write_images(pictures, plate, [(1, 1, 1)])
    first = convert(spark, root, out, pictures)
    runs = {r["plate"]: r["run"] for r in tables.current_runs(spark, str(out)).collect()}
    assert set(runs) == set("ABCD") and areas(first["images"])["B"] == 1.0
    again = convert(spark, root, out, pictures, overwrite=True, only_changed=True)
    assert {r["plate"]: r["run"] for r in tables.current_runs(spark, str(out)).collect()} == runs
    assert areas(again["images"]) == dict.fromkeys("ABCD", 1.0)
    write(root, "B", 25.0)
    (pictures / "C" / "Images" / "r01c01f02p01-ch1sk1fk1fl1.tiff").write_text("x")
    for path in sorted((root / "D").rglob("*"), reverse=True):
        path.rmdir() if path.is_dir() else path.unlink()
    write(root, "E", 5.0)
    done = convert(spark, root, out, pictures, overwrite=True, only_changed=True)
    now = {r["plate"]: r["run"] for r in tables.current_runs(spark, str(out)).collect()}
    assert set(now) == set("ABCE") and now["A"] == runs["A"] and now["B"] == now["C"] == now["E"] != runs["B"]
    assert areas(done["images"]) == {"A": 1.0, "B": 25.0, "C": 1.0, "E": 5.0}
    assert {r["plate"] for r in tables.read_current(spark, str(out), "image_files").collect()} == set("ABC")


def test_numbers_are_kept(spark, tmp_path):
    root, out = tmp_path / "in", tmp_path / "out"
    write(root, "A", 1.0, [(1, 2, 1), (1, 1, 1)])
    convert(spark, root, out)
    write(root, "A", 1.0, [(2, 2, 1), (1, 1, 1), (1, 2, 1)])
    done = convert(spark, root, out, overwrite=True, keep_numbers=True)
    assert {(r["Row"], r["Column"]): r["ImageNumber"] for r in done["image_keys"].collect()} == {(1, 2): 1, (1, 1): 2, (2, 2): 3}


def test_numbers_that_are_given(spark):
    index = spark.createDataFrame([("A", 1, c, 1, c) for c in (5, 3, 4, 9)] + [("B", 1, 1, 1, 1)],
                                  "plate string, Row long, Column long, Field long, seq long")
    given = spark.createDataFrame([("A", 1, 4, 1, 7), ("A", 1, 8, 1, 9)], "plate string, Row long, Column long, Field long, ImageNumber long")
    got = {(r["plate"], r["Column"]): r["ImageNumber"] for r in keys.image_keys(index, given=given).collect()}
    assert got == {("A", 4): 7, ("A", 3): 10, ("A", 5): 11, ("A", 9): 12, ("B", 1): 1}


def test_types_grow_wider_over_runs(spark, tmp_path):
    root, out = tmp_path / "in", tmp_path / "out"

    def plate(name, cells):
        header = "\t".join([*plates.OBJECT_HEADER, "Hoechst - Class", "Code"])
        plates.write(root / name / "Index.txt", plates.index_lines([(1, 1, 1)]))
        lines = [LINE(1, 1, 1, i, list(c)) for i, c in enumerate(cells)]
        plates.write(root / name / "Objects_Population - Hoechst.txt", [header, *lines])

    plate("A", [(1, 1), (2, 2)])
    done = convert(spark, root, out)
    assert {k: v for k, v in done["Hoechst"].dtypes if k in ("HoechstClass", "Code")} == {"HoechstClass": "double", "Code": "bigint"}
    plate("A", [])
    for path in (root / "A").rglob("*.txt"):
        path.unlink()
    plate("B", [("round", "x1"), ("flat", 2), ("2D", 3)])
    done = convert(spark, root, out, overwrite=True)
    rows = {(r["plate"], r["HoechstClass"], r["Code"]) for r in done["Hoechst"].collect()}
    assert rows == {("A", "1.0", "1"), ("A", "2.0", "2"), ("B", "round", "x1"), ("B", "flat", "2"), ("B", "2D", "3")}
    assert rows == {(r["plate"], r["HoechstClass"], r["Code"]) for r in tables.read_current(spark, str(out), "objects_Hoechst").collect()}


def test_first_lines_that_tell_too_little(spark, tmp_path):
    """The smallest file has numbers only; the other has text: the objects are written once more."""
    root, out = tmp_path / "in", tmp_path / "out"
    header = "\t".join([*plates.OBJECT_HEADER, "Hoechst - Class"])
    for name, cells in (("A", ["1"]), ("B", ["a", "b", "c"])):
        plates.write(root / name / "Index.txt", plates.index_lines([(1, 1, 1)]))
        plates.write(root / name / "Objects_Population - Hoechst.txt", [header, *(LINE(1, 1, 1, 1, [c]) for c in cells)])
    done = convert(spark, root, out)
    assert sorted((r["plate"], r["HoechstClass"]) for r in done["Hoechst"].collect()) == [("A", "1"), ("B", "a"), ("B", "b"), ("B", "c")]
    assert "Per_Field_HoechstClass" not in done["images"].columns


def test_time_points_have_the_files_of_their_cycles(spark, tmp_path):
    lines = plates.index_lines([(1, 1, 1)], channels=["HOECHST 33342"])
    second, late = lines[1].split("\t"), lines[1].split("\t")
    second[3], late[3] = "2", "5"
    plates.write(tmp_path / "a" / "P" / "Index.txt", [*lines, "\t".join(second), "\t".join(late)])
    header = "\t".join([*plates.OBJECT_HEADER, "Hoechst - Area"])
    plates.write(tmp_path / "a" / "P" / "Objects_Population - Hoechst.txt", [header, LINE(1, 1, 1, 1, [2.5])])
    write(tmp_path / "a", "Q", 1.0)
    names = [("P", f"/x/P/Images/r01c01f01p01-ch1sk{c}fk1fl1.tiff") for c in (1, 2, 3)]
    names += [("Q", f"/x/Q/Images/r01c01f01p01-ch1sk{c}fk1fl1.tiff") for c in (1, 2)]
    files = spark.createDataFrame(names, "plate string, path string")
    done = plan.convert(spark, exports.ExportFiles(str(tmp_path / "a")), files, plates.LINKS, str(tmp_path / "out"))
    got = {(r["plate"], r["Timepoint"]): r["Image__URL_Hoechst"] for r in done["images"].collect()}
    assert got == {("P", 1): names[0][1], ("P", 2): names[1][1], ("P", 5): names[2][1], ("Q", 1): names[4][1]}


def test_a_population_is_added_without_a_shuffle(spark, tmp_path):
    rows = spark.range(3000).selectExpr("concat('P', id % 7) AS plate", "id % 8 AS `Row`", "id div 8 % 12 AS `Column`", "id div 96 AS Field")
    images = bucketed.write_bucketed(rows.withColumn("ImageNumber", F.lit(1)), f"{tmp_path}/images", buckets=4)
    profiles = [bucketed.write_bucketed(rows.filter(f"Field % {n} = 0").withColumn(f"n_{n}", F.lit(n)), f"{tmp_path}/p{n}", buckets=4)
                for n in (2, 3)]
    table = bucketed.assembled(images, profiles)
    assert "Exchange" not in table._jdf.queryExecution().executedPlan().toString()
    assert table.count() == 3000 and table.agg(F.count("n_2"), F.count("n_3")).first() == (
        rows.filter("Field % 2 = 0").count(), rows.filter("Field % 3 = 0").count())
    new = bucketed.write_bucketed(rows.withColumn("n_5", F.lit(5)), f"{tmp_path}/p5", buckets=4)
    third = bucketed.assembled(table, [new])
    plan_text = third._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan_text and plan_text.count("SortMergeJoin") == 3
    spark.sql(f"DROP TABLE {bucketed._name(f'{tmp_path}/p5')}")
    again = bucketed.read_bucketed(spark, f"{tmp_path}/p5", buckets=4)
    assert "Exchange" not in bucketed.assembled(table, {"five": again})._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, new.collect()))


def test_plates_are_cut_into_parts(spark, tmp_path):
    rows = spark.range(1000).selectExpr("if(id < 700, 'hot', concat('P', id % 9)) AS plate", "id % 2 AS `Row`", "1L AS `Column`", "id % 3 AS Field", "id")
    rows.write.parquet(f"{tmp_path}/o")
    objects = spark.read.parquet(f"{tmp_path}/o")
    images = objects.select("plate", "Row", "Column", "Field").distinct().withColumn("ImageNumber", F.hash("plate", "Row", "Field").cast("long"))
    images = spark.createDataFrame(images.collect(), images.schema)
    parts = spark.createDataFrame([("hot", 5), *((f"P{i}", 1) for i in range(9))], "plate string, _parts long")
    joined = keys.attach_keys_by_plate(objects, images, parts)
    got = joined.select("id", "ImageNumber", "Well").collect()
    expected = objects.select("id", F.hash("plate", "Row", "Field").cast("long"))
    assert sorted((r["id"], r["ImageNumber"]) for r in got) == sorted(map(tuple, expected.collect()))
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2 and text.count("REPARTITION_BY_NUM") == 2
    spread = joined.filter("plate = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 1
