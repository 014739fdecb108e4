"""Queries over the test tables, and the same in SQL.

``queries()`` applies the library's operators to plate-shaped views of the
tables (``platewright.plans.screen``); ``oracle_sql()`` says the same in plain
SQL. All queries run over the whole tables.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle_sql import ORACLE
from platewright.functions import names, text, wells
from platewright.functions.paths import file_name, folder, parse_image_paths
from platewright.operators import images as im
from platewright.operators import keys, profiles
from platewright.operators.joins import fill_if_null
from platewright.plans import convert, manifest, screen
from platewright.sources import bucketed, exports, folders, listing, synthetic, tables
from platewright.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]


def _present(name: str):
    """A module of the training-data part, or None where that part is left out."""
    part = importlib.util.find_spec("platewright.llm")
    # A folder without its own code (caches only) has no origin.
    if part is None or part.origin is None or importlib.util.find_spec(name) is None:
        return None
    return importlib.import_module(name)


llm = _present("platewright.llm.queries")
corpus_pipeline = _present("corpus_pipeline")
MEASURES = ["Area", "Intensity"]


def entry(spark: SparkSession) -> DataFrame:
    """The per-image table of the smallest test tables."""
    return image_table(spark, "/root/testdata/sf0.001")


# -- keys ------------------------------------------------------------------


def image_number(spark, sf_dir):
    return keys.number_index(screen.index_view(spark, sf_dir)).select(
        "seq", "plate", "Row", "Column", "Field", "ImageNumber"
    )


def well_label(spark, sf_dir):
    index = screen.index_view(spark, sf_dir)
    return wells.with_wells(index).select("seq", "Row", "Column", "Well", "WellRow", "WellColumn")


def _plate_grid(plate_type: int) -> Query:
    """Wells of larger plates, from customer keys; rows beyond it have no label."""

    def query(spark, sf_dir):
        text_row = F.concat(F.expr("c_custkey % 34").cast("string"), F.lit(".0"))
        grid = screen.table(spark, sf_dir, "customer").select(
            "c_custkey", wells.whole_number(text_row).alias("Row"),
            F.expr("c_custkey % 48 + 1").alias("Column"),
        )
        return wells.with_wells(grid, plate_type)

    return query


def attach_keys(spark, sf_dir):
    objects = screen.objects_view(spark, sf_dir)
    return keys.attach_keys(objects, keys.image_keys(screen.index_view(spark, sf_dir)))


def object_index_fanout(spark, sf_dir):
    objects, index = screen.objects_view(spark, sf_dir), screen.index_view(spark, sf_dir)
    return keys.fanout_counts(objects, index, ["population"])


def unmatched_objects(spark, sf_dir):
    images = keys.image_keys(screen.index_view(spark, sf_dir))
    return keys.unmatched_counts(screen.objects_view(spark, sf_dir), images, ["population"])


def rename_measures(spark, sf_dir):
    """The tables of all populations, one below the other; columns by population."""
    frames = []
    for p in screen.LINKS:
        objects = screen.population_view(spark, sf_dir, p)
        measures = names.measurement_columns(objects, p)
        added = keys.add_columns(objects, {"ImageNumber": "bigint", "X": "double"})
        renamed = keys.rename_object_columns(added.drop("BoundingBox", "NotThere"), p)
        prefixed = dict(zip(measures, names.prefixed_names(measures)))
        frames.append(renamed.withColumnsRenamed(prefixed))
    return exports.union_tables(frames)


# -- counts and means ------------------------------------------------------


WELL = ["plate", "population", "Row", "Column"]


def _labelled(grouped: DataFrame) -> DataFrame:
    """Row and Column as Well, once per group instead of once per object."""
    return wells.with_wells(grouped).drop("Row", "Column", "WellRow", "WellColumn")


def _population(spark, sf_dir, population):
    return wells.with_wells(screen.population_view(spark, sf_dir, population))


def field_profile(spark, sf_dir):
    images = keys.image_keys(screen.index_view(spark, sf_dir))
    objects = {p: screen.population_view(spark, sf_dir, p) for p in screen.LINKS}
    measures = {p: screen.measure_names(p) for p in screen.LINKS}
    table = profiles.with_profiles(images, objects, measures, screen.DECIMALS)
    return table.drop("Row", "Column", "WellRow", "WellColumn", "first_seq", "index_rows")


def count_per_image(spark, sf_dir):
    objects = screen.objects_view(spark, sf_dir)
    return _labelled(profiles.field_profile(objects, [], "Image_Count", [*WELL, "Field"]))


def mean_per_image(spark, sf_dir):
    objects = screen.objects_view(spark, sf_dir)
    profile = profiles.field_profile(objects, MEASURES, "n", [*WELL, "Field"], screen.DECIMALS)
    return _labelled(profile.drop("n"))


def well_median_std(spark, sf_dir):
    profile = profiles.well_profile(screen.objects_view(spark, sf_dir), MEASURES, WELL)
    return _labelled(profile).withColumns({f"Std_{m}": F.round(f"Std_{m}", 4) for m in MEASURES})


def image_table(spark, sf_dir):
    index = screen.index_view(spark, sf_dir)
    return profiles.image_table(
        index,
        parse_image_paths(screen.files_view(spark, sf_dir)),
        screen.LINKS,
        keys.image_keys(index),
        {p: screen.population_view(spark, sf_dir, p) for p in screen.LINKS},
        {p: screen.measure_names(p) for p in screen.LINKS},
        decimals=screen.DECIMALS,
    )


def image_table_planes(spark, sf_dir):
    """Two planes of every image, each with the file whose position is the plane."""
    index = screen.index_view(spark, sf_dir)
    planes = index.withColumn("Plane", F.explode(F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))))
    return profiles.image_table(
        planes, parse_image_paths(screen.files_view(spark, sf_dir)), screen.LINKS, keys.image_keys(index),
        {p: screen.population_view(spark, sf_dir, p) for p in screen.LINKS},
        {p: screen.measure_names(p) for p in screen.LINKS}, decimals=screen.DECIMALS, plane=True,
    )


def image_table_times(spark, sf_dir):
    """Three time points of every image, each with the file of the last cycle up to it."""
    index, files = screen.index_view(spark, sf_dir), screen.files_view(spark, sf_dir)
    times = F.explode(F.array(*[F.lit(t).cast("long") for t in (1, 2, 3)]))
    cycles = F.expr("explode(CASE seq % 3 WHEN 0 THEN array(1, 3) WHEN 1 THEN array(2) ELSE array(1, 2, 5) END)")
    path = F.replace("path", F.lit("sk1fk"), F.concat(F.lit("sk"), F.col("cycle"), F.lit("fk")))
    files = files.withColumn("cycle", cycles).withColumn("path", path).drop("cycle")
    return profiles.image_table(
        index.withColumn("Timepoint", times), parse_image_paths(files), screen.LINKS, keys.image_keys(index),
        {p: screen.population_view(spark, sf_dir, p) for p in screen.LINKS},
        {p: screen.measure_names(p) for p in screen.LINKS}, decimals=screen.DECIMALS, times=True,
    )


def image_number_append(spark, sf_dir):
    """Images numbered from every second index row, then from all of them: numbers stay."""
    index = screen.index_view(spark, sf_dir)
    given = keys.image_keys(index.filter(F.col("seq") % 2 == 1))
    return keys.image_keys(index, given=given).select("plate", "Row", "Column", "Field", "ImageNumber")


def profile_delta(spark, sf_dir):
    """Counts and means kept up to date: of five files a plate one is gone, one has changed
    and one is new; only the last two are read for it."""
    objects = screen.objects_view(spark, sf_dir).withColumn("source_file", F.concat(F.lit("f"), F.col("ObjectNo") % 5))
    by = [*WELL, "Field", "source_file"]
    known = profiles.profile_states(objects, MEASURES, screen.DECIMALS, by)
    gone = objects.select("plate", "source_file").distinct().filter(F.col("source_file").isin("f0", "f1"))
    changed = objects.filter("source_file = 'f1'").withColumn("Area", F.col("Area") + 1)
    new = objects.filter("source_file = 'f2'").withColumn("source_file", F.lit("f9"))
    came = profiles.profile_states(changed.unionByName(new), MEASURES, screen.DECIMALS, by)
    states = profiles.changed_states(known, gone, came)
    return profiles.profile_of_states(states, MEASURES, "n_objects", [*WELL, "Field"])


def image_table_zero(spark, sf_dir):
    images = keys.image_keys(screen.index_view(spark, sf_dir))
    objects = {p: screen.population_view(spark, sf_dir, p) for p in screen.LINKS}
    counted = profiles.with_profiles(images, objects, {p: [] for p in objects}, zero_fill=True)
    return counted.drop("Row", "Column", "WellRow", "WellColumn", "first_seq", "index_rows")


# -- channels, files, images -----------------------------------------------


def channel_names(spark, sf_dir):
    return im.channel_names(screen.index_view(spark, sf_dir))


def distinct_channels(spark, sf_dir):
    return im.channel_ids(screen.index_view(spark, sf_dir))


def image_sizes(spark, sf_dir):
    return im.image_sizes(screen.index_view(spark, sf_dir))


def _linked(spark, sf_dir):
    populations = screen.objects_view(spark, sf_dir).select("plate", "population").distinct()
    return manifest.links_frame(populations, screen.LINKS)


def population_sizes(spark, sf_dir):
    return im.population_sizes(_linked(spark, sf_dir), image_sizes(spark, sf_dir))


def manifest_long(spark, sf_dir):
    return manifest.manifest_long(
        _linked(spark, sf_dir), image_sizes(spark, sf_dir), database="screen"
    )


def manifest_text(spark, sf_dir):
    """The lines of the settings' texts, written and read back."""
    path, rows = new_folder(spark, "manifest"), manifest_long(spark, sf_dir)
    tables.write_manifest(rows, path, [])
    return spark.read.text(path).select("plate", "population", F.col("value").alias("line"))


def list_images(spark, sf_dir):
    """An image file for every customer, written, found again and read off by name."""
    root = new_folder(spark, "pictures")
    name = F.format_string(
        "r%02dc%02df%02dp01-ch%dsk1.tiff", F.expr("c_custkey div 16 % 8 + 1"), F.expr("c_custkey div 128 % 12 + 1"),
        F.expr("c_custkey div 1536 + 1"), F.expr("c_custkey % 16 + 1"),
    )
    place = F.concat(F.lit(f"{listing.qualified(spark, root)}/"), "c_mktsegment", F.lit("/Images/"), name)
    written = screen.table(spark, sf_dir, "customer").select(place.alias("path")).mapInPandas(
        listing.write_empty, "path string")
    written.agg(F.count("*")).collect()
    found = parse_image_paths(exports.list_images(spark, root))
    return found.select("plate", "Row", "Column", "Field", "ChannelID", "length", file_name(F.col("path")).alias("file"))


def parse_image_path(spark, sf_dir):
    files = parse_image_paths(screen.files_view(spark, sf_dir))
    return files.withColumns(
        {"file_name": file_name(F.col("path")), "folder": folder(F.col("path"))}
    )


def attach_paths(spark, sf_dir):
    files = parse_image_paths(screen.files_view(spark, sf_dir))
    return im.attach_paths(screen.index_view(spark, sf_dir), files).select(
        "seq", "ChannelID", "Image_Path", "Image__URL"
    )


def image_flatten(spark, sf_dir):
    index = screen.index_view(spark, sf_dir)
    files = parse_image_paths(screen.files_view(spark, sf_dir))
    return im.flatten_images(index, files, screen.LINKS, keys.image_keys(index))


def image_flatten_15key(spark, sf_dir):
    index = screen.index_view(spark, sf_dir)
    files = parse_image_paths(screen.files_view(spark, sf_dir))
    return im.flatten_15(index, files, screen.LINKS, keys.image_keys(index))


def first_per_key(spark, sf_dir):
    index = screen.index_view(spark, sf_dir)
    stained = index.filter(F.col("ChannelName").isin(list(screen.LINKS.values())))
    return im.first_values(stained, ["plate", "Row", "Column", "Field"], "ChannelName")


def plate_count(spark, sf_dir):
    return im.number_folders(screen.files_view(spark, sf_dir))


def plate_total(spark, sf_dir):
    folders = screen.files_view(spark, sf_dir).select(folder(F.col("path")).alias("folder"))
    return folders.agg(F.countDistinct("folder").alias("plate_count"))


# -- text ------------------------------------------------------------------


def clean_names(spark, sf_dir):
    heading = F.concat_ws(" - ", "p_name", "p_type", F.concat(F.col("p_brand"), F.lit(" [µm²]")))
    file = F.concat(F.lit("Objects_Population - "), F.col("p_name"), F.lit("_trimmed.csv"))
    cleaned = names.clean_name_col(heading)
    return screen.table(spark, sf_dir, "part").select(
        "p_partkey", cleaned.alias("clean"), names.table_name_col(file).alias("table_name"),
        names.prefixed_col(F.concat(cleaned, cleaned)).alias("prefixed"),
    )


def legacy_names(spark, sf_dir):
    """Headings made of part names, cleaned in each of the older styles."""
    heading = F.concat(F.col("p_type"), F.lit(" - Group%/["), F.col("p_name"), F.lit(" µm²] µm"))
    styles = [names.clean_name_col(heading, s).alias(s) for s in names.LEGACY_STYLES]
    return screen.table(spark, sf_dir, "part").select("p_partkey", *styles)


def trim_preamble(spark, sf_dir):
    whole = F.col("text")
    return screen.table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(text.from_marker(whole, "the")).alias("trimmed_md5"),
        F.length(text.from_marker(whole, "the")).cast("bigint").alias("trimmed_length"),
        text.first_word(whole).alias("first_word"),
        text.starts_with_word(whole, "the").alias("starts_the"),
    )


def _preambles(spark, sf_dir):
    """Eight lines per customer, of which the last is beyond the metadata."""
    lines = F.array(
        F.lit("Database Name\tscreen"),
        F.concat(F.lit("Plate Name\t"), F.col("c_mktsegment")),
        F.concat(F.lit("  Evaluation \t "), F.col("c_name"), F.lit("  ")),
        F.lit("a\tb\tc"), F.lit(""),
        F.concat(F.lit("Balance\t"), F.col("c_nationkey").cast("string")),
        F.concat(F.lit("Evaluation\t"), F.col("c_custkey").cast("string")),
        F.lit("Population\tlate"),
    )
    return screen.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("file"), F.posexplode(lines).alias("line_no", "value")
    )


def metadata_pairs(spark, sf_dir):
    return text.metadata_pairs(_preambles(spark, sf_dir))


def plate_files(spark, sf_dir):
    pairs = text.metadata_pairs(_preambles(spark, sf_dir))
    named = pairs.filter(F.col("key") == "Plate Name")
    return named.groupBy(F.col("value").alias("plate_name")).agg(F.count("*").alias("n_files"))


def fill_nulls(spark, sf_dir):
    index, objects = screen.index_view(spark, sf_dir), screen.objects_view(spark, sf_dir)
    filled = text.fill_nulls(objects, {"Intensity": -1.0})
    by_plate = filled.groupBy("plate").agg(
        F.count_if(F.col("Intensity") == -1.0).alias("n_filled"), F.count("Intensity").alias("n")
    )
    fields = text.fill_nulls(index, {"Field": 0}).groupBy("plate").agg(
        F.count_if(F.col("Field") == 0).alias("n_fields_filled")
    )
    return by_plate.join(fields, "plate", "left")


def fill_null_rows(spark, sf_dir):
    placed = F.when(F.col("Field").isNotNull(), F.col("PositionXm"))
    index = screen.index_view(spark, sf_dir).withColumn("PositionXm", placed)
    return text.fill_nulls(index, {"Field": 0, "PositionXm": 0.0}).select(
        "seq", "Field", "PositionXm"
    )


def fill_image_values(spark, sf_dir):
    images = keys.image_keys(screen.index_view(spark, sf_dir))
    images = images.select("plate", "ImageNumber", "Well", "Field")
    counts = {
        p: profiles.field_profile(_population(spark, sf_dir, p), [], "n_objects")
        for p in screen.LINKS
    }
    first = profiles.add_profile(images, counts.pop("Hoechst"))
    for count in counts.values():
        first = fill_if_null(first, count, ["plate", "Well", "Field"], "n_objects", "n_objects")
    return first


def bounding_box(spark, sf_dir):
    objects = screen.objects_view(spark, sf_dir).select("plate", "ObjectNo", "BoundingBox")
    return text.with_bounding_box(objects)


# -- generated plates, files, tables ---------------------------------------


def synthetic_plates(spark, sf_dir):
    """As many made-up objects per image as the image has lines."""
    lines = screen.table(spark, sf_dir, "lineitem")
    images = (
        lines.groupBy(F.expr("l_orderkey div 4").alias("image_id")).agg(F.count("*").alias("n"))
        .selectExpr("*", *screen.position("(image_id * 4)"))
    )
    return synthetic.random_objects(images, "Hoechst", F.col("n"))


def ingest_roundtrip(spark, sf_dir):
    """Objects written as export text and read back, one row per object."""
    root = new_folder(spark, "exports")
    _write_object_exports(spark, sf_dir, root)
    files = exports.ExportFiles(root, r"plate=([^/]+)/", r"table=([^/]+)/")
    heads = exports.export_heads(exports.list_exports(spark, files)).checkpoint()
    frames = [
        exports.read_objects(spark, files, heads, p)
        .withColumn("population", F.lit(p))
        .withColumnsRenamed(dict(zip(screen.measure_names(p), MEASURES)))
        for p in exports.populations_of(heads)
    ]
    return exports.union_tables(frames)


def _write_object_exports(spark, sf_dir, root, populations=tuple(screen.LINKS), chosen=None, area_value=None, mode="append"):
    for population in populations:
        rows = screen.population_view(spark, sf_dir, population)
        area, intensity = screen.measure_names(population)
        if chosen is not None:
            rows = chosen(rows.withColumnRenamed(area, "Area")).withColumn("Area", area_value).withColumnRenamed("Area", area)
        headings = {
            "Row": "Row", "Column": "Column", "Field": "Field", "ObjectNo": "Object No", "X": "X",
            "Y": "Y", "BoundingBox": "Bounding Box", "blank": " ",
            area: f"{population} - Area [µm²]", intensity: f"{population} - Intensity Mean",
        }
        cells = rows.withColumn("blank", F.lit(None).cast("string"))
        synthetic.write_exports(cells, root, population, headings, mode=mode)


#: By the last digits of a line's keys: a line of one cell, a line without a column, a
#: row that ends early and a row with a cell too many. All others are whole rows.
ODD_LINES = "(l_orderkey + l_partkey) % 20"


def ingest_rejects(spark, sf_dir):
    """What becomes of every line of exports with preambles, two headers and odd lines."""
    root = new_folder(spark, "exports")
    cells = "concat_ws('\t', Row, Column, Field, l_linenumber, l_quantity)"
    more = "if(v = 0, '', concat('\t', l_discount))"
    lines = (
        screen.table(spark, sf_dir, "lineitem").selectExpr("*", *screen.position("l_orderkey"), "l_orderkey % 2 AS v")
        .withColumn("line", F.expr(
            f"CASE {ODD_LINES} WHEN 0 THEN '7' WHEN 1 THEN concat(Row, '\tx') WHEN 2 THEN concat(Row, '\t', Column)"
            f" WHEN 3 THEN concat({cells}, {more}, '\tmore') ELSE concat({cells}, {more}) END"))
        .selectExpr("plate", f"{screen.choice('l_returnflag', screen.POPULATIONS)} AS table", "v", "2 AS rank", "line")
    )
    header = F.concat(F.lit("Row\tColumn\tField\tObject No\tX"), F.when(F.col("v") == 0, "").otherwise("\tY"))
    first = F.array(F.struct(F.lit(0).alias("rank"), F.lit("Database Name\tscreen").alias("line")),
                    F.struct(F.lit(0).alias("rank"), F.lit("[Data]").alias("line")),
                    F.struct(F.lit(1).alias("rank"), header.alias("line")))
    heads = lines.select("plate", "table", "v").distinct().select("*", F.inline(first))
    every = lines.unionByName(heads).repartition("plate", "table", "v")
    every.sortWithinPartitions("plate", "table", "v", "rank").drop("rank").write.partitionBy("plate", "table", "v").text(root)
    files = exports.ExportFiles(root, r"plate=([^/]+)/", r"table=([^/]+)/")
    heads = exports.export_heads(exports.list_exports(spark, files)).checkpoint()
    frames = []
    for p in exports.populations_of(heads):
        raws, mine = exports.read_raw(spark, files, heads, p, places=True), heads.filter(F.col("table") == p)
        bad = exports.union_tables([exports.rejected(raw, mine) for raw in raws])
        listed = bad.groupBy("plate").agg(F.count("*").alias("n_rejected"), F.count_if(F.col("line") == "7").alias("n_short"))
        frames.append(exports.line_counts(raws, mine).join(listed, "plate", "left").withColumn("population", F.lit(p)))
    return exports.union_tables(frames)


def _write_lines(rows, root, header):
    """``plate``, ``table`` and ``line`` of rows as header-first export text."""
    folders.write_folders(rows.repartition("plate", "table"), root, ["plate", "table"], "part", text=True, header=header)
    return exports.ExportFiles(root, r"plate=([^/]+)/", r"table=([^/]+)/")


#: Notes with line breaks, tabs and quotes, by the last digit of a key.
NOTES = {0: "two\nlines", 1: "a\tb", 2: 'say "hi"', 3: '"', 4: 'x\r\n"\n\t\n"y', 5: '\n', 6: ' ""\n"" '}


def ingest_quoted(spark, sf_dir):
    """Rows with a note in quotes, which may go on over several lines, read back."""
    note = F.element_at(F.create_map(*[F.lit(x) for pair in NOTES.items() for x in pair]), F.col("k"))
    note = F.when(F.col("k") < 7, note).otherwise(F.concat(F.lit("plain "), F.col("l_quantity").cast("string")))
    cell = F.concat(F.lit('"'), F.replace("note", F.lit('"'), F.lit('""')), F.lit('"'))
    rows = (
        screen.table(spark, sf_dir, "lineitem").selectExpr("*", *screen.position("l_orderkey"), "cast(l_partkey % 10 as int) AS k")
        .withColumn("note", note).withColumn("table", F.expr(screen.choice("l_returnflag", screen.POPULATIONS)))
        .withColumn("line", F.concat_ws("\t", "Row", "Column", F.when(F.col("k") == 7, F.lit('5" x')).otherwise(cell), "Field", "l_linenumber"))
    )
    files = _write_lines(rows.select("plate", "table", "line"), new_folder(spark, "exports"), 'Row\tColumn\t"Note"\tField\tObject No')
    heads = exports.export_heads(exports.list_exports(spark, files)).checkpoint()
    return exports.union_tables([
        exports.read_objects(spark, files, heads, p).withColumn("population", F.lit(p)) for p in exports.populations_of(heads)
    ])


def reject_places(spark, sf_dir):
    """Rejected lines with their places, among them lines that are also before the header."""
    root, numbers = new_folder(spark, "exports"), F.col("l_orderkey") * 8 + F.col("l_linenumber")
    before = ["Database Name\tscreen", "7\t7\tnot a row yet", "", "[Data]"]
    lines = (
        screen.table(spark, sf_dir, "lineitem").selectExpr("*", *screen.position("l_orderkey"))
        .withColumn("rank", numbers * 1000 + F.col("l_partkey") % 1000)
        .groupBy("plate", "rank").agg(F.min(F.struct("Row", "Column", "Field", "l_quantity")).alias("r"))
        .withColumn("line", F.expr("CASE rank % 17 WHEN 0 THEN 'Database Name\tscreen' WHEN 1 THEN '[Data]' WHEN 2 THEN ''"
                                   " WHEN 3 THEN concat('x', rank) ELSE concat_ws('\t', r.Row, r.Column, r.Field, r.l_quantity) END"))
    )
    first = F.array(*[F.struct(F.lit(i - 9).cast("long").alias("rank"), F.lit(line).alias("line"))
                      for i, line in enumerate([*before, "Row\tColumn\tField\tX"])])
    heads = lines.select("plate").distinct().select("plate", F.inline(first))
    every = lines.select("plate", "rank", "line").unionByName(heads).withColumn("table", F.lit("Hoechst")).repartition("plate")
    every.sortWithinPartitions("plate", "table", "rank").drop("rank").write.partitionBy("plate", "table").text(root)
    files = exports.ExportFiles(root, r"plate=([^/]+)/", r"table=([^/]+)/")
    found = exports.export_heads(exports.list_exports(spark, files)).checkpoint()
    return exports.rejects(spark, files, found, "Hoechst").select("plate", "line_no", "line")


def typed_columns(spark, sf_dir):
    """Columns of numbers, of text and of both, each with the type that its cells give it."""
    cells = {
        "{p} - Size": "l_partkey", "{p} - Area": "l_extendedprice", "{p} - Class": "concat(l_linestatus, l_linenumber, 'D')",
        "{p} - Mostly number": "if(l_partkey % 10 = 0, 'none', string(l_quantity))", "{p} - Mostly text": "if(l_partkey % 10 = 0, string(l_quantity), '1F')",
        "Code": "l_suppkey", "Share": "if(l_suppkey % 2 = 0, 1, l_discount)", "Note": "if(l_partkey % 50 = 0, 'x', string(l_partkey))",
        "Nothing": "'NA'",
    }
    root, frames = new_folder(spark, "exports"), []
    rows = screen.table(spark, sf_dir, "lineitem").selectExpr(
        "*", *screen.position("l_orderkey"), f"{screen.choice('l_returnflag', screen.POPULATIONS)} AS table")
    line = F.expr("concat_ws('\t', Row, Column, Field, l_linenumber, " + ", ".join(cells.values()) + ")")
    for p in screen.LINKS:
        header = "\t".join(["Row", "Column", "Field", "Object No", *[c.format(p=p) for c in cells]])
        mine = rows.filter(F.col("table") == p).select("plate", "table", line.alias("line"))
        files = _write_lines(mine, f"{root}/{p}", header)
        heads = exports.export_heads(exports.list_exports(spark, files)).checkpoint()
        read = exports.read_objects(spark, files, heads, p)
        frames.append(read.toDF(*[c.removeprefix(p) for c in read.columns]).withColumn("population", F.lit(p)))
    return exports.union_tables(frames)


def index_two_files(spark, sf_dir):
    """Images numbered over an index in two files per plate: first by file, then by line."""
    root, index = new_folder(spark, "index"), screen.index_view(spark, sf_dir)
    headings = {c: c for c in index.columns if c not in ("plate", "seq")}
    for part in (0, 1):
        rows = index.filter(F.col("seq") % 2 == 1 - part)
        synthetic.write_exports(rows, f"{root}/part={part}", "Index", headings, order="seq")
    files = exports.ExportFiles(root, r"plate=([^/]+)/", r"table=([^/]+)/")
    heads = exports.export_heads(exports.list_exports(spark, files)).checkpoint()
    images = keys.image_keys(exports.read_index(spark, files, heads))
    return images.select("plate", "Row", "Column", "Field", "ImageNumber", "index_rows")


def convert_again(spark, sf_dir):
    """Every third plate converted again from another folder, changed and with one population
    less, after the first folder's text was changed too."""
    first, second, out = (new_folder(spark, n) for n in ("exports", "exports", "converted"))
    some = F.substring("plate", 2, 6).cast("long") % 3 == 0
    _write_object_exports(spark, sf_dir, first)
    index = screen.index_view(spark, sf_dir)
    headings = {c: c for c in index.columns if c not in ("plate", "seq")}
    synthetic.write_exports(index, first, "Index", headings, order="seq")
    links, images = screen.LINKS, screen.files_view(spark, sf_dir).drop("seq")

    def run(root):
        files = exports.ExportFiles(root, r"plate=([^/]+)/", r"table=([^/]+)/")
        return convert.convert(spark, files, images, links, out, overwrite=True, decimals=screen.DECIMALS)

    columns = run(first)["images"].schema
    _write_object_exports(spark, sf_dir, first)
    synthetic.write_exports(index.filter(some), second, "Index", headings, order="seq")
    changed = F.col("Area") + 1
    _write_object_exports(spark, sf_dir, second, ["Hoechst", "O4Final"], lambda rows: rows.filter(some), changed)
    run(second)
    return spark.read.schema(columns).parquet(f"{out}/images")


EVERY_THIRD = "cast(substr(plate, 2, 6) as bigint) % 3 = 0"


def _converted(spark, sf_dir):
    """All plates written as exports and converted; and the conversion, to do again."""
    root, out = new_folder(spark, "exports"), new_folder(spark, "converted")
    _write_object_exports(spark, sf_dir, root)
    index = screen.index_view(spark, sf_dir)
    synthetic.write_exports(index, root, "Index", {c: c for c in index.columns if c not in ("plate", "seq")}, order="seq")
    files = exports.ExportFiles(root, r"plate=([^/]+)/", r"table=([^/]+)/")
    images = screen.files_view(spark, sf_dir).drop("seq")

    def again(**changed):
        return convert.convert(spark, files, images, screen.LINKS, out, **{"decimals": screen.DECIMALS, **changed})

    return root, out, again


def replace_broken_off(spark, sf_dir):
    """All plates converted, then changed and converted again by a run that breaks off when
    the objects have been written: the tables have the first rows."""
    root, out, again = _converted(spark, sf_dir)
    like = again()["images"]
    _write_object_exports(spark, sf_dir, root, ["Hoechst"], lambda rows: rows, F.col("Area") + 1, mode="overwrite")
    try:
        again(overwrite=True, decimals=99)  # no sum has so many places
    except ParseException:
        return tables.read_current(spark, out, "images", like)
    raise AssertionError("the second run was to break off")


def convert_changed(spark, sf_dir):
    """Every third plate changed, and only those converted again."""
    root, out, again = _converted(spark, sf_dir)
    again()
    _write_object_exports(spark, sf_dir, root, ["Hoechst"], lambda rows: rows.filter(EVERY_THIRD), F.col("Area") + 1, mode="overwrite")
    return again(overwrite=True, only_changed=True)["images"]


def add_population(spark, sf_dir):
    """Two populations' counts and means by image, then a third one's, joined as they lie."""
    folder, images = new_folder(spark, "buckets"), keys.image_keys(screen.index_view(spark, sf_dir))
    written = bucketed.write_bucketed(images, f"{folder}/images")
    found = {}
    for p in screen.LINKS:
        profile = profiles.field_profile(
            screen.population_view(spark, sf_dir, p), screen.measure_names(p), f"Image_Count_{p}", keys.IMAGE_KEYS, screen.DECIMALS)
        found[p] = bucketed.write_bucketed(profile, f"{folder}/{p}")
    table = bucketed.assembled(written, found)
    return table.drop("Row", "Column", "WellRow", "WellColumn", "first_seq", "index_rows")


def table_rewrite(spark, sf_dir):
    """Counts per image written by plate, then rewritten for the plates that
    have an object with a full discount, with a higher run number."""
    path = new_folder(spark, "table")
    counts = count_per_image(spark, sf_dir)
    tables.write_table(counts.withColumn("run", F.lit(1)), path)
    again = screen.table(spark, sf_dir, "lineitem").filter("l_discount >= 0.1 and l_quantity >= 50")
    plates = again.selectExpr(*screen.position("l_orderkey")).select("plate").distinct()
    return tables.write_table(
        counts.join(plates, "plate", "left_semi").withColumn("run", F.lit(2)), path
    )


def convert_plates(spark, sf_dir):
    """The whole conversion, from export text to the written per-image table."""
    root, out = new_folder(spark, "exports"), new_folder(spark, "converted")
    _write_object_exports(spark, sf_dir, root)
    index = screen.index_view(spark, sf_dir)
    headings = {c: c for c in index.columns if c not in ("plate", "seq")}
    synthetic.write_exports(index, root, "Index", headings, order="seq")
    files = exports.ExportFiles(root, r"plate=([^/]+)/", r"table=([^/]+)/")
    done = convert.convert(
        spark, files, screen.files_view(spark, sf_dir).drop("seq"), screen.LINKS, out,
        decimals=screen.DECIMALS,
    )
    return done["images"]


def oracle_sql() -> dict[str, str]:
    found = {**ORACLE, **(llm.ORACLE if llm else {})}
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def queries() -> dict[str, Query]:
    return {
        "field_profile": field_profile,
        "image_number": image_number,
        "well_label": well_label,
        "well_label_384": _plate_grid(384),
        "well_label_1536": _plate_grid(1536),
        "attach_keys": attach_keys,
        "object_index_fanout": object_index_fanout,
        "unmatched_objects": unmatched_objects,
        "rename_measures": rename_measures,
        "count_per_image": count_per_image,
        "mean_per_image": mean_per_image,
        "well_median_std": well_median_std,
        "image_table": image_table,
        "image_table_zero": image_table_zero,
        "image_table_planes": image_table_planes,
        "image_table_times": image_table_times,
        "image_number_append": image_number_append,
        "profile_delta": profile_delta,
        "channel_names": channel_names,
        "distinct_channels": distinct_channels,
        "image_sizes": image_sizes,
        "population_sizes": population_sizes,
        "manifest_long": manifest_long,
        "manifest_text": manifest_text,
        "list_images": list_images,
        "parse_image_path": parse_image_path,
        "attach_paths": attach_paths,
        "image_flatten": image_flatten,
        "image_flatten_15key": image_flatten_15key,
        "first_per_key": first_per_key,
        "plate_count": plate_count,
        "plate_total": plate_total,
        "clean_names": clean_names,
        "legacy_names": legacy_names,
        "trim_preamble": trim_preamble,
        "metadata_pairs": metadata_pairs,
        "plate_files": plate_files,
        "fill_nulls": fill_nulls,
        "fill_null_rows": fill_null_rows,
        "fill_if_null": fill_image_values,
        "bounding_box": bounding_box,
        "synthetic_plates": synthetic_plates,
        "ingest_roundtrip": ingest_roundtrip,
        "table_rewrite": table_rewrite,
        "ingest_rejects": ingest_rejects,
        "ingest_quoted": ingest_quoted,
        "reject_places": reject_places,
        "typed_columns": typed_columns,
        "index_two_files": index_two_files,
        "convert_plates": convert_plates,
        "convert_again": convert_again,
        "replace_broken_off": replace_broken_off,
        "convert_changed": convert_changed,
        "add_population": add_population,
        **(llm.queries() if llm else {}),
        **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {}),
    }
