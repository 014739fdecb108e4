"""The registered queries in plain SQL, for comparison.

``index``, ``objects``, ``files``, ``images`` and so on are the views of
``platewright.plans.screen`` and the operators on them, as common table
expressions.
"""

from __future__ import annotations


def _place(key: str) -> str:
    return f"""
    'P' || lpad(CAST({key} // 1536 AS VARCHAR), 6, '0') AS plate,
    ({key} // 16) % 96 // 12 + 1 AS "Row", ({key} // 16) % 12 + 1 AS "Column\""""


def _field(key: str) -> str:
    return f"({key} // 4) % 4 + 1"


LETTERS = "'ABCDEFGHIJKL'"
WELLS = f"""
    substr({LETTERS}, CAST("Row" AS INT), 1) || lpad(CAST("Column" AS VARCHAR), 2, '0') AS "Well",
    lpad(CAST("Row" AS VARCHAR), 2, '0') AS "WellRow",
    lpad(CAST("Column" AS VARCHAR), 2, '0') AS "WellColumn\""""

INDEX = f"""idx AS (
  SELECT date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) * 10000000000 + o_orderkey AS seq,
    {_place('o_orderkey')}, CAST(1 AS BIGINT) AS "Plane", CAST(1 AS BIGINT) AS "Timepoint",
    CAST(1 AS BIGINT) AS "Sequence",
    CASE WHEN o_orderpriority <> '5-LOW' THEN {_field('o_orderkey')} END AS "Field",
    o_orderkey % 4 + 1 AS "ChannelID",
    CASE o_orderkey % 4 WHEN 0 THEN 'HOECHST 33342' WHEN 1 THEN 'Alexa 647'
      WHEN 2 THEN 'Alexa 488narrow' ELSE 'Brightfield' END AS "ChannelName",
    CASE WHEN o_orderkey % 4 = 3 THEN 'Brightfield' ELSE 'Fluorescence' END AS "ChannelType",
    CAST(CASE WHEN o_orderkey % 4 = 3 THEN 2160 ELSE 1080 END AS BIGINT) AS "ImageSizeX",
    CAST(CASE WHEN o_orderkey % 4 = 3 THEN 2160 ELSE 1080 END AS BIGINT) AS "ImageSizeY",
    CAST(({_field('o_orderkey')}) * 0.25 AS DOUBLE) AS "PositionXm",
    CAST(({_field('o_orderkey')}) * -0.5 AS DOUBLE) AS "PositionYm"
  FROM orders)"""

OBJECTS = f"""obj AS (
  SELECT {_place('l_orderkey')}, {_field('l_orderkey')} AS "Field",
    CASE l_returnflag WHEN 'A' THEN 'Hoechst' WHEN 'N' THEN 'O4Final' WHEN 'R' THEN 'PDGFSelected' END AS population,
    CAST(l_linenumber AS BIGINT) AS "ObjectNo", l_quantity AS "X", l_discount AS "Y",
    '[' || l_linenumber || ',' || (l_suppkey % 50) || ',' || CAST(l_quantity AS BIGINT) || ',' || (l_partkey % 100) || ']' AS "BoundingBox",
    l_extendedprice AS "Area", CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS "Intensity"
  FROM lineitem), wobj AS (SELECT *, {WELLS} FROM obj)"""

IMAGES = f"""images AS (
  SELECT plate, "Row", "Column", "Field", index_rows,
    CAST(row_number() OVER (PARTITION BY plate ORDER BY first_seq) AS BIGINT) AS "ImageNumber", {WELLS}
  FROM (SELECT plate, "Row", "Column", "Field", min(seq) AS first_seq, count(*) AS index_rows
        FROM idx WHERE "Field" IS NOT NULL GROUP BY ALL) t)"""

NAME_PATTERN = "'^.*['||chr(92)||chr(92)||'/]r([0-9]+)c([0-9]+)f([0-9]+)p([0-9]+)-ch([0-9]+)sk([0-9]+).*[.]tiff$'"
BASE_NAME = "regexp_extract(path, '([^/'||chr(92)||chr(92)||']+)$', 1)"
FOLDER = "regexp_extract(path, '^(.*)['||chr(92)||chr(92)||'/][^'||chr(92)||chr(92)||'/]+$', 1)"

FILES = f"""shots AS (
  SELECT o_orderkey, {_place('o_orderkey')}, {_field('o_orderkey')} AS fld, o_orderstatus,
    unnest(CASE WHEN o_orderstatus = 'F' THEN [1, 2] ELSE [1] END) AS shot
  FROM orders),
files AS (
  SELECT plate, o_orderkey AS seq,
    'C:' || chr(92) || 'img' || chr(92) || plate || chr(92) || 'r' || lpad(CAST("Row" AS VARCHAR), 2, '0')
    || 'c' || lpad(CAST("Column" AS VARCHAR), 2, '0') || 'f' || lpad(CAST(fld AS VARCHAR), 2, '0')
    || 'p' || lpad(CAST(shot AS VARCHAR), 2, '0') || '-ch' || (o_orderkey % 4 + 1)
    || CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'sk1fk1fl1' END || '.tiff' AS path
  FROM shots),
parsed AS (
  SELECT plate, seq, path,
    {', '.join(f'CAST(regexp_extract(path, {NAME_PATTERN}, {i}) AS BIGINT) AS "{c}"'
               for i, c in enumerate(['Row', 'Column', 'Field', 'Position', 'ChannelID', 'Cycle'], 1))},
    {BASE_NAME} AS file_name, {FOLDER} AS folder
  FROM files WHERE regexp_matches(path, {NAME_PATTERN})),
latest AS (
  SELECT plate, "Row", "Column", "Field", "ChannelID", arg_max(path, "Position" * 1000 + "Cycle") AS url
  FROM parsed GROUP BY ALL),
withpath AS (
  SELECT idx.*, url AS path, CASE WHEN url IS NOT NULL THEN {FOLDER.replace('path', 'url')} END AS dir
  FROM idx LEFT JOIN latest USING (plate, "Row", "Column", "Field", "ChannelID"))"""

# A file per cycle that an order's image has.
FILES_BY_CYCLE = FILES.replace(
    "parsed AS (", """cycles AS (
  SELECT * REPLACE (replace(path, 'sk1fk', 'sk' || unnest(CASE seq % 3 WHEN 0 THEN [1, 3] WHEN 1 THEN [2] ELSE [1, 2, 5] END) || 'fk') AS path)
  FROM files),
parsed AS (""").replace("FROM files WHERE regexp_matches", "FROM cycles WHERE regexp_matches")

LINKS = {"Hoechst": "HOECHST 33342", "O4Final": "Alexa 488narrow", "PDGFSelected": "Alexa 647"}

PATH_COLUMNS = ", ".join(
    f"""max(CASE WHEN "ChannelName" = '{c}' THEN dir END) AS "Image_Path_{p}",
    max(CASE WHEN "ChannelName" = '{c}' THEN path END) AS "Image__URL_{p}\""""
    for p, c in LINKS.items()
)
NAME_COLUMNS = ", ".join(
    f"""regexp_extract("Image__URL_{p}", '([^/'||chr(92)||chr(92)||']+)$', 1) AS "Image_FileName_{p}\""""
    for p in LINKS
)
ATTRIBUTES = ["Sequence", "ChannelType", "ImageSizeX", "ImageSizeY", "PositionXm", "PositionYm"]
FLAT = f"""grouped AS (
  SELECT plate, "Row", "Column", "Field", "Plane", "Timepoint",
    {', '.join(f'max("{a}") AS "{a}"' for a in ATTRIBUTES)}, {PATH_COLUMNS}
  FROM withpath WHERE "Field" IS NOT NULL GROUP BY ALL),
flat AS (
  SELECT grouped.*, {NAME_COLUMNS}, "ImageNumber", "Well", "WellRow", "WellColumn"
  FROM grouped JOIN images USING (plate, "Row", "Column", "Field"))"""


def _mean(column: str) -> str:
    return f'CAST(sum(CAST("{column}" AS DECIMAL(18,4))) AS DOUBLE) / nullif(count("{column}"), 0)'


def _profile(population: str) -> str:
    return f"""p_{population} AS (
  SELECT plate, "Well", "Field", count(*) AS "Image_Count_{population}",
    {_mean('Area')} AS "Per_Field_{population}Aream",
    {_mean('Intensity')} AS "Per_Field_{population}IntensityMean"
  FROM wobj WHERE population = '{population}' GROUP BY ALL)"""


PROFILES = ", ".join(_profile(p) for p in LINKS)
ALL_JOINS = " ".join(f'LEFT JOIN p_{p} USING (plate, "Well", "Field")' for p in LINKS)
IMAGE_TABLE = f"WITH {INDEX}, {IMAGES}, {FILES}, {FLAT}, {OBJECTS}, {PROFILES} SELECT * FROM flat {ALL_JOINS}"


def _replaced(value: str, pairs: list[tuple[str, str]]) -> str:
    for old, new in pairs:
        value = f"replace({value}, '{old}', '{new}')"
    return value


def _renamed() -> str:
    """The objects of each population, with the columns of the others as NULL."""

    def column(owner: str, population: str, value: str, name: str) -> str:
        return f'{value if owner == population else "NULL"} AS "{name}"'

    def select(population: str) -> str:
        columns = [
            column(p, population, value, name)
            for p in LINKS
            for value, name in (
                ('"Area"', f"Per_Field_{p}Aream"), ('"Intensity"', f"Per_Field_{p}IntensityMean"),
                ('"ObjectNo"', f"{p}_Number_Object_Number"), ('"X"', f"{p}_Location_Center_X"),
                ('"Y"', f"{p}_Location_Center_Y"),
            )
        ]
        return f"""SELECT plate, "Row", "Column", "Field", CAST(NULL AS BIGINT) AS "ImageNumber", {', '.join(columns)}
          FROM obj WHERE population = '{population}'"""

    return " UNION ALL ".join(map(select, LINKS))


def _grid(rows: int) -> str:
    letters = "CASE WHEN r > 26 THEN 'A' || chr(CAST(64 + r - 26 AS INT)) ELSE chr(CAST(64 + r AS INT)) END"
    return f"""SELECT c_custkey, r AS "Row", c AS "Column",
      CASE WHEN r BETWEEN 1 AND {rows} THEN {letters} || lpad(CAST(c AS VARCHAR), 2, '0') END AS "Well",
      lpad(CAST(r AS VARCHAR), 2, '0') AS "WellRow", lpad(CAST(c AS VARCHAR), 2, '0') AS "WellColumn"
    FROM (SELECT c_custkey, c_custkey % 34 AS r, c_custkey % 48 + 1 AS c FROM customer) t"""


def _manifest() -> str:
    """All settings of all populations, one SELECT per setting."""
    listed = [
        ("image_path_cols", "string_agg('Image_Path_' || population, ',' ORDER BY population)"),
        ("image_file_cols", "string_agg('Image__URL_' || population, ',' ORDER BY population)"),
        ("image_names", "string_agg(population, ',' ORDER BY population)"),
        ("image_channel_colors", "string_agg(color, ',' ORDER BY population)"),
        ("channels_per_image", "string_agg('1', ',' ORDER BY population)"),
    ]
    blank = "''"
    settings = [
        ("Database Info", [("db_type", "'parquet'"), ("db_sqlite_file", "'screen'")]),
        ("Database Tables", [("image_table", "'ImageTable'"), ("object_table", "population")]),
        ("Database Columns", [
            ("image_id", "'ImageNumber'"), ("object_id", "population || '_Number_Object_Number'"),
            ("plate_id", "'Plane'"), ("well_id", "'Well'"), ("series_id", "'Sequence'"),
            ("group_id", "'Group_id'"), ("timepoint_id", "'Timepoint'"),
            ("cell_x_loc", "population || '_Location_Center_X'"),
            ("cell_y_loc", "population || '_Location_Center_Y'"), ("cell_z_loc", blank)]),
        ("Image Path and File Name Columns", [
            ("image_path_cols", "image_path_cols"), ("image_file_cols", "image_file_cols"),
            ("image_thumbnail_cols", blank), ("image_names", "image_names"),
            ("image_channel_colors", "image_channel_colors"),
            ("channels_per_image", "channels_per_image"), ("image_channel_blend_modes", blank)]),
        ("Dynamic Groups", [(k, blank) for k in (
            "groups", "group_sql_well", "group_sql_gene", "group_sql_well+gene")]),
        ("Image Filters", [(k, blank) for k in ("filters", "filter_sql_empty", "filter_sql_cdks")]),
        ("Meta data", [("object_name", "'cell,cells'"), ("plate_type", "'96'")]),
        ("Excluded Columns", [("classifier_ignore_columns",
            "'table_number_key_column, image_number_key_column, object_number_key_column'")]),
        ("Other", [
            ("image_width", "CAST(w AS VARCHAR)"), ("image_height", "CAST(h AS VARCHAR)"),
            ("image_tile_size", "'100'"), ("classification_type", blank), ("training_set", blank),
            ("area_scoring_column", blank), ("class_table", blank), ("check_tables", "'no'"),
            ("force_bioformats", "'no'"), ("use_legacy_fetcher", "'no'"), ("process_3D", "'False'")]),
    ]
    rows = [(s, k, v) for s, pairs in settings for k, v in pairs]
    selects = " UNION ALL ".join(
        f"SELECT plate, population, {i} AS position, '{s}' AS section, '{k}' AS key, {v} AS value FROM wide"
        for i, (s, k, v) in enumerate(rows, 1)
    )
    lists = ", ".join(f"{e} AS {n}" for n, e in listed)
    return f"""WITH {INDEX}, {OBJECTS}, {LINKED},
    colored AS (SELECT *, CASE row_number() OVER (PARTITION BY plate ORDER BY population)
                  WHEN 1 THEN 'blue' WHEN 2 THEN 'red' WHEN 3 THEN 'green' END AS color FROM linked),
    lists AS (SELECT plate, {lists} FROM colored GROUP BY plate),
    wide AS (SELECT linked.*, w, h, lists.* EXCLUDE (plate) FROM linked JOIN lists USING (plate)
             LEFT JOIN (SELECT plate, "ChannelName", max("ImageSizeX") AS w, max("ImageSizeY") AS h FROM idx GROUP BY ALL) s
             USING (plate, "ChannelName"))
    {selects}"""


LINKED = """linked AS (
  SELECT DISTINCT plate, population, CASE population WHEN 'Hoechst' THEN 'HOECHST 33342'
    WHEN 'O4Final' THEN 'Alexa 488narrow' WHEN 'PDGFSelected' THEN 'Alexa 647' END AS "ChannelName"
  FROM obj)"""


def _stream(seed: str, stream: int) -> str:
    u = f"((({seed}) % 1000003) * 7919 + {stream} * 104729 + 12345) % 1000003"
    for add in (54321, 67891):
        u = f"(({u}) * ({u}) + ({u}) * 3 + {add} + {stream}) % 1000003"
    return f"({u}) / 1000003.0::DOUBLE"


def _synthetic() -> str:
    seed = 'img * 1009 + "ObjectNo" * 31'

    def whole(stream, low, high):
        return f"CAST(floor({_stream(seed, stream)} * {high - low + 1}) + {low} AS BIGINT)"

    def real(stream, low, high, decimals):
        scale = 10 ** decimals
        return (f"floor(({_stream(seed, stream)} * CAST({high - low} AS DOUBLE) + {low}) * CAST({scale} AS DOUBLE))"
                f" / CAST({scale} AS DOUBLE)")

    return f"""WITH img AS (SELECT l_orderkey // 4 AS img, count(*) AS n FROM lineitem GROUP BY 1),
    o AS (SELECT {_place('(img * 4)')}, {_field('(img * 4)')} AS "Field", img,
            unnest(range(1, n + 1)) AS "ObjectNo" FROM img)
    SELECT plate, "Row", "Column", CAST(1 AS BIGINT) AS "Plane", CAST(1 AS BIGINT) AS "Timepoint", "Field", "ObjectNo",
      CAST({whole(1, 10, 800)} AS DOUBLE) AS "X", CAST({whole(2, 11, 800)} AS DOUBLE) AS "Y",
      '[' || {whole(3, 1, 800)} || ',' || {whole(4, 1, 800)} || ',' || {whole(5, 1, 800)} || ',' || {whole(6, 100, 800)} || ']' AS "BoundingBox",
      {real(7, -500, 500, 2)} AS "PositionXm", {real(8, -500, 500, 2)} AS "PositionYm",
      {real(9, 50, 200, 3)} AS "HoechstAream", {real(10, 1000, 5000, 2)} AS "HoechstIntensityAlexa647Mean",
      CAST({whole(11, 100000, 1000000)} AS DOUBLE) AS "HoechstIntensityAlexa647Sum",
      CAST("ObjectNo" AS DOUBLE) AS "HoechstObjectNoinCh"
    FROM o"""


PREAMBLES = """lines AS (
  SELECT c_name AS file, unnest(range(0, 8)) AS line_no,
    unnest(['Database Name' || chr(9) || 'screen', 'Plate Name' || chr(9) || c_mktsegment,
      '  Evaluation ' || chr(9) || ' ' || c_name || '  ', 'a' || chr(9) || 'b' || chr(9) || 'c', '',
      'Balance' || chr(9) || c_nationkey, 'Evaluation' || chr(9) || c_custkey,
      'Population' || chr(9) || 'late']) AS value
  FROM customer),
pairs AS (
  SELECT file, key, arg_max(v, line_no) AS value
  FROM (SELECT file, line_no, trim(split_part(value, chr(9), 1)) AS key, trim(split_part(value, chr(9), 2)) AS v
        FROM lines WHERE line_no < 7 AND length(value) - length(replace(value, chr(9), '')) = 1) t
  GROUP BY ALL)"""

COUNTS = """counts AS (
  SELECT plate, population, "Well", "Field", count(*) AS "Image_Count" FROM wobj GROUP BY ALL)"""

CLEAN = "regexp_replace(p_name || ' - ' || p_type || ' - ' || p_brand || ' [µm²]', '[^a-zA-Z0-9_]', '', 'g')"
FROM_THE = "CASE WHEN instr(text, 'the') > 0 THEN substr(text, instr(text, 'the')) ELSE text END"
# Substitutions for index headings; those for results are all but the last two.
OLDER = [("-", "_"), ("Group", "Group_id"), (" ", ""), ("%", "percent"), ("/", "_"), ("[", ""), ("]", ""), ("²", ""), ("µ", "u")]
THIRD = "CAST(substr(plate, 2, 6) AS BIGINT) % 3 = 0"
GONE = ", ".join(
    f'CASE WHEN NOT ({THIRD}) THEN "{c}_PDGFSelected" END AS "{c}_PDGFSelected"'
    for c in ("Image_Path", "Image__URL", "Image_FileName")
)
FIRST_WORD = r"nullif(regexp_extract(text, '^\s*(\S+)', 1), '')"

POPULATION = "CASE l_returnflag WHEN 'A' THEN 'Hoechst' WHEN 'N' THEN 'O4Final' WHEN 'R' THEN 'PDGFSelected' END"

ORACLE: dict[str, str] = {
    "field_profile": f"""WITH {INDEX}, {IMAGES}, {OBJECTS}, {PROFILES}
        SELECT plate, "ImageNumber", "Well", "Field",
          {', '.join(f'"Image_Count_{p}", "Per_Field_{p}Aream", "Per_Field_{p}IntensityMean"' for p in LINKS)}
        FROM images {ALL_JOINS}""",
    "image_number": f"""WITH {INDEX}, {IMAGES}
        SELECT seq, plate, idx."Row", idx."Column", idx."Field", "ImageNumber"
        FROM idx LEFT JOIN images USING (plate, "Row", "Column", "Field")""",
    "well_label": f'WITH {INDEX} SELECT seq, "Row", "Column", {WELLS} FROM idx',
    "well_label_384": _grid(16),
    "well_label_1536": _grid(32),
    "attach_keys": f"""WITH {INDEX}, {IMAGES}, {OBJECTS}
        SELECT wobj.*, "ImageNumber" FROM wobj
        LEFT JOIN (SELECT plate, "Row", "Column", "Field", "ImageNumber" FROM images) i
        USING (plate, "Row", "Column", "Field")""",
    "object_index_fanout": f"""WITH {INDEX}, {OBJECTS},
        k AS (SELECT plate, "Row", "Column", "Field" FROM idx),
        once AS (SELECT obj.* FROM obj LEFT JOIN k USING (plate, "Row", "Column", "Field")),
        twice AS (SELECT once.* FROM once LEFT JOIN k USING (plate, "Row", "Column", "Field"))
        SELECT population, n_objects, n_joined
        FROM (SELECT population, count(*) AS n_objects FROM obj GROUP BY 1) a
        JOIN (SELECT population, count(*) AS n_joined FROM twice GROUP BY 1) b USING (population)""",
    "unmatched_objects": f"""WITH {INDEX}, {IMAGES}, {OBJECTS}
        SELECT population, count(*) AS n_unmatched
        FROM obj ANTI JOIN images USING (plate, "Row", "Column", "Field") GROUP BY 1""",
    "rename_measures": f"WITH {OBJECTS} {_renamed()}",
    "count_per_image": f"WITH {OBJECTS}, {COUNTS} SELECT * FROM counts",
    "mean_per_image": f"""WITH {OBJECTS}
        SELECT plate, population, "Well", "Field", {_mean('Area')} AS "Per_Field_Area",
          {_mean('Intensity')} AS "Per_Field_Intensity" FROM wobj GROUP BY ALL""",
    "well_median_std": f"""WITH {OBJECTS}
        SELECT plate, population, "Well", round(stddev_samp("Area"), 4) AS "Std_Area",
          round(stddev_samp("Intensity"), 4) AS "Std_Intensity",
          quantile_cont("Area", 0.5) AS "Median_Area", quantile_cont("Intensity", 0.5) AS "Median_Intensity"
        FROM wobj GROUP BY ALL""",
    "image_table": IMAGE_TABLE,
    "image_table_zero": f"""WITH {INDEX}, {IMAGES}, {OBJECTS}, {PROFILES}
        SELECT plate, "ImageNumber", "Well", "Field",
          {', '.join(f'coalesce("Image_Count_{p}", 0) AS "Image_Count_{p}"' for p in LINKS)}
        FROM images {ALL_JOINS}""",
    "channel_names": f'WITH {INDEX} SELECT DISTINCT "ChannelName" FROM idx',
    "distinct_channels": f'WITH {INDEX} SELECT DISTINCT plate, "ChannelName", "ChannelID" FROM idx',
    "image_sizes": f'WITH {INDEX} SELECT DISTINCT plate, "ImageSizeX", "ImageSizeY", "ChannelName" FROM idx',
    "population_sizes": f"""WITH {INDEX}, {OBJECTS}, {LINKED}
        SELECT linked.*, w AS image_width, h AS image_height FROM linked
        LEFT JOIN (SELECT plate, "ChannelName", max("ImageSizeX") AS w, max("ImageSizeY") AS h FROM idx GROUP BY ALL) s
        USING (plate, "ChannelName")""",
    "manifest_long": _manifest(),
    "parse_image_path": f"WITH {INDEX}, {FILES} SELECT * FROM parsed",
    "attach_paths": f"""WITH {INDEX}, {FILES}
        SELECT seq, "ChannelID", dir AS "Image_Path", path AS "Image__URL" FROM withpath""",
    "image_flatten": f"WITH {INDEX}, {IMAGES}, {FILES}, {FLAT} SELECT * FROM flat",
    "image_flatten_15key": f"""WITH {INDEX}, {IMAGES}, {FILES}
        SELECT plate, "ImageNumber", "Row", "Column", "Plane", "Timepoint", "Sequence", "Field", "ChannelType",
          "ImageSizeX", "ImageSizeY", "PositionXm", "PositionYm", "Well", "WellRow", "WellColumn", {PATH_COLUMNS}
        FROM withpath JOIN images USING (plate, "Row", "Column", "Field") GROUP BY ALL""",
    "first_per_key": f"""WITH {INDEX}
        SELECT plate, "Row", "Column", "Field", arg_min("ChannelName", seq) AS "ChannelName"
        FROM idx WHERE "ChannelName" IN ('HOECHST 33342', 'Alexa 488narrow', 'Alexa 647') AND "Field" IS NOT NULL
        GROUP BY ALL""",
    "plate_count": f"""WITH {INDEX}, {FILES}
        SELECT folder, n_images, CAST(row_number() OVER (ORDER BY f) AS BIGINT) AS "FolderNumber"
        FROM (SELECT {FOLDER} AS folder, count(*) AS n_images, min(seq) AS f FROM files GROUP BY 1) t""",
    "plate_total": f"WITH {INDEX}, {FILES} SELECT count(DISTINCT {FOLDER}) AS plate_count FROM files",
    "clean_names": f"""SELECT p_partkey, {CLEAN} AS clean,
        replace(replace(p_name, '-', ''), ' ', '') AS table_name,
        substr('Per_Field_' || {CLEAN} || {CLEAN}, 1, 64) AS prefixed FROM part""",
    "legacy_names": f"""SELECT p_partkey, {_replaced('h', OLDER[:7])} AS results, {_replaced('h', OLDER)} AS "index",
        {_replaced('h', [(' ', '_'), ('-', '_'), ('%', ''), ('[', ''), (']', ''), ('Group', 'Group_id'), ('µm²', 'um'), ('µm', 'um'), ('s', '_s')])} AS harmony
        FROM (SELECT p_partkey, p_type || ' - Group%/[' || p_name || ' µm²] µm' AS h FROM part) t""",
    "trim_preamble": f"""SELECT doc_id, md5({FROM_THE}) AS trimmed_md5, length({FROM_THE}) AS trimmed_length,
        {FIRST_WORD} AS first_word, coalesce({FIRST_WORD} = 'the', false) AS starts_the FROM documents""",
    "metadata_pairs": f"WITH {PREAMBLES} SELECT * FROM pairs",
    "plate_files": f"""WITH {PREAMBLES}
        SELECT value AS plate_name, count(*) AS n_files FROM pairs WHERE key = 'Plate Name' GROUP BY 1""",
    "fill_nulls": f"""WITH {INDEX}, {OBJECTS}
        SELECT plate, n_filled, n, n_fields_filled
        FROM (SELECT plate, count(*) FILTER ("Intensity" IS NULL) AS n_filled, count(*) AS n FROM obj GROUP BY 1) a
        LEFT JOIN (SELECT plate, count(*) FILTER ("Field" IS NULL) AS n_fields_filled FROM idx GROUP BY 1) b USING (plate)""",
    "fill_null_rows": f"""WITH {INDEX} SELECT seq, coalesce("Field", 0) AS "Field",
        CASE WHEN "Field" IS NULL THEN 0.0 ELSE "PositionXm" END AS "PositionXm" FROM idx""",
    "fill_if_null": f"""WITH {INDEX}, {IMAGES}, {OBJECTS}, {COUNTS}
        SELECT images.plate, "ImageNumber", images."Well", images."Field", coalesce(a."Image_Count", b."Image_Count", c."Image_Count") AS n_objects
        FROM images
        LEFT JOIN counts a ON a.population = 'Hoechst' AND a.plate = images.plate AND a."Well" = images."Well" AND a."Field" = images."Field"
        LEFT JOIN counts b ON b.population = 'O4Final' AND b.plate = images.plate AND b."Well" = images."Well" AND b."Field" = images."Field"
        LEFT JOIN counts c ON c.population = 'PDGFSelected' AND c.plate = images.plate AND c."Well" = images."Well" AND c."Field" = images."Field\"""",
    "bounding_box": f"""WITH {OBJECTS},
        boxes AS (SELECT plate, "ObjectNo", "BoundingBox", CAST("BoundingBox" AS DOUBLE[]) AS b FROM obj),
        good AS (SELECT *, b[3] >= b[1] AND b[4] >= b[2] AS ok FROM boxes)
        SELECT plate, "ObjectNo", "BoundingBox",
          {', '.join(f'CASE WHEN ok THEN b[{i}] END AS "BoundingBox_{n}"' for i, n in enumerate(['x1', 'y1', 'x2', 'y2'], 1))},
          CASE WHEN ok THEN b[3] - b[1] END AS "BoundingBox_width", CASE WHEN ok THEN b[4] - b[2] END AS "BoundingBox_height",
          CASE WHEN ok THEN (b[3] - b[1]) * (b[4] - b[2]) END AS "BoundingBox_area" FROM good""",
    "synthetic_plates": _synthetic(),
    "ingest_roundtrip": f"WITH {OBJECTS} SELECT * FROM obj",
    "table_rewrite": f"""WITH {OBJECTS}, {COUNTS},
        again AS (SELECT DISTINCT plate FROM (SELECT {_place('l_orderkey')} FROM lineitem
                  WHERE l_discount >= 0.1 AND l_quantity >= 50) t)
        SELECT counts.*, CASE WHEN again.plate IS NULL THEN 1 ELSE 2 END AS run
        FROM counts LEFT JOIN again USING (plate)""",
    "convert_plates": IMAGE_TABLE,
    "convert_again": f"""WITH {INDEX}, {IMAGES}, {FILES}, {FLAT}, {OBJECTS.replace('wobj AS', 'all_objects AS')},
        wobj AS (SELECT * REPLACE (CASE WHEN {THIRD} THEN "Area" + 1 ELSE "Area" END AS "Area") FROM all_objects
                 WHERE NOT ({THIRD} AND population = 'PDGFSelected')),
        {PROFILES} SELECT * REPLACE ({GONE}) FROM flat {ALL_JOINS}""",
    "replace_broken_off": IMAGE_TABLE,
    "convert_changed": f"""WITH {INDEX}, {IMAGES}, {FILES}, {FLAT}, {OBJECTS.replace('wobj AS', 'all_objects AS')},
        wobj AS (SELECT * REPLACE (CASE WHEN {THIRD} AND population = 'Hoechst' THEN "Area" + 1 ELSE "Area" END AS "Area")
                 FROM all_objects), {PROFILES} SELECT * FROM flat {ALL_JOINS}""",
    "image_table_planes": f"""WITH {INDEX}, {IMAGES}, {FILES},
        file_of AS (SELECT plate, "Row", "Column", "Field", "ChannelID", "Position" AS "Plane", arg_max(path, "Cycle") AS url
                    FROM parsed GROUP BY ALL),
        planes AS (SELECT * REPLACE (unnest([CAST(1 AS BIGINT), CAST(2 AS BIGINT)]) AS "Plane") FROM idx),
        own_path AS (SELECT planes.*, url AS path, CASE WHEN url IS NOT NULL THEN {FOLDER.replace('path', 'url')} END AS dir
                     FROM planes LEFT JOIN file_of USING (plate, "Row", "Column", "Field", "ChannelID", "Plane")),
        {FLAT.replace('FROM withpath', 'FROM own_path')}, {OBJECTS}, {PROFILES} SELECT * FROM flat {ALL_JOINS}""",
    "image_table_times": f"""WITH {INDEX}, {IMAGES}, {FILES_BY_CYCLE},
        file_of AS (SELECT plate, "Row", "Column", "Field", "ChannelID", "Cycle", arg_max(path, "Position") AS url
                    FROM parsed GROUP BY ALL),
        points AS (SELECT * REPLACE (unnest([CAST(1 AS BIGINT), CAST(2 AS BIGINT), CAST(3 AS BIGINT)]) AS "Timepoint") FROM idx),
        own_path AS (SELECT points.*, url AS path, CASE WHEN url IS NOT NULL THEN {FOLDER.replace('path', 'url')} END AS dir
                     FROM points ASOF LEFT JOIN file_of ON points.plate = file_of.plate AND points."Row" = file_of."Row"
                       AND points."Column" = file_of."Column" AND points."Field" = file_of."Field"
                       AND points."ChannelID" = file_of."ChannelID" AND points."Timepoint" >= file_of."Cycle"),
        {FLAT.replace('FROM withpath', 'FROM own_path')}, {OBJECTS}, {PROFILES} SELECT * FROM flat {ALL_JOINS}""",
    "image_number_append": f"""WITH {INDEX},
        seen AS (SELECT plate, "Row", "Column", "Field", min(seq) AS f, min(seq) FILTER (seq % 2 = 1) AS f1
                 FROM idx WHERE "Field" IS NOT NULL GROUP BY ALL)
        SELECT plate, "Row", "Column", "Field", CAST(CASE WHEN f1 IS NOT NULL THEN row_number() OVER (PARTITION BY plate ORDER BY f1 NULLS LAST)
          ELSE count(f1) OVER (PARTITION BY plate) + row_number() OVER (PARTITION BY plate, f1 IS NULL ORDER BY f) END AS BIGINT) AS "ImageNumber"
        FROM seen""",
    "profile_delta": f"""WITH {OBJECTS}, kept AS (
          SELECT * REPLACE (CASE WHEN "ObjectNo" % 5 = 1 THEN "Area" + 1 ELSE "Area" END AS "Area") FROM obj WHERE "ObjectNo" % 5 <> 0
          UNION ALL SELECT * FROM obj WHERE "ObjectNo" % 5 = 2)
        SELECT plate, population, "Row", "Column", "Field", count(*) AS n_objects, {_mean('Area')} AS "Per_Field_Area",
          {_mean('Intensity')} AS "Per_Field_Intensity" FROM kept GROUP BY ALL""",
    "manifest_text": f"""SELECT plate, population,
          CASE WHEN key IN ('series_id', 'group_id', 'timepoint_id', 'process_3D') OR key = 'cell_z_loc' AND value = ''
            THEN '# ' ELSE '' END || key || ' = ' || value AS line
        FROM ({_manifest()}) t WHERE section NOT IN ('Dynamic Groups', 'Image Filters')""",
    "list_images": """SELECT c_mktsegment AS plate, c_custkey // 16 % 8 + 1 AS "Row", c_custkey // 128 % 12 + 1 AS "Column",
          c_custkey // 1536 + 1 AS "Field", c_custkey % 16 + 1 AS "ChannelID", CAST(0 AS BIGINT) AS length,
          'r' || lpad(CAST(c_custkey // 16 % 8 + 1 AS VARCHAR), 2, '0') || 'c' || lpad(CAST(c_custkey // 128 % 12 + 1 AS VARCHAR), 2, '0')
          || 'f' || lpad(CAST(c_custkey // 1536 + 1 AS VARCHAR), 2, '0') || 'p01-ch' || (c_custkey % 16 + 1) || 'sk1.tiff' AS file
        FROM customer""",
    "ingest_rejects": f"""WITH t AS (SELECT {_place('l_orderkey')}, (l_orderkey + l_partkey) % 20 AS kind,
          CASE l_returnflag WHEN 'A' THEN 'Hoechst' WHEN 'N' THEN 'O4Final' WHEN 'R' THEN 'PDGFSelected' END AS population
          FROM lineitem)
        SELECT plate, population, count(*) FILTER (kind NOT IN (0, 1, 3)) AS rows, count(*) FILTER (kind = 2) AS short_rows,
          count(*) FILTER (kind IN (0, 1, 3)) AS bad_rows, nullif(count(*) FILTER (kind IN (0, 1, 3)), 0) AS n_rejected,
          CASE WHEN count(*) FILTER (kind IN (0, 1, 3)) > 0 THEN count(*) FILTER (kind = 0) END AS n_short
        FROM t GROUP BY plate, population""",
    "ingest_quoted": f"""SELECT {_place('l_orderkey')}, {_field('l_orderkey')} AS "Field", {POPULATION} AS population,
          CAST(l_linenumber AS BIGINT) AS "ObjectNo",
          CASE l_partkey % 10 WHEN 0 THEN 'two' || chr(10) || 'lines' WHEN 1 THEN 'a' || chr(9) || 'b' WHEN 2 THEN 'say "hi"'
            WHEN 3 THEN '"' WHEN 4 THEN 'x' || chr(13) || chr(10) || '"' || chr(10) || chr(9) || chr(10) || '"y'
            WHEN 5 THEN chr(10) WHEN 6 THEN '""' || chr(10) || '""' WHEN 7 THEN '5" x'
            ELSE 'plain ' || CAST(l_quantity AS VARCHAR) END AS "Note"
        FROM lineitem""",
    "reject_places": f"""WITH t AS (SELECT DISTINCT {_place('l_orderkey')}, (l_orderkey * 8 + l_linenumber) * 1000 + l_partkey % 1000 AS rank
          FROM lineitem),
        n AS (SELECT plate, rank, row_number() OVER (PARTITION BY plate ORDER BY rank) + 5 AS line_no
              FROM (SELECT DISTINCT plate, rank FROM t) d)
        SELECT plate, line_no, CASE rank % 17 WHEN 0 THEN 'Database Name' || chr(9) || 'screen' WHEN 1 THEN '[Data]' ELSE 'x' || rank END AS line
        FROM n WHERE rank % 17 IN (0, 1, 3)""",
    "typed_columns": f"""SELECT {_place('l_orderkey')}, {_field('l_orderkey')} AS "Field", {POPULATION} AS population,
          CAST(l_linenumber AS BIGINT) AS "ObjectNo", CAST(l_partkey AS DOUBLE) AS "Size", l_extendedprice AS "Area",
          l_linestatus || l_linenumber || 'D' AS "Class", CASE WHEN l_partkey % 10 <> 0 THEN l_quantity END AS "Mostlynumber",
          CASE WHEN l_partkey % 10 = 0 THEN CAST(l_quantity AS VARCHAR) ELSE '1F' END AS "Mostlytext", l_suppkey AS "Code",
          CASE WHEN l_suppkey % 2 = 0 THEN 1.0 ELSE l_discount END AS "Share",
          CASE WHEN l_partkey % 50 = 0 THEN 'x' ELSE CAST(l_partkey AS VARCHAR) END AS "Note", CAST(NULL AS VARCHAR) AS "Nothing"
        FROM lineitem""",
    "index_two_files": f"""WITH {INDEX}
        SELECT plate, "Row", "Column", "Field", n AS index_rows,
          CAST(row_number() OVER (PARTITION BY plate ORDER BY f) AS BIGINT) AS "ImageNumber"
        FROM (SELECT plate, "Row", "Column", "Field", count(*) AS n, min((1 - seq % 2, seq)) AS f
              FROM idx WHERE "Field" IS NOT NULL GROUP BY plate, "Row", "Column", "Field") t""",
}
ORACLE["add_population"] = ORACLE["field_profile"]
