"""Plate-shaped views of a star schema of orders and their lines.

Orders stand for the index, one row per image and channel: four orders in a
row are the four channels of an image, four images the fields of a well, 96
wells a plate. Lines are the objects of the image their order belongs to. All
rows of both tables are used, so plates grow in number with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHANNELS = ["HOECHST 33342", "Alexa 647", "Alexa 488narrow", "Brightfield"]
POPULATIONS = {"A": "Hoechst", "N": "O4Final", "R": "PDGFSelected"}
LINKS = {"Hoechst": "HOECHST 33342", "O4Final": "Alexa 488narrow", "PDGFSelected": "Alexa 647"}
DECIMALS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def position(order_key: str) -> list[str]:
    """Plate, well and field of the image that an order key falls in, in SQL."""
    return [
        f"concat('P', lpad(cast({order_key} div 1536 as string), 6, '0')) AS plate",
        f"({order_key} div 16) % 96 div 12 + 1 AS `Row`",
        f"({order_key} div 16) % 12 + 1 AS `Column`",
        f"({order_key} div 4) % 4 + 1 AS Field",
    ]


def choice(value: str, options: list[str] | dict[str, str]) -> str:
    """SQL for the option by number (from 0) or by key."""
    items = options.items() if isinstance(options, dict) else enumerate(options)
    cases = " ".join(f"WHEN {key!r} THEN '{option}'" for key, option in items)
    return f"CASE {value} {cases} END"


def index_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows; seen in order of date, with no Field for low priorities."""
    channel = "o_orderkey % 4"
    size = f"cast(if({channel} = 3, 2160, 1080) as bigint)"
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("*", *position("o_orderkey"))
        .selectExpr(
            "cast(datediff(o_orderdate, date'1992-01-01') as bigint) * 10000000000 + o_orderkey AS seq",
            "plate", "`Row`", "`Column`", "1L AS Plane", "1L AS Timepoint", "1L AS Sequence",
            "if(o_orderpriority <> '5-LOW', Field, null) AS Field",
            f"{channel} + 1 AS ChannelID", f"{choice(channel, CHANNELS)} AS ChannelName",
            f"if({channel} = 3, 'Brightfield', 'Fluorescence') AS ChannelType",
            f"{size} AS ImageSizeX", f"{size} AS ImageSizeY",
            "Field * 0.25D AS PositionXm", "Field * -0.5D AS PositionYm",
        )
    )


def files_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image files: two for finished orders, a name that is no image for pending ones."""

    def two(number: str) -> str:
        return f"lpad(cast({number} as string), 2, '0')"

    name = (
        f"concat('r', {two('`Row`')}, 'c', {two('`Column`')}, 'f', {two('Field')}, 'p', {two('shot')},"
        " '-ch', o_orderkey % 4 + 1, if(o_orderstatus = 'P', '', 'sk1fk1fl1'), '.tiff')"
    )
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("*", "explode(sequence(1, if(o_orderstatus = 'F', 2, 1))) AS shot")
        .selectExpr("*", *position("o_orderkey"))
        .selectExpr("plate", "o_orderkey AS seq", f"concat_ws(chr(92), 'C:', 'img', plate, {name}) AS path")
    )


def objects_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of all populations, with two measures."""
    box = "concat('[', l_linenumber, ',', l_suppkey % 50, ',', cast(l_quantity as bigint), ',', l_partkey % 100, ']')"
    return table(spark, sf_dir, "lineitem").selectExpr(
        *position("l_orderkey"),
        f"{choice('l_returnflag', POPULATIONS)} AS population",
        "cast(l_linenumber as bigint) AS ObjectNo", "l_quantity AS X", "l_discount AS Y",
        f"{box} AS BoundingBox", "l_extendedprice AS Area", "nullif(l_tax, 0.0D) AS Intensity",
    )


def measure_names(population: str) -> list[str]:
    return [f"{population}Aream", f"{population}IntensityMean"]


def population_view(spark: SparkSession, sf_dir: str, population: str) -> DataFrame:
    """One population's objects, its measures under its own name."""
    area, intensity = measure_names(population)
    rows = objects_view(spark, sf_dir).filter(F.col("population") == population)
    return rows.drop("population").withColumnsRenamed({"Area": area, "Intensity": intensity})
