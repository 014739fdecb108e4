"""Tables cut by image key in the same way, which join without a shuffle.

The image keys and each population's counts and means are such tables. The per-image table is a
join of them bucket by bucket, so a population is added by writing its own table and no
other's objects are read. Buckets are files, and a table is known to a session by
its place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..schema import IMAGE_KEYS

BUCKETS = 64


def _name(path: str) -> str:
    return "bucketed_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def _quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_bucketed(rows: DataFrame, path: str, keys: Sequence[str] = IMAGE_KEYS, buckets: int = BUCKETS) -> DataFrame:
    """Write rows in buckets by the keys, each one sorted file, and return the table."""
    spark = rows.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    # Rows of a bucket come from one task, so that a bucket is one file, and stays sorted.
    cut = rows.repartition(buckets, *keys)
    cut.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(_name(path))
    return spark.table(_name(path))


def read_bucketed(
    spark: SparkSession, path: str, schema: str | None = None, keys: Sequence[str] = IMAGE_KEYS, buckets: int = BUCKETS
) -> DataFrame:
    """A table that ``write_bucketed`` has written, also in another session."""
    if not spark.catalog.tableExists(_name(path)):
        found = spark.read.parquet(path).schema if schema is None else spark.createDataFrame([], schema).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found)
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE {_name(path)} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by})"
                  f" INTO {buckets} BUCKETS LOCATION {_quoted(path)}")
    return spark.table(_name(path))


def assembled(images: DataFrame, profiles: Sequence[DataFrame] | Mapping[str, DataFrame], keys: Sequence[str] = IMAGE_KEYS) -> DataFrame:
    """The images with the values of all profiles, each unique by the keys; NULL where one has none.

    The joins are merges of buckets: nothing is shuffled, however many populations there are."""
    tables = list(profiles.values()) if isinstance(profiles, Mapping) else list(profiles)
    return reduce(lambda left, right: left.join(right.hint("merge"), list(keys), "left"), tables, images)
