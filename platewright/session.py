"""Session with the settings the jobs are written for, and the shared folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "platewright", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``.

    Only where a local run names none a temporary one is set, which goes when
    the run ends. On a cluster that is an error: executors do not share it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = named or spark.sparkContext.getCheckpointDir()
    if current is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="platewright-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(current)
    return current


@contextmanager
def listed_in_few_tasks(spark: SparkSession) -> Iterator[None]:
    """Within it, Spark lists the files of a table or a long list of paths by some tasks a core.
    By default it takes a task per folder, which costs more than the listing and sends kilobytes to the driver."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, wanted = int(spark.conf.get(name)), spark.sparkContext.defaultParallelism * 4
    spark.conf.set(name, str(min(before, wanted)))
    try:
        yield
    finally:
        spark.conf.set(name, str(before))


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(rows: DataFrame) -> DataFrame:
    """``rows.checkpoint()`` after which Spark removes the files that were shuffled for it. By default they
    stay until the driver happens to collect its garbage, so that those of all steps lie on the disks at once."""
    name, spark = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", rows.sparkSession
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        # Spark looks at the setting where a DataFrame is made.
        return rows.select("*").checkpoint()
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows written once to a folder of their own, for what would else be computed at each reading."""
    path = new_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
