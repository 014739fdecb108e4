"""Columns added to a DataFrame by a function over Arrow batches, in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


#: Bytes of a batch that is sent to Python, and that a function gets at once; whole rows each time.
BATCH_BYTES, PART_BYTES = 8 << 20, 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session sends batches of ``BATCH_BYTES`` to Python from now on: what a
    Python worker holds then does not depend on how long the texts are but for the longest."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    rows = max(1, batch.num_rows * PART_BYTES // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def kept_by_worker(key: tuple, build: Callable):
    """What ``build`` made for the last ``key`` in this Python worker. Workers run one task
    after another; a large object is made once in each, and only one is held."""
    import sys
    from types import ModuleType

    store = sys.modules.setdefault("_kept_by_worker", ModuleType("_kept_by_worker")).__dict__
    if store.get("key") != key:
        store.pop("value", None)
        store["value"], store["key"] = build(), key
    return store["value"]


def with_arrow_columns(
    df: DataFrame, added: T.StructType, make: Callable[[], Callable[[pa.RecordBatch], list]]
) -> DataFrame:
    """All columns of ``df`` and the ``added`` ones.

    ``make`` is called once per task and returns the function of a batch that
    gives the added columns. Columns of the same names are replaced.
    """
    names = {field.name.lower() for field in added}
    kept = [field for field in df.schema if field.name.lower() not in names]
    schema = T.StructType([*kept, *added])
    types = [field.type for field in to_arrow_schema(added)]
    keep = [field.name for field in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in (part for whole in batches for part in parts_of(whole)):
            new = [pa.array(v, t) if not isinstance(v, pa.Array) else v.cast(t)
                   for v, t in zip(function(batch), types)]
            columns = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays([*columns, *new], names=[*keep, *added.names])
            del new, columns
        pa.default_memory_pool().release_unused()

    return small_batches(df).mapInArrow(run, schema)
