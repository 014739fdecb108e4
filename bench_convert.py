"""Time the conversion of made-up plates: ``bench_convert.py PLATES [OBJECTS_PER_WELL [BATCHES]]``.

Writes index and object exports of 96-well plates with three populations to a
new folder, converts them and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F

from platewright.plans.convert import convert
from platewright.session import get_session, new_folder
from platewright.sources import exports, synthetic

LINKS = {"Hoechst": "HOECHST 33342", "O4Final": "Alexa 488narrow", "PDGFSelected": "Alexa 647"}


# Bytes of a made-up plate's index: 96 wells of three channels.
INDEX_BYTES = 22_000


def main(plates: int, per_well: int, batches: int | None) -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench_convert",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    root, out = new_folder(spark, "plates"), new_folder(spark, "converted")
    images = synthetic.random_images(spark, plates)
    index = synthetic.random_index(images, list(LINKS.values()))
    start = time.perf_counter()
    names = {c: c for c in index.columns if c not in ("plate", "seq")}
    synthetic.write_exports(index, root, "Index", names, order="seq")
    for number, population in enumerate(LINKS):
        objects = synthetic.random_objects(images, population, per_well, salt=number)
        names = {c: c for c in objects.columns if c != "plate"}
        synthetic.write_exports(objects, root, population, names)
    written = time.perf_counter()

    files = exports.ExportFiles(root, r"plate=([^/]+)/", r"table=([^/]+)/")
    pictures = synthetic.image_paths(index, "/images")
    size = {} if batches is None else {"batch_bytes": plates * INDEX_BYTES // batches}
    done = convert(spark, files, pictures, LINKS, out, **size)
    seconds = time.perf_counter() - written
    table = done["images"]
    counted = table.agg(*[F.sum(f"Image_Count_{p}") for p in LINKS]).first()
    objects = sum(counted)
    assert objects == plates * 96 * per_well * len(LINKS), counted
    print(json.dumps({
        "plates": plates, "objects": objects, "images": table.count(),
        "generate_seconds": round(written - start, 1), "convert_seconds": round(seconds, 1),
        "objects_per_second": round(objects / seconds),
    }))
    spark.stop()


if __name__ == "__main__":
    numbers = [int(x) for x in sys.argv[1:]]
    main(numbers[0], numbers[1] if len(numbers) > 1 else 799, numbers[2] if len(numbers) > 2 else None)
