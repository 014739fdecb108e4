import random

import pytest
from pyspark.sql import functions as F
from rows import odd

from platewright.llm import shards
from platewright.llm.queries import sharded


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, x long, y string, w long")


def placed(spark, rows, **sizes):
    dims = {"x": shards.number(F.col("x")), "y": shards.prefix(F.col("y"))}
    return shards.with_shards(table(spark, rows), dims, F.col("w"), **sizes).collect()


def skewed(n=6000, seed=0):
    """A third of the rows share all metadata; some rows weigh much."""
    rng = random.Random(seed)
    return [
        (i, 5 if i % 3 == 0 else rng.randrange(10**6), "hot" if i % 3 == 0 else f"s{rng.randrange(40)}",
         rng.randrange(1, 200) if rng.random() < 0.99 else 2000) for i in range(n)
    ]


@pytest.mark.parametrize("leaves", [1, 2, 7, 16])
def test_bytes_are_near_equal(spark, leaves):
    rows = placed(spark, skewed(), leaves=leaves)
    assert len(rows) == 6000
    weights = [sum(r["w"] for r in rows if r["shard"] == s) for s in range(leaves)]
    mean = sum(weights) / leaves
    assert max(abs(w - mean) for w in weights) < 2000 + 0.01 * mean * leaves
    assert {r["shard"] for r in rows} == set(range(leaves))


def test_target_bytes_decides_the_number(spark):
    rows = placed(spark, skewed(2000), target_bytes=20_000)
    total = sum(r["w"] for r in rows)
    assert len({r["shard"] for r in rows}) == -(-total // 20_000)


def test_cuts_follow_the_widest_dimension(spark):
    """Two clusters far apart in x are not mixed."""
    rows = [(i, 100 if i % 2 else 10**6 + i, "a", 1) for i in range(1000)]
    found = placed(spark, rows, leaves=2)
    assert {(r["x"] > 1000, r["shard"]) for r in found} == {(False, 0), (True, 1)}


def test_order_of_values(spark):
    df = spark.createDataFrame([("",), (None,), ("a",), ("ab",), ("b",), ("é",), ("src1",), ("src10",), ("src2",)], "s string")
    got = df.select("s", shards.prefix(F.col("s")).alias("v")).collect()
    ordered = [r["s"] for r in sorted(got, key=lambda r: (r["v"], r["s"] or ""))]
    assert [s for s in ordered if s] == ["a", "ab", "b", "src1", "src10", "src2", "é"]
    assert {r["v"] for r in got if not r["s"]} == {0}


@pytest.mark.parametrize("bucket_rows", [4096, 10])
def test_slots_have_no_gaps(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(shards, "BUCKET_ROWS", bucket_rows)
    rows = spark.range(500).selectExpr("id % 300 AS id", "cast(id % 3 AS int) AS shard")
    found = shards.with_slots(rows, ["id"]).collect()
    for shard in range(3):
        own = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert own == list(range(len(own)))


def test_odd_rows(spark):
    docs = odd(spark)
    rows = sharded(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["law"] == "bytes" and 0 <= r["shard"] < 16 and r["grown_shard"] is None
    assert sorted((r["size"], r["text_crc32"]) for r in rows)[0] == (1, 0)
    assert sharded(docs.limit(0)).collect() == []


def test_written_by_shard(spark, tmp_path):
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('t', id) AS text")
    found = docs.selectExpr("doc_id", "cast(doc_id % 4 AS int) AS shard")
    shards.write_shards(docs, found, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r["doc_id"], r["shard"]) for r in back.collect()} == {(i, i % 4) for i in range(40)}
