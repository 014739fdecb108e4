import random

import pytest
from pyspark.sql import functions as F

from platewright.operators import joins


@pytest.fixture()
def tables(spark, tmp_path):
    """A third of the rows has one key (all copies), a tenth a NULL key."""
    rows = [(1, "p", 0)] * 100 + [(None, "p", i) for i in range(30)]
    rows += [(i % 50 + 2, "p", i) for i in range(170)]
    spark.createDataFrame(rows, "k long, plate string, v int").repartition(3).write.parquet(f"{tmp_path}/f")
    facts = spark.read.parquet(f"{tmp_path}/f")
    dim = spark.createDataFrame([(k, "p", k * 10) for k in range(1, 40)], "k long, plate string, d long")
    return facts, dim


@pytest.mark.parametrize("split_rows", [3, 7, 1000])
def test_split_join_is_a_left_join(tables, split_rows):
    facts, dim = tables
    keys = ["plate", "k"]
    got = joins.split_left_join(facts, dim, keys, split_rows=split_rows)
    expected = facts.join(dim, keys, "left").select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_hot_keys_are_cut(tables):
    facts, _ = tables
    counts = facts.dropna().groupBy("k").agg(F.count("*").alias("n"))
    hot = {r["k"]: r["_parts"] for r in joins.hot_keys(counts, ["k"], 10).collect()}
    assert hot == {1: 10}


def test_hot_rows_are_spread(tables):
    facts, dim = tables
    joined = joins.split_left_join(facts, dim, ["plate", "k"], split_rows=5)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan
    where = facts.withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.lit(20)))
    parts = where.filter("k = 1").groupBy("_part").count().collect()
    assert len(parts) > 10 and max(r["count"] for r in parts) < 20


def test_is_small(spark):
    assert joins.is_small(spark.range(10), 160)
    assert not joins.is_small(spark.range(11), 160)
    assert joins.is_small(spark.range(0), 0)
    assert not joins.is_small(spark.sql("SELECT repeat('x', 1000) AS s"), 1000)


def test_fill_if_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", None)], "k string, v double")
    new = spark.createDataFrame([("a", 9.0), ("b", 2.0)], "k string, w double")
    got = {r["k"]: r["v"] for r in joins.fill_if_null(df, new, ["k"], "v", "w").collect()}
    assert got == {"a": 1.0, "b": 2.0, "c": None}


def brute_asof(left, right):
    found = []
    for k, t in left:
        values = [(time, v) for key, time, v in right if None not in (k, t, time) and key == k and time <= t]
        found.append((k, t, max(values)[1] if values else None))
    return sorted(found, key=repr)


@pytest.mark.parametrize("span", [1, 3, 1 << 16])
def test_asof_join(spark, span):
    rng = random.Random(span)
    left = [(rng.choice(["a", "b", None]), rng.choice([*range(-5, 40), None])) for _ in range(300)]
    right = [(rng.choice(["a", "b", "c", None]), rng.choice([*range(-3, 30, 4), None]), rng.choice("xyz")) for _ in range(60)]
    frames = spark.createDataFrame(left, "k string, t long"), spark.createDataFrame(right, "k string, t long, v string")
    got = joins.asof_join(*frames, ["k"], "t", "v", span).collect()
    assert sorted(map(tuple, got), key=repr) == brute_asof(left, right)
    plan = joins.asof_join(*frames, ["k"], "t", "v")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = joins.asof_join(frames[0], frames[1].limit(0), ["k"], "t", "v")
    assert none.count() == len(left) and none.filter("v is not null").count() == 0


def test_arrays_count_by_their_size(spark):
    rows = spark.range(10).selectExpr("id", "array_repeat('word', 1000) AS words", "named_struct('a', repeat('x', 500)) AS s")
    assert joins.is_small(rows, 100_000) and not joins.is_small(rows, 50_000)
