import random
import statistics

import pytest

from platewright.operators.ranking import dense_number, grouped_medians


def _numbers(rows):
    expected = {}
    for group in {g for g, _ in rows}:
        for number, order in enumerate(sorted(o for g, o in rows if g == group), start=1):
            expected[group, order] = number
    return expected


@pytest.mark.parametrize("spread", [10, 1 << 22, 1 << 44, 1 << 62])
def test_dense_number_matches_sorting(spark, spread):
    rng = random.Random(spread)
    rows = list({(rng.choice("ab"), rng.randint(-spread, spread)) for _ in range(500)})
    df = spark.createDataFrame(rows, "g string, o long")
    got = {(r["g"], r["o"]): r["n"] for r in dense_number(df, ["g"], "o", "n").collect()}
    assert got == _numbers(rows)


def test_dense_number_without_groups_and_with_ties(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 1)], "k string, o long")
    got = {r["k"]: r["n"] for r in dense_number(df, [], "o", "n", ties=["k"]).collect()}
    assert got == {"c": 1, "a": 2, "b": 3}


def test_grouped_median(spark):
    rng = random.Random(3)
    groups = {
        "odd": [rng.uniform(-100, 100) for _ in range(101)],
        "even": [rng.gauss(0, 1e6) for _ in range(100)],
        "copies": [1.5] * 400 + [2.5] * 399 + [-7.0],
        "one": [42.0],
        "two": [-1.0, 4.0],
        "wide": [10.0 ** e for e in range(-150, 150)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    rows += [("odd", None), ("odd", float("nan")), ("none", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, value double").repartition(4)
    rows = grouped_medians(df.withColumn("twice", df["value"] * 2), ["g"], ["value", "twice"]).collect()
    got = {r["_group"]["g"]: (r["n_value"], r["median_value"]) for r in rows}
    assert got.pop("none") == (0, None) and set(got) == set(groups)
    for r in rows:
        assert r["n_twice"] == r["n_value"]
        assert r["median_twice"] == (None if r["median_value"] is None else pytest.approx(2 * r["median_value"]))
    for g, vs in groups.items():
        assert got[g][0] == len(vs)
        assert got[g][1] == pytest.approx(statistics.median(vs), rel=1e-12)


def test_grouped_median_keeps_groups_with_null(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", None, 3.0), (None, 1, 5.0)], "g string, h int, value double")
    rows = grouped_medians(df, ["g", "h"], ["value"]).collect()
    assert {tuple(r["_group"]): r["median_value"] for r in rows} == {("a", None): 2.0, (None, 1): 5.0}


def test_medians_of_large_groups(spark, monkeypatch):
    """With a coarse summary many values lie between the bounds, few with a fine one."""
    from platewright.operators import ranking

    rng = random.Random(9)
    values = [rng.choice([rng.gauss(0, 1), float(rng.randrange(5))]) for _ in range(30_000)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 7.0)] * 20_000, "g string, value double")
    for accuracy in (20, 100, 10_000):
        monkeypatch.setattr(ranking, "ACCURACY", accuracy)
        got = {r["_group"]["g"]: r["median_value"] for r in grouped_medians(df.repartition(7), ["g"], ["value"]).collect()}
        assert got == {"a": statistics.median(values), "b": 7.0}
