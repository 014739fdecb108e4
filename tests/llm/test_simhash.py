import random

import numpy as np
import pytest
from rows import frame, odd, words

xxhash = pytest.importorskip("xxhash")

from platewright.llm import simhash
from platewright.llm.components import components


def brute_print(text, n=3):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] if len(w) > n else [b" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in prints:
        for j in prints:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in prints}


def near_texts(seed=0):
    rng = random.Random(seed)
    texts = [" ".join(words(rng, rng.randint(5, 120))) for _ in range(40)]
    for _ in range(80):
        w = rng.choice(texts).split()
        if rng.random() < 0.7 and w:
            w[rng.randrange(len(w))] = "edited"
        texts.append(" ".join(w))
    return [*texts, None, "", "A b", "a B"]


@pytest.mark.parametrize("chunk", [1024, 3])
def test_whole_operator(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash.links, "__defaults__", (chunk,))
    texts = near_texts()
    rows = simhash.near_duplicates(frame(spark, texts)).collect()
    prints = {i: brute_print(t) for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["fingerprint"] & (1 << 64) - 1 for r in rows} == prints
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute_components(prints, 3)


@pytest.mark.parametrize("distance, chunk", [(3, 1024), (3, 20), (2, 1024), (1, 1024), (0, 1024), (6, 1024)])
def test_links_join_all_within_the_distance(spark, distance, chunk):
    rng = random.Random(distance)
    prints = []
    for _ in range(60):
        base = rng.getrandbits(64)
        prints += [base] + [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(4)]
    dense = rng.getrandbits(64)
    prints += [dense ^ 1 << b for b in range(64)] + [0, (1 << 64) - 1, 1 << 63]
    prints = sorted(set(prints))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fingerprint long"), distance, chunk)
    pairs = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in found.collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in pairs)
    number = {p: i for i, p in enumerate(prints)}
    joined = components(spark.createDataFrame([(number[a], number[b]) for a, b in pairs] or [(0, 0)], "a long, b long"))
    roots = {r["node"]: r["root"] for r in joined.collect()}
    expected = brute_components(dict(enumerate(prints)), distance)
    assert {i: roots.get(i, i) for i in number.values()} == expected


def test_anchors_are_within_reach(spark):
    """Two values that differ in one bit of a block share the home of either."""
    rng = random.Random(5)
    base = [rng.getrandbits(63) for _ in range(20)]
    other = [x ^ 1 << rng.randrange(31) for x in base]
    rows = simhash.anchors(spark.createDataFrame([(x,) for x in [*base, *other]], "fingerprint long"), 3).collect()
    by = {}
    for r in rows:
        by.setdefault(r["print"], {}).setdefault(r["home"], set()).add(r["anchor"])
    everywhere = {x: set().union(*homes.values()) for x, homes in by.items()}
    for x, y in zip(base, other):
        assert by[x][True] & everywhere[y] and by[y][True] & everywhere[x]
    assert max(map(len, everywhere.values())) <= 32


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(100)] + [(200, 300 + i) for i in range(50)] + [(7, 7), (None, 3), (9, None)]
    pairs += [(1000 + rng.randrange(50), 1000 + rng.randrange(50)) for _ in range(30)]
    rng.shuffle(pairs)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {i: got[i] for i in range(1, 101)} == dict.fromkeys(range(1, 101), 0)
    assert {got[300 + i] for i in range(50)} == {200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_group_stays(spark):
    docs = frame(spark, ["a b c d", "a b c d", "other words are here now", None, "", "a b c d"], [5, 3, 7, 9, 8, 3])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 7, 8]


def test_odd_rows(spark):
    docs = odd(spark)
    assert simhash.near_duplicates(docs).count() == docs.count()
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("doc_id IS NULL").count() == 2
    assert simhash.near_duplicates(docs.limit(0)).collect() == [] and simhash.keep_one(docs.limit(0)).collect() == []
