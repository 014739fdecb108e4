import hashlib
import random
import zlib

import numpy as np
import pytest
from rows import frame, odd

from platewright.llm import repeats
from platewright.llm.queries import op12_periodic_runs, run_digests


def brute_runs(words):
    """All periods at all places, the smallest period of each stretch."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q - start), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def text_with_runs(rng):
    words, letters = [], rng.choice(["ab", "abc", "abcdefgh", "abcdefghijklmnopqrstuvwxyz"])
    for _ in range(rng.randint(0, 6)):
        words += [rng.choice(letters) for _ in range(rng.randint(0, 12))]
        period = [rng.choice(letters) for _ in range(rng.choice([1, 1, 2, 2, 3, 4, 5, 8, 13]))]
        words += (period * rng.randint(1, 9))[: rng.randint(1, 80)]
        if rng.random() < 0.3:
            words += words[rng.randint(0, len(words)) :]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_equals_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(500):
        words = text_with_runs(rng)
        assert [tuple(r) for r in repeats.runs_of(words).tolist()] == brute_runs(words), words


def test_nested_runs():
    """Runs inside the period of a run, and Fibonacci words, which have as many as can be."""
    inner = ["a"] * 6 + ["b"] + ["c", "d"] * 4
    words = ["x", *(inner * 5), "y", *inner]
    assert [tuple(r) for r in repeats.runs_of(words).tolist()] == brute_runs(words)
    a, b = "a", "ab"
    while len(b) < 1500:
        a, b = b, b + a
    for words in (list(b), list(b * 4), list("ab" * 300 + "a" * 301), ["w"] * 1000):
        assert [tuple(r) for r in repeats.runs_of(words).tolist()] == brute_runs(words)


def test_grammar_derives_the_text():
    rng = random.Random(4)
    for _ in range(200):
        ids = [ord(w) for w in text_with_runs(rng)]
        rules, rest = repeats.re_pair(ids)
        for left, right, places in rules:
            assert len(places) > 1
            assert len({tuple(ids[p : p + left + right]) for p in places}) == 1
        pairs = [tuple(ids[a:c]) + (b - a,) for a, b, c in zip(rest, rest[1:], [*rest[2:], len(ids)])]
        # No pair of symbols is left twice, but for those that overlap.
        assert all(pairs[i] not in pairs[i + 2 :] for i in range(len(pairs)))


def test_long_texts_take_little_longer():
    import time

    rng = random.Random(2)
    half = [str(rng.randint(0, 5000)) for _ in range(20_000)]
    period = [str(rng.randint(0, 50)) for _ in range(3000)]
    for words in (half + half, period * 12, ["a"] * 100_000, half + ["a", "b"] * 10_000):
        begin = time.perf_counter()
        runs = repeats.runs_of(words)
        assert time.perf_counter() - begin < 10
    assert [20_000, 20_000, 2] in runs.tolist()


def plant(doc_id, words):
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def digest(lines):
    return hashlib.sha256(lines.encode()).hexdigest()


def expected(doc_id, text):
    words = [w.decode() for w in plant(doc_id, (text or "").encode().split())]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *shown, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in dropped)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_brute_force(spark):
    rng = random.Random(11)
    texts = [None, "", " \t", "one", *(" ".join(text_with_runs(rng)) for _ in range(300)), "a b\x0bc\x1cd e\x85 " * 30]
    docs = frame(spark, texts)
    found = run_digests(docs)
    assert found.columns == COLUMNS
    assert [tuple(r) for r in found.orderBy("doc_id").collect()] == [expected(i, t) for i, t in enumerate(texts)]


def test_query_on_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = {r[0]: expected(*r) for r in docs if len(r[1] or "") < 4000}
    rows = {r["doc_id"]: tuple(r) for r in op12_periodic_runs(spark, sf_dir).collect()}
    assert len(rows) == len(docs) and len(short) > 100
    assert {i: rows[i] for i in short} == short
    assert any(r[1] for r in rows.values())


def test_operator_keeps_columns_and_gives_texts(spark):
    rows = repeats.with_runs(frame(spark, ["x a b a b a b a b y", "p q"])).orderBy("doc_id").collect()
    assert [r["collapsed"] for r in rows] == ["x a b y", "p q"]
    assert [[tuple(x) for x in r["runs"]] for r in rows] == [[(1, 8, 2)], []] and rows[0]["lang"] == "en"


def test_odd_rows(spark):
    docs = odd(spark)
    found = run_digests(docs)
    assert found.count() == docs.count() and found.filter("runs_sha256 is null or collapsed_sha256 is null").count() == 0
    kept = repeats.with_runs(docs.withColumnRenamed("kept", "runs"))
    assert kept.schema["runs"].dataType.typeName() == "array" and "fingerprint" in kept.columns
    assert run_digests(docs.limit(0)).collect() == []
    assert np.array_equal(repeats.runs_of([]), np.empty((0, 3)))
