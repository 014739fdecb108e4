import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from rows import frame, odd

from platewright.llm import lm


def markov_texts(n=400, seed=0):
    """Words that depend on the word before, so that there is something to learn."""
    rng = random.Random(seed)
    vocabulary = [f"V{i}" for i in range(60)]
    nexts = {v: rng.sample(vocabulary, 3) for v in vocabulary}
    texts = []
    for _ in range(n):
        word, text = rng.choice(vocabulary), []
        for _ in range(rng.randint(20, 80)):
            text.append(word if rng.random() < 0.9 else f"rare{rng.randrange(5000)}")
            word = rng.choice(nexts[word])
        texts.append(" \n"[rng.randrange(2)].join(text))
    return texts


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def brute(texts):
    tokens = [[*(t or "").encode().lower().split(), None] for t in texts]
    counts = Counter(w for i, own in enumerate(tokens) if not held(i) for w in own)
    total, size = sum(counts.values()), len(counts)
    return tokens, counts, total, math.log10(total + 0.5 * (size + 1))


@pytest.fixture(scope="module")
def scored(spark):
    texts = [*markov_texts(1500), None, "", "unseen words only"]
    return texts, lm.scored(frame(spark, texts)).orderBy("doc_id").collect()


@pytest.mark.parametrize("head", [1 << 16, 40])
def test_base_scores(spark, monkeypatch, head):
    """Also with most words beyond those whose counts the tasks hold."""
    monkeypatch.setattr(lm.frequent, "__defaults__", (head,))
    texts = [*markov_texts(60, 1), None, "", "unseen words only"]
    tokens, counts, total, log_base = brute(texts)
    for i, r in enumerate(lm.scored(frame(spark, texts)).orderBy("doc_id").collect()):
        assert r["held_out"] == held(i) and r["train_tokens"] == total
        assert r["n_tokens"] == len(tokens[i]) and r["n_known"] == sum(counts[w] > 0 for w in tokens[i])
        assert r["base_score"] == pytest.approx(sum(math.log10(counts[w] + 0.5) - log_base for w in tokens[i]), abs=1e-9)


def test_model_beats_counts_on_held_out_texts(scored):
    rows = [r for r in scored[1] if r["held_out"]]
    n = sum(r["n_tokens"] for r in rows)
    base, model = sum(r["base_score"] for r in rows) / n, sum(r["score"] for r in rows) / n
    assert model > base + 0.15


def test_scores_are_probabilities(spark):
    """Over all words that can follow, and one unseen word, they sum to 1."""
    texts = markov_texts(80, 2)
    counts = brute(texts)[1]
    known = [w.decode() for w in counts if w is not None]
    start = "v1 v2"
    # Each candidate ends a text; dividing by the text that ends before it leaves its own probability
    # and that of the end token after it, so ends are compared apart, by the model's own tables.
    model = lm.Model(np.array([5.0, *sorted(counts.values(), reverse=True)[:50]]))
    last, second = model.tables()
    z = lm.log_sums(spark, model)
    p = np.exp(last[3] + second[7] - z[3, 7])
    assert p.sum() == pytest.approx(1, abs=1e-4)
    assert len(known) > 50 and start


def test_counts(spark, monkeypatch):
    monkeypatch.setattr(lm, "MERGE", 64)
    texts = markov_texts(50, 3)
    rows = lm.word_counts(frame(spark, texts).select("text")).collect()
    counts = Counter(w for t in texts for w in [*t.lower().split(), None])
    assert sorted(r["n"] for r in rows) == sorted(counts.values())


def test_frequent_words(spark):
    counts = spark.createDataFrame([(i, 1 + i // 10) for i in range(1000)], "word long, n long")
    got = lm.frequent(counts, 100)
    assert 50 <= len(got) <= 100
    lowest = min(r["n"] for r in got)
    assert len(got) == sum(1 for i in range(1000) if 1 + i // 10 >= lowest)
    assert lm.frequent(spark.createDataFrame([(i, 1) for i in range(10)], "word long, n long"), 5) == []


def test_odd_rows(spark):
    docs = odd(spark)
    rows = lm.scored(docs).collect()
    assert len(rows) == docs.count()
    assert all(r["n_tokens"] >= 1 and r["score"] < 0 and math.isfinite(r["score"]) for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (0, 1, 2, 5)} == {1}
    assert lm.scored(docs.limit(0)).collect() == []
