import random
import re
from collections import Counter

import pytest
from rows import frame, odd, words

from platewright.llm import quality


def brute(text):
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_measures(spark):
    rng = random.Random(1)
    texts = [None, "", " \t", "a b c a b c", "a a a a", "x\nx\n \n\nx ", "é😀\x85w # $", "a b c"]
    for _ in range(150):
        joint = [" ", "  ", "\n", "\t"]
        texts.append("".join(w + rng.choice(joint) for w in words(rng, rng.randint(0, 80), rng.choice([3, 8, 500]))))
    rows = quality.with_measures(frame(spark, texts)).orderBy("doc_id").collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert [tuple(r[n] for n in names) for r in rows] == [brute(t) for t in texts]


def test_estimates_tell_rules_apart():
    """Votes of made-up rules: two that agree on what is bad, one that says nothing."""
    rng, patterns = random.Random(2), Counter()
    truth = Counter()
    for _ in range(4000):
        bad = rng.random() < 0.1
        first = -1 if rng.random() < (0.9 if bad else 0.01) else 1
        second = -1 if rng.random() < (0.8 if bad else 0.02) else 1
        votes = (first, second, rng.choice([0, 1]))
        patterns[votes] += 1
        truth[votes, bad] += 1
    odds, adds = quality.estimate(sorted((list(v), n) for v, n in patterns.items()), 3)

    def good(votes):
        return quality.posterior(odds + sum(adds[j][v] for j, v in enumerate(votes))) >= 0.5

    wrong = sum(n for (votes, bad), n in truth.items() if good(votes) == bad)
    assert wrong < 0.04 * 4000
    assert abs(adds[2][1]) < 0.3 and adds[0][-1] < -2


def good_text(rng, n=200):
    return "\n".join(" ".join(words(rng, 12)) + "." for _ in range(n // 12))


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(3)
    texts = [good_text(rng) for _ in range(300)]
    texts += [" ".join(w + rng.choice(["###", "%%%", "|"]) for w in words(rng, 200)) for _ in range(20)]
    texts += ["same old words " * 60 for _ in range(10)] + ["too short"] * 10 + [None]
    docs = frame(spark, texts)
    return docs, quality.with_quality(quality.with_measures(docs)).orderBy("doc_id").collect()


def test_kept(judged):
    rows = judged[1]
    assert all(r["kept"] and r["quality"] > 0.9 for r in rows[:300])
    assert not any(r["kept"] for r in rows[300:])
    assert [r["base_failed"] for r in rows[300:]] == [False] * 20 + [True] * 21


def test_rows_stay_whole(judged):
    docs, rows = judged
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == sorted(tuple(r[c] for c in docs.columns) for r in rows if r["kept"])


def test_no_python_in_the_plan(judged):
    plan = quality.keep_good(judged[0])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(spark):
    docs = odd(spark)
    rows = quality.with_quality(quality.with_measures(docs))
    assert rows.count() == docs.count()
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.keep_good(docs.limit(0)).collect() == []
