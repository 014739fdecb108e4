import random

import numpy as np
import pyarrow as pa
from rows import frame, odd, words

from platewright.llm import decontaminate as dc
from platewright.llm.words import grams, hashed, separator


def items_frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id int, text string")


def plain_smith_waterman(item, window):
    rows, best = [[0] * (len(window) + 1)], 0
    for x in item:
        row = [0]
        for j, y in enumerate(window):
            row.append(max(0, rows[-1][j] + (dc.MATCH if x == y else dc.MISMATCH), rows[-1][j + 1] + dc.GAP, row[j] + dc.GAP))
        rows.append(row)
        best = max(best, *row)
    return best


def test_alignment_equals_the_plain_one():
    rng = np.random.default_rng(1)
    items = [rng.integers(0, 6, rng.integers(1, 20)).astype(np.uint64) for _ in range(50)]
    windows = [rng.integers(0, 6, rng.integers(1, 40)).astype(np.uint64) for _ in range(50)]
    best, _ = dc.align(items, windows)
    assert best.tolist() == [plain_smith_waterman(x.tolist(), y.tolist()) for x, y in zip(items, windows)]


def test_copies_are_found_and_scored(spark):
    rng = random.Random(4)
    items = [" ".join(words(rng, n)) for n in (6, 16, 30, 59, 30)]
    docs, expected = [], {}
    for n in range(120):
        text = words(rng, rng.randint(30, 400))
        kind = n % 4
        if kind:
            item = n % len(items)
            part = items[item].split()
            if kind == 2:  # an edited word in eight
                part = [w if i % 8 != 5 else "edited" for i, w in enumerate(part)]
            if kind == 3:  # words put in, other case and punctuation
                part = [w.upper() + "," for i, w in enumerate(part)]
                part.insert(3, "more")
            at = rng.randrange(len(text))
            text[at:at] = part
            expected[n] = (item, kind)
        docs.append(" ".join(text))
    found = dc.contaminated(frame(spark, docs), items_frame(spark, items)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(n, i) for n, (i, _) in expected.items()}
    for r in found:
        kind = expected[r["doc_id"]][1]
        size = len(items[r["item_id"]].split())
        if kind == 1:
            assert r["score"] == 1.0
            own = docs[r["doc_id"]].split()
            assert " ".join(own[r["first_word"] : r["last_word"] + 1]) == items[r["item_id"]]
        elif kind == 3:
            assert r["score"] == (2 * size - 1) / (2 * size)


def test_one_edited_copy_is_found(spark):
    """One edit in 4, 5 and 6 words, also where an exact copy elsewhere raises all counts."""
    rng = random.Random(8)
    items, docs, expected = [], [], {}
    for size in (20, 30, 45, 60):
        for step in (4, 5, 6):
            for copied in (False, True):
                item = [f"i{len(items)}x{i}" for i in range(size)]
                part = [w if i % step != step - 1 else f"edit{i}" for i, w in enumerate(item)]
                expected[len(docs), len(items)] = plain_smith_waterman(item, part) / (dc.MATCH * size)
                docs.append(" ".join([*words(rng, 40), *part, *words(rng, 40)]))
                if copied:
                    expected[len(docs), len(items)] = 1.0
                    docs.append(" ".join(item))
                items.append(" ".join(item))
    found = dc.contaminated(frame(spark, docs), items_frame(spark, items)).collect()
    assert min(expected.values()) > dc.MIN_SCORE
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in found} == expected and len(found) == len(expected)


def test_one_seed_is_enough_and_passages_do_not_overlap(spark):
    item = "a b c d e f".split()
    docs = ["x y a b c Z e f x", "a b c d e f x a b c d e f", "c b a f e d a b c"]
    found = dc.contaminated(frame(spark, docs), items_frame(spark, [" ".join(item)])).collect()
    places = sorted((r["doc_id"], r["score"], r["first_word"], r["last_word"]) for r in found)
    assert places == [(0, 0.75, 2, 7), (1, 1.0, 0, 5), (1, 1.0, 7, 12), (2, 0.5, 3, 8)]


def test_broadcast_or_shuffled_gives_the_same(spark):
    rng = random.Random(5)
    items = [" ".join(words(rng, 20)) for _ in range(12)]
    docs = [" ".join([*words(rng, 50), items[n % 12], *words(rng, 20)]) for n in range(40)] + [items[3] + " x " + items[4]]
    both = [
        sorted(map(tuple, dc.contaminated(frame(spark, docs), items_frame(spark, items), max_broadcast=size).collect()))
        for size in (-1, 10**6)
    ]
    assert both[0] == both[1] and len(both[0]) == 42


def test_equals_aligning_all_pairs(spark, monkeypatch):
    """Few words, so that n-grams are frequent and the most frequent are no seeds: one edit in 4
    to 8 words, whole items and halves, several candidates of a document in several parts."""
    monkeypatch.setattr(dc, "PART", 2)
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(60)]
    common = rng.choices(vocabulary, k=8)
    items = [rng.choices(vocabulary, k=10) + common + rng.choices(vocabulary, k=rng.randint(5, 40)) for _ in range(15)]
    docs = [[*rng.choices(vocabulary, k=30), *common, *rng.choices(vocabulary, k=30)] for _ in range(40)]
    for n in range(60):
        part, step = list(items[n % 15]), 4 + n % 5
        if n % 3 == 0:
            part = part[: 2 + (len(part) * 2) // 3]
        edits = [i for i in range(len(part)) if i % step == step - 1]
        for i in reversed(edits):
            if n % 4 == 0:
                part[i] = f"edit{i}"
            elif n % 4 == 1:
                part.insert(i, "more")
            elif n % 4 == 2:
                part[i] = rng.choice(vocabulary)
        docs.append(docs[n % 40][:20] + part + items[(n + 1) % 15])
    found = dc.contaminated(
        frame(spark, [" ".join(d) for d in docs]), items_frame(spark, [" ".join(i) for i in items])).collect()
    best = {}
    for r in found:
        best[r["doc_id"], r["item_id"]] = max(best.get((r["doc_id"], r["item_id"]), 0), r["score"])
    expected = {}
    for d, doc in enumerate(docs):
        for i, item in enumerate(items):
            score = plain_smith_waterman(item, doc) / (dc.MATCH * len(item))
            if score >= dc.MIN_SCORE:
                expected[d, i] = score
    assert len(expected) > 100 and best == expected


def test_passages_have_more_grams_than_are_spared():
    """The least number of unbroken n-grams over all edits of a passage, counted one by one."""
    share, less = dc.surviving()
    for size in range(3, 80):
        least = size
        for length in range(1, size + 1):
            for edited in range(length // dc.EDITS + 1):
                if dc.MATCH * (length - edited) + dc.MISMATCH * edited >= dc.MIN_SCORE * dc.MATCH * size:
                    least = min(least, length - dc.NGRAM + 1 - dc.NGRAM * edited)
        assert least >= size * share - less - 1e-9


def test_copies_and_very_frequent_grams(spark):
    """An item twice, a document many times, and an n-gram of the item in every document."""
    rng = random.Random(10)
    item = words(rng, 30)
    docs = [" ".join([*words(rng, 20), *item[4:8], *words(rng, 20)]) for _ in range(100)]
    docs += [" ".join([*words(rng, 5), *item])] * 50
    found = dc.contaminated(frame(spark, docs), items_frame(spark, [" ".join(item), "other words here", " ".join(item)]))
    rows = sorted((r["doc_id"], r["item_id"], r["score"]) for r in found.collect())
    assert rows == [(d, i, 1.0) for d in range(100, 150) for i in (0, 2)]


def test_clean_drops_only_contaminated(spark):
    rng = random.Random(6)
    items = [" ".join(words(rng, 25))]
    docs = frame(spark, [" ".join(words(rng, 80)), "before " + items[0], None, items[0], "tail"], [1, 2, 3, None, 5])
    kept = dc.clean(docs, items_frame(spark, items))
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 3, 5]


def test_odd_rows(spark):
    docs = odd(spark)
    items = items_frame(spark, [None, "", "a b", "word word word", "one two three four"])
    found = dc.contaminated(docs, items)
    assert {r["item_id"] for r in found.collect()} <= {3}
    assert dc.clean(docs, items).columns == docs.columns
    assert dc.contaminated(docs.limit(0), items).collect() == []
    assert dc.contaminated(docs, items.limit(0)).collect() == []
    assert dc.clean(docs, items.limit(0)).count() == docs.count()


def test_words_are_those_of_the_text():
    rng = random.Random(7)
    alphabet = "aB1é漢 \t\n\x0b.,-"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(300)] + [None, ""]
    by_hash, by_word = {}, {}
    for sep, split in ((separator(), lambda t: t.encode().lower().split()),):
        for low, high, hashes, starts in hashed(pa.array(texts, pa.string()), sep):
            for n in range(low, high):
                own, expected = hashes[starts[n - low] : starts[n - low + 1]].tolist(), split(texts[n] or "")
                assert len(own) == len(expected)
                for h, w in zip(own, expected):
                    assert by_hash.setdefault(h, w) == w and by_word.setdefault(w, h) == h
            three = grams(hashes, starts, 3)
            assert (three != np.uint64(2**64 - 1)).sum() == np.maximum(0, np.diff(starts) - 2).sum()
