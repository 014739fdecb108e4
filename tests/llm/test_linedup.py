import random

import numpy as np
from rows import frame, odd, words

from platewright.llm import linedup


def brute(texts):
    """Lines deleted when every two documents are aligned."""
    hashes = {i: np.array(linedup.line_hashes(t), np.uint64).view(np.int64) for i, t in enumerate(texts) if t is not None}
    out = {}
    for b in hashes:
        gone = set()
        for a in hashes:
            if a < b and set(hashes[a].tolist()) & set(hashes[b].tolist()) - {0}:
                gone |= set(linedup.aligned_blocks(hashes[a], hashes[b]))
        if gone:
            out[b] = gone
    return out


def shared_texts(seed=0):
    rng = random.Random(seed)
    pool = [" ".join(words(rng, rng.randint(1, 12), 500)) for _ in range(60)]
    texts = []
    for _ in range(40):
        lines = [" ".join(words(rng, rng.randint(1, 15))) for _ in range(rng.randint(0, 12))]
        at = rng.randrange(len(pool))
        lines[len(lines) // 2 : len(lines) // 2] = pool[at : at + rng.randint(0, 6)]
        if rng.random() < 0.3:
            lines.insert(0, "  ")
        texts.append("\n".join(lines))
    return [*texts, *rng.sample(texts, 5), None, ""]


def test_equals_aligning_all_pairs(spark):
    texts = shared_texts()
    rows = linedup.deleted_lines(frame(spark, texts), rare=1000).collect()
    assert {r["doc_id"]: set(r["deleted"]) for r in rows} == brute(texts)


def test_frequent_lines_lose_nothing(spark):
    """With no line rare enough to pair all documents, all that is aligned somewhere still goes."""
    texts = shared_texts(1)
    found = {r["doc_id"]: set(r["deleted"]) for r in linedup.deleted_lines(frame(spark, texts), rare=2).collect()}
    for doc, gone in brute(texts).items():
        assert gone <= found[doc]
    hashes = {i: linedup.line_hashes(t) for i, t in enumerate(texts) if t}
    for doc, gone in found.items():
        earlier = {h for i, own in hashes.items() if i < doc for h in own}
        assert all(hashes[doc][n] in earlier for n in gone)


def test_default_nearly_equals_aligning_all_pairs(spark):
    """Lines in 2, 20 and 200 documents, in any order, twice in one document, and short ones in a row."""
    rng = random.Random(3)
    pools = {size: [" ".join(words(rng, rng.randint(5, 9), 500)) for _ in range(count)] for size, count in ((200, 2), (20, 6), (2, 20))}
    short = ["ok then", "see more"]
    texts = [[" ".join(words(rng, rng.randint(5, 9))) for _ in range(rng.randint(1, 6))] for _ in range(240)]
    for size, pool in pools.items():
        for line in pool:
            for n in rng.sample(range(240), size):
                texts[n].insert(rng.randrange(len(texts[n]) + 1), line)
    for n in rng.sample(range(240), 40):
        at = rng.randrange(len(texts[n]) + 1)
        texts[n][at:at] = short
    for n in rng.sample(range(240), 20):
        texts[n].append(rng.choice(pools[200]))
    texts = ["\n".join(t) for t in texts]
    rows = {r["doc_id"]: set(r["deleted"]) for r in linedup.deleted_lines(frame(spark, texts)).collect()}
    expected = brute(texts)
    assert all(gone <= expected[doc] for doc, gone in rows.items())
    assert sum(map(len, rows.values())) >= 0.99 * sum(map(len, expected.values()))


def test_swapped_lines(spark):
    """Of two lines in swapped order one goes, whatever the number of other documents that have them."""
    one, two = "the first of two whole lines", "and the second of two lines"
    for others in (0, 20, 200):
        texts = [f"{one}\n{two}", f"{two}\n{one}"] + [f"{one}\n{two}\nown words of number {n} here now" for n in range(others)]
        rows = {r["doc_id"]: r["deleted"] for r in linedup.deleted_lines(frame(spark, texts)).collect()}
        assert len(rows.pop(1)) == 1 and rows == {n: [0, 1] for n in range(2, others + 2)}


def test_patience():
    def pairs(a, b):
        return linedup.patience([ord(c) for c in a], [ord(c) for c in b])

    assert pairs("abcd", "abcd") == [(i, i) for i in range(4)]
    assert pairs("xaby", "zabw") == [(1, 1), (2, 2)]
    assert pairs("abc", "cab") == [(0, 1), (1, 2)]
    assert pairs("", "a") == [] and pairs("aXa", "aYa") == [(0, 0), (2, 2)]
    assert linedup.longest_rising([3, 1, 2, 5, 4]) in ([1, 2, 4], [1, 2, 3])


def test_text_left(spark):
    long = "these are five whole words here"
    texts = [f"one\n{long}\ntwo", f"three\n  {long} \nfour", f"{long}\n \n", "\n".join([long, long]), "one\nnew"]
    docs = frame(spark, texts)
    deleted = linedup.deleted_lines(docs)
    left = {r["doc_id"]: r["text"] for r in linedup.without_lines(docs, deleted).collect()}
    assert left[0] == texts[0] and left[1] == "three\nfour" and left[4] == "one\nnew"
    assert 2 not in left
    kept = linedup.without_lines(docs, deleted, drop_emptied=False)
    assert kept.columns == docs.columns and kept.count() == len(texts)


def test_hub_and_copies(spark):
    shared = "a line that very many documents have in common"
    texts = [f"{shared}\nown words of number {i} follow here now" for i in range(120)] + ["one text only\nwith two lines of it"] * 60
    rows = {r["doc_id"]: r["deleted"] for r in linedup.deleted_lines(frame(spark, texts)).collect()}
    assert {i for i in rows if i < 120} == set(range(1, 120)) and all(rows[i] == [0] for i in range(1, 120))
    assert {i for i in rows if i >= 120} == set(range(121, 180)) and rows[150] == [0, 1]


def test_odd_rows(spark):
    docs = odd(spark)
    left = linedup.without_lines(docs, linedup.deleted_lines(docs), drop_emptied=False)
    assert left.columns == docs.columns and left.count() == docs.count()
    assert linedup.deleted_lines(docs.limit(0)).collect() == []
