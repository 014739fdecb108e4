import random
import re
import zlib
from collections import Counter

import pytest
from rows import frame, odd

from platewright.llm import variants
from platewright.llm.queries import op13_spelling_variants, variant_groups, words_with_slips

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def near_by_comparing(words):
    return {w: [v for v in words if one_edit(w, v)] for w in words}


def near_by_edits(words):
    """The same from all edits of all words, for larger tables."""
    letters = sorted(set("".join(words)))
    near = {}
    for w in words:
        cuts = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        edits = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in letters}
        edits |= {a + c + b[1:] for a, b in cuts if b for c in letters}
        near[w] = [v for v in edits if v != w and v in words]
    return near


def expected(counts, near, ratio=10):
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= max(ratio * counts[w], counts[w] + 1) else None

    def root(w):
        while forms[w] is not None:
            w = forms[w]
        return w

    return {w: (w, forms[w], root(w), n, len(near[w]), counts[forms[w]] if forms[w] is not None else None)
            for w, n in counts.items()}


def found(df):
    rows = df.select(*COLUMNS).collect()
    assert len(rows) == len({r["word"] for r in rows})
    return {r["word"]: tuple(r) for r in rows}


def vocabulary(rng, letters, n):
    words = set()
    while len(words) < n:
        word = "".join(rng.choice(letters) for _ in range(rng.randint(0, 9)))
        words.add(word)
        for _ in range(rng.randint(0, 3)):
            i = rng.randint(0, len(word))
            word = word[:i] + rng.choice([rng.choice(letters), ""]) + word[i + rng.randint(0, 1) :]
            words.add(word)
    return {w: rng.choice([0, 1, 2, 2, 10, 20, 25, 100, 1000, 12345]) for w in words}


@pytest.mark.parametrize("letters,parts", [("ab", 4), ("abcdeéÿ", 4), ("abc", 37), ("xyz漢😀", 3)])
def test_equals_comparing_all_words(spark, letters, parts):
    """With few and with more ranges than tasks: words on either side of a border share nodes."""
    counts = vocabulary(random.Random(len(letters) + parts), letters, 400)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        words = spark.createDataFrame(list(counts.items()), "word string, n long")
        assert found(variants.variants(words)) == expected(counts, near_by_comparing(counts))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_numbers_are_those_of_nodes(spark):
    """Every number stands for one beginning, and every shared beginning has one number."""
    rng = random.Random(8)
    words = sorted(vocabulary(rng, "abcd", 500))
    firsts = sorted({words[0], *rng.sample(words, 12)})
    nodes_of = variants.first_nodes(firsts)
    number, ranks = {}, []
    for low, high in zip(firsts, [*firsts[1:], "~"]):
        part = ((w,) for w in words if low <= w < high)
        for (word,), rank, nodes in variants.numbered(part, firsts, nodes_of):
            ranks.append(rank)
            for i, node in enumerate(nodes):
                assert number.setdefault(word[:i], node) == node
            shared = max((variants.common(word, w) for w in words if w != word), default=0)
            assert len(nodes) > shared
    assert len(set(number.values())) == len(number) and ranks == sorted(set(ranks))


def test_long_words_and_chains(spark):
    long = "lang" * 20_000
    counts = {long: 100, long + "x": 5, long[:-1] + "z": 10, "b" + long[1:]: 1000, "a" * 5000: 3, "a" * 5001: 30,
              "chain": 1, "chains": 10, "chainsa": 100, "chainsab": 1000, "tie": 1, "tia": 50, "tib": 50, "": 4, "q": 40}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = found(variants.variants(words))
    assert rows["chain"] == ("chain", "chains", "chainsab", 1, 1, 10)
    assert rows["tie"][1] == "tia" and rows[""] == ("", "q", "q", 4, 1, 40)
    assert rows["a" * 5000][1] == "a" * 5001
    assert rows[long + "x"][1:3] == (long, "b" + long[1:]) and rows[long][4] == 3


def test_repeated_and_null_words(spark):
    rows = [("word", 2), ("word", 3), (None, 9), ("ward", None), ("wards", 50)]
    words = spark.createDataFrame(rows, "word string, n long").withColumnRenamed("n", "count")
    assert found(variants.variants(words.selectExpr("*", "7 AS n", "8 AS rank", "9 AS head"), n="count")) == {
        "word": ("word", None, "word", 5, 1, None), "ward": ("ward", "wards", "wards", 0, 2, 50),
        "wards": ("wards", None, "wards", 50, 1, None)}


def slips(texts):
    """Words and counts as the query takes them."""
    counts = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def test_query_equals_brute_force(spark):
    rng = random.Random(3)
    words = ["Straßenbahn", "ÄHNLICH", "Überall", "elephant", "elephants", "Eléphant", "ab", "abcdefgh", "mississippi", "x" * 300]
    texts = [(i, " ".join(rng.choice(words) + rng.choice(["", ".", "x", "é×÷"]) for _ in range(60))) for i in range(60)]
    docs = frame(spark, [t for _, t in texts])
    counts = slips(texts)
    assert found(words_with_slips(docs).selectExpr("word", *[f"NULL AS {c}" for c in COLUMNS[1:3]], "n", "0 AS n_near", "0 AS form_n")
                 ).keys() == counts.keys()
    result = variant_groups(docs)
    assert result.columns == COLUMNS
    assert found(result) == expected(counts, near_by_comparing(counts))


def test_query_on_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    counts = slips(map(tuple, docs))
    got = found(op13_spelling_variants(spark, sf_dir))
    assert got == expected(counts, near_by_edits(counts))
    assert len(got) > 1000 and any(r[1] for r in got.values())


def test_odd_rows(spark):
    docs = odd(spark)
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    counts = slips(texts)
    assert found(variant_groups(docs)) == expected(counts, near_by_comparing(counts))
    assert variant_groups(docs.limit(0)).collect() == []
    assert variant_groups(docs.limit(0)).columns == COLUMNS
