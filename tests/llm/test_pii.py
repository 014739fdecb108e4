import random
import re

import pytest
from rows import frame, odd

from platewright.llm import pii

PLAIN = [
    re.compile(p) for p in (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    )
]


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = [
        (m.start(), n, m.end(), kind)
        for n, kind in enumerate(pii.KINDS) for m in PLAIN[n].finditer(text or "") if passes(kind, m.group())
    ]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def hard_texts(seed, n=1500):
    rng = random.Random(seed)
    alphabets = ["ab1234567890   --..@@++()é😀\n%_", "0123456789 -.+@a", "0123456789 -"]
    texts = ["".join(rng.choice(alphabets[i % 3]) for _ in range(rng.randint(0, 90))) for i in range(n)]
    return [*texts, "4111 1111-1111 1111 x 4111111111111111 +1 (743) 555-3824 a@b.c_d@e.f 1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4",
            "😀é a@b.co 10.0.0.1", None, ""]


def test_spans_are_those_of_the_plain_patterns(spark):
    texts = hard_texts(1)
    rows = pii.with_spans(frame(spark, texts), "text").select("doc_id", pii.joined().alias("found")).collect()
    assert {r["doc_id"]: r["found"] for r in rows} == {i: brute(t) for i, t in enumerate(texts)}
    assert sum(bool(r["found"]) for r in rows) > 100


def test_long_texts(spark):
    texts = ["1" * 50_000, "a." * 20_000 + "@b" + ".c" * 20_000, "1 " * 30_000, "1." * 30_000, "+1" + "(" * 50_000, "@" * 50_000]
    rows = pii.with_spans(frame(spark, texts), "text").orderBy("doc_id").select(pii.joined().alias("found")).collect()
    assert [r["found"] for r in rows] == [brute(t) if i != 1 else "email:0:80002" for i, t in enumerate(texts)]


def corpus():
    rng = random.Random(2)

    def filler(n):
        return " ".join(f"w{rng.randrange(400)}x" for _ in range(n))

    texts = [f"{filler(9)} Zorblax {filler(8)} joe@x.org {filler(6)}" for _ in range(6)]
    texts += [f"{filler(20)}\n{filler(5)}" for _ in range(200)]
    texts += ["one line about quimby and amy@y.org only"] * 8  # copies of one line reveal nothing
    return [*texts, f"zorblax {filler(10)}"]


def test_terms_that_reveal_an_entity(spark):
    rows = pii.find(frame(spark, corpus())).orderBy("doc_id").collect()
    terms = [[s["value"] for s in r["spans"] if s["kind"] == "term"] for r in rows]
    assert terms[:6] == [["Zorblax"]] * 6
    assert not any(terms[6:])
    for text, row in zip(corpus(), rows):
        assert all(text[s["start"] : s["stop"]] == s["value"] for s in row["spans"])


@pytest.mark.parametrize("texts", [True, False])
def test_terms_everywhere(spark, texts):
    """A term is also marked where its entity is not, in any case, and in repeated rows and without an id."""
    more = ["Who is Zorblax? zorblax, ZORBLAX", "call zorblax at a@b.co", "zorblax again", "zorblax again", "zorblaxes"]
    docs = [*corpus(), *more]
    ids = [*range(len(docs) - 3), None, None, 999]
    rows = pii.find(frame(spark, docs, ids), texts=texts, everywhere=True).collect()
    found = sorted((-1 if r["doc_id"] is None else r["doc_id"], s["start"], s["value"])
                   for r in rows for s in r["spans"] if s["kind"] == "term")
    plain = sorted((-1 if i is None else i, m.start(), m.group())
                   for i, t in zip(ids, docs) for m in re.finditer(r"(?i)\bzorblax\b", t))
    assert found == plain and len(rows) == len(docs) and len(found) == 13


def test_words_of_the_address_beside_it(spark):
    """Are terms as any others, also where other lines have the address alone; within it they are none."""
    rng = random.Random(4)

    def filler():
        return " ".join(f"w{rng.randrange(10**6)}x" for _ in range(8))

    texts = [f"{filler()} Smith of Acme {filler()} smith@acme.org {filler()}" for _ in range(5)]
    texts += [f"{filler()} smith@acme.org {filler()}" for _ in range(2)]
    texts += [f"{filler()} acme.smith@else{n}.org {filler()}" for n in range(40)]
    texts += [f"{filler()} mail hannah@mail.org" for _ in range(4)] + [f"mail {filler()}" for _ in range(90)]
    texts += ["é 😀 +41 79 555.55.55.55 001 Smith a@b.c_d@e.f"] + [filler() for _ in range(400)]
    rows = pii.find(frame(spark, texts), everywhere=True).orderBy("doc_id").collect()
    terms = [[(s["value"], s["start"]) for s in r["spans"] if s["kind"] == "term"] for r in rows]
    plain = [[(m.group(), m.start()) for m in re.finditer("Smith|Acme", t)] for t in texts]
    assert terms == plain and sum(map(len, terms)) == 11


def test_different_lines_count_whatever_words_they_share(spark):
    """Three lines for each of many entities, that have the entity's parts and the term in common."""
    rng = random.Random(3)
    texts = [
        " ".join([*(f"w{rng.randrange(10**6)}x" for _ in range(10)), f"Term{n}x", f"joe{n}@x{n}.org"])
        for n in range(60) for _ in range(3)
    ]
    texts += [f"w{rng.randrange(10**6)}x" for _ in range(400)]
    # The same line but for case and the way the entity is written is one.
    texts += ["Quimby wrote this line AMY@y.org", "Quimby wrote this line amy@y.org", "quimby wrote this line amy@y.org"]
    rows = pii.find(frame(spark, texts)).orderBy("doc_id").collect()
    terms = [[s["value"] for s in r["spans"] if s["kind"] == "term"] for r in rows]
    assert terms == [[f"Term{n // 3}x"] if n < 180 else [] for n in range(len(texts))]


def test_sanitised(spark):
    found = pii.find(frame(spark, corpus()))
    texts = [r["text"] for r in pii.sanitised(found).orderBy("doc_id").collect()]
    assert all("[EMAIL]" in t and "joe" not in t and "Zorblax" not in t for t in texts[:6])
    assert texts[10] == corpus()[10]
    nested = pii.sanitised(pii.with_spans(frame(spark, ["x +41111111111111 y", None]), "text")).orderBy("doc_id").collect()
    assert nested[0]["text"] == "x [PHONE] y" and nested[1]["text"] is None


def test_no_python_in_the_plan(spark):
    plan = pii.find(frame(spark, corpus()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(spark):
    docs = odd(spark)
    assert pii.find(docs).count() == docs.count()
    assert pii.find(docs.limit(0)).collect() == []


@pytest.mark.parametrize("same", [True, False])
def test_repeated_ids(spark, same):
    lines = corpus()[:6]
    rest = corpus()[6:206]
    ids = [1, 2, None, 4, 5, 6] * 2 if same else [7] * 12
    docs = frame(spark, [*lines, *lines, *rest], [*ids, *range(100, 300)])
    rows = [r for r in pii.find(docs, texts=False).collect() if r["spans"]]
    assert len(rows) == 12 and all(any(s["kind"] == "term" for s in r["spans"]) for r in rows)
