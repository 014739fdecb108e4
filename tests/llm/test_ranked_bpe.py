import base64
import random

import numpy as np
import pytest

tiktoken = pytest.importorskip("tiktoken")
pytest.importorskip("regex")
from rows import frame, odd
from test_bpe import hard_texts

from platewright.llm import ranked_bpe
from platewright.llm.queries import ranked_digests, ranks_file, split_pattern


@pytest.fixture(scope="module")
def spec():
    return ranks_file(), split_pattern()


@pytest.fixture(scope="module")
def library(spec):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, spec[0].splitlines())}
    return tiktoken.Encoding("own", pat_str=spec[1], mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(spec):
    tokens = ranked_bpe.tokens_of(spec[0])
    return ranked_bpe.Encoder(tokens, spec[1], ranked_bpe.PerfectHash(tokens))


def encoded(encoder, texts):
    return [np.frombuffer(ids, "<i4").tolist() for ids in encoder.encode(texts)]


def test_equals_the_library(spark, spec, library):
    rng = random.Random(3)
    letters = ["".join(rng.choice("abcdeëоиñ漢") for _ in range(rng.randint(1, 90))) for _ in range(300)]
    texts = [None, "", *hard_texts(1), *letters, "x" * 30_000, "漢" * 5000, " " * 3000 + "a", "1 " * 5000, "abcab" * 4000]
    docs = frame(spark, texts)
    rows = ranked_bpe.round_trip(docs, *spec).orderBy("doc_id").collect()
    for text, row in zip(texts, rows):
        ids = library.encode_ordinary(text or "")
        assert row["ids"] == ids, text
        assert row["n_tokens"] == len(ids)
        assert bytes(row["decoded"]) == (text or "").encode() == library.decode_bytes(ids)
    apart = ranked_bpe.decode(ranked_bpe.encode(docs, *spec), spec[0]).orderBy("doc_id").collect()
    assert [(r["ids"], r["n_tokens"], r["decoded"]) for r in apart] == [(r["ids"], r["n_tokens"], r["decoded"]) for r in rows]


def test_every_character_is_split_as_in_the_library(encoder, library):
    texts = ["".join(f"a{chr(c)}1{chr(c)}!{chr(c)} " for c in range(low, low + 512) if not 0xD800 <= c < 0xE000)
             for low in range(0, 0x40000, 512)]
    texts.append("".join(map(chr, range(0xE0000, 0xE0200))))
    assert encoded(encoder, texts) == library.encode_ordinary_batch(texts, num_threads=4)


def test_perfect_hash_is_minimal_and_exact(encoder, spec):
    table, tokens = encoder.table, ranked_bpe.tokens_of(spec[0])
    assert sorted(table.ids.tolist()) == list(range(len(tokens)))
    data, lengths = np.frombuffer(b"".join(tokens), np.uint8), np.array(list(map(len, tokens)))
    assert table.find(data, lengths).tolist() == list(range(len(tokens)))
    known, rng = set(tokens), random.Random(5)
    others = [bytes(rng.choice(b"abcdefgh \xc3\xa9") for _ in range(rng.randint(1, 9))) for _ in range(20_000)]
    found = table.find(np.frombuffer(b"".join(others), np.uint8), np.array(list(map(len, others)))).tolist()
    assert all((tokens[i] == t) if i >= 0 else t not in known for i, t in zip(found, others))


def test_merging_equals_rescanning_all_pairs(encoder):
    def slow(piece):
        parts = [bytes([b]) for b in piece]
        while True:
            ranked = [(encoder.ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            if not ranked or min(ranked)[0] == 1 << 30:
                return [encoder.ranks[p] for p in parts]
            i = min(ranked)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(7)
    for _ in range(300):
        piece = "".join(rng.choice("aaeinrst é") for _ in range(rng.randint(1, 60))).encode()
        assert encoder.merged(piece) == slow(piece)


def test_blocks_of_a_long_text(encoder, library, monkeypatch):
    text = "".join(hard_texts(9, 200))
    monkeypatch.setattr(ranked_bpe, "BLOCK", 7)
    monkeypatch.setattr(ranked_bpe, "WHOLE_TEXT", 50)
    monkeypatch.setattr(ranked_bpe, "MEMO_PIECES", 10)
    texts = [text, "ab", "", None, text[:49], "x"]
    assert encoded(encoder, texts) == [library.encode_ordinary(t or "") for t in texts]


def test_odd_rows(spark, spec):
    docs = odd(spark)
    found = ranked_digests(docs, *spec)
    assert found.count() == docs.count()
    kept = ranked_bpe.encode(docs, *spec)
    assert kept.schema["ids"].dataType.simpleString() == "array<int>" and "fingerprint" in kept.columns
    assert ranked_digests(docs.limit(0), *spec).collect() == []


def test_digests(spark, spec, library):
    import hashlib

    texts = ["Ein Beispiel, ça va?", "", None]
    for text, row in zip(texts, ranked_digests(frame(spark, texts), *spec).orderBy("doc_id").collect()):
        ids = library.encode_ordinary(text or "")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
