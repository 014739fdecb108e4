import random

import numpy as np
import pytest

pytest.importorskip("tokenizers")
from rows import frame, odd

from platewright.llm import bpe
from platewright.llm.queries import bpe_digests, tokenizer_json


@pytest.fixture(scope="module")
def spec():
    return tokenizer_json()


@pytest.fixture(scope="module")
def library(spec):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(spec)


def hard_texts(seed, n=400):
    rng = random.Random(seed)
    bits = ["'s", "'", "''", "n't", " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", " ", "　", " ", "\x85", "\x1c", "é",
            "é", "ß", "漢字", "😀", "👩‍👩", "1", "12", "²", "٣", "the", "The", "qx", "zq", "_", "-", "!", "¥", "<|endoftext|>",
            "<|", "|>", "a", "Z", "\x00", "ÿ", "'ll", "'LL", "﻿"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_equals_the_library(spark, spec, library):
    texts = [None, "", *hard_texts(1), "x" * 30_000, "漢" * 5000, " " * 3000 + "a", "1 " * 5000]
    rows = bpe.round_trip(frame(spark, texts), spec).orderBy("doc_id").collect()
    apart = bpe.decode(bpe.encode(frame(spark, texts), spec), spec).orderBy("doc_id").collect()
    assert [(r["ids"], r["n_tokens"], r["decoded"]) for r in rows] == [(r["ids"], r["n_tokens"], r["decoded"]) for r in apart]
    for text, row in zip(texts, rows):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids, text
        assert row["n_tokens"] == len(ids)
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False) == (text or "")


def test_cuts_are_never_inside_a_token(spec):
    cut = bpe.cut_table(spec).reshape(256, 256)
    for token in bpe.token_bytes(spec)[:50256]:
        assert not any(cut[a, b] for a, b in zip(token, token[1:]))
    assert cut[ord("e"), ord(" ")] and not cut[ord(" "), ord("e")] and not cut[:, ord("'")].any()


def test_memory_of_fragments_is_bounded(spec, monkeypatch, library):
    monkeypatch.setattr(bpe, "MEMO_FRAGMENTS", 10)
    encoder = bpe.Encoder(spec, bpe.cut_table(spec))
    for text in hard_texts(2, 100):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(encoder.memo) < 100


def test_odd_rows(spark, spec):
    docs = odd(spark)
    found = bpe_digests(docs, spec)
    assert found.count() == docs.count()
    encoded = bpe.encode(docs, spec)
    assert encoded.schema["ids"].dataType.typeName() == "binary" and "fingerprint" in encoded.columns
    assert bpe_digests(docs.limit(0), spec).collect() == []
