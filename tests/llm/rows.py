"""Small made-up tables for the training-data operators."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int, size: int = 3000) -> list[str]:
    return [f"w{int(size * rng.random() ** 2)}x" for _ in range(n)]


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


#: Texts that any operator must stand.
ODD = [None, "", " \n\t\r ", "one", "one", "\n\n\n", "x" * 50_000, "word " * 20_000, "é😀    ü", "a\x00b", "#$%& | <>"]


def odd(spark):
    """Odd texts, repeated rows, null ids and columns whose names operators use."""
    from pyspark.sql import functions as F

    ids = [*range(len(ODD)), 3, None, None]
    docs = frame(spark, [*ODD, "one", "no id", None], ids)
    names = ["fingerprint", "component_id", "ids", "n_tokens", "deleted", "lines", "units", "quality", "votes", "kept",
             "n_words", "spans", "row", "key", "a", "b", "h", "score", "shard", "slot", "held_out", "_text", "left"]
    return docs.withColumns({n: F.lit(7) for n in names})
