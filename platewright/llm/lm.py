"""Scores of texts under a log-bilinear language model trained on the corpus.

The model predicts a word from the two before it: their vectors, each weighted by a
vector of its place, add up to a prediction, whose product with a word's own vector,
plus the word's bias, is the word's score. It knows the ``VOCABULARY`` most frequent
words; all others are one word to it, and share that word's probability in proportion
to their counts in the corpus. It is trained with noise-contrastive estimation over all
training tokens: each task goes through its own part and the results are averaged,
weighted by tokens, once per round. Scores are normalised: the sums over the vocabulary
for all pairs of preceding words are products of matrices, made once.

Words are runs without ASCII white space, A-Z in lower case, told apart by 64-bit
hashes; each text ends with a token of its own kind, which also stands for what precedes
its first word. Counts are over all training texts. The most frequent words' counts, a
number of fixed bound, go to the tasks; rarer ones are joined, and none of those is a hot
key.

Defined results: a null or empty text is the end token alone. A null id counts as an
empty text where ids decide what is held out. Repeated rows count and are scored each.
With nothing to learn from all words are unknown and equally likely.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewright.llm.arrow import parts_of, small_batches
from platewright.llm.words import SPACES, hashed, separator
from platewright.session import shared_folder

#: Words the model tells apart, the one for all others included; words counted in tasks.
VOCABULARY, HEAD = 1024, 1 << 16
WIDTH, NOISE, BATCH, RATE, ROUNDS = 16, 64, 1024, 0.3, 2
END = np.uint64(1)
SEPARATOR = separator(SPACES)
MERGE = 1 << 21
BLOCKS = 32


def tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Like ``hashed``, each text's words followed by the end token."""
    for low, high, words, starts in hashed(column, SEPARATOR):
        yield low, high, np.insert(words, starts[1:], END), starts + np.arange(len(starts))


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` (hash) and ``n`` over all texts of the one column of ``texts``."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        words, at = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
        return words, np.bincount(at, np.concatenate([n for _, n in parts]), len(words)).astype(np.int64)

    def count(batches):
        parts, size = [(np.empty(0, np.uint64), np.empty(0, np.int64))], 0
        for batch in batches:
            for _, _, words, _ in tokens(batch.column(0)):
                parts.append(np.unique(words, return_counts=True))
                size += len(parts[-1][0])
                if size > MERGE:
                    parts = [merged(parts)]
                    if len(parts[0][0]) > MERGE // 2:
                        yield batch_of(*parts[0])
                        parts = [(parts[0][0][:0], parts[0][1][:0])]
                    size = len(parts[0][0])
        yield batch_of(*merged(parts))

    def batch_of(words, n):
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

    return texts.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int = HEAD) -> list:
    """All words from some count on, as low a one as leaves ``most`` words at most.

    Counts are taken in steps of a sixteenth of an octave, so the driver sees a thousand
    rows and then the words, no candidates of each task.
    """
    step = F.floor(F.log2("n") * 16)
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()
    lowest, total = None, 0
    for row in sorted(sizes, key=lambda r: -r["step"]):
        total += row["words"]
        if total > most:
            break
        lowest = row["step"]
    return [] if lowest is None else counts.where(step >= lowest).collect()


class Head:
    """Frequent words and their counts; the first of them are the model's vocabulary."""

    def __init__(self, words: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        self.ids = np.where(order < VOCABULARY - 1, order + 1, 0).astype(np.uint16)
        self.slots = np.full(1 << 20, -1)
        place = (self.words >> np.uint64(44)).astype(np.int64)
        self.slots[place] = np.arange(len(words))
        self.shared = np.bincount(place, minlength=1 << 20) > 1

    def find(self, tokens_: np.ndarray) -> np.ndarray:
        """The number of each token among the words, -1 for others."""
        if not len(self.words):
            return np.full(len(tokens_), -1)
        place = (tokens_ >> np.uint64(44)).astype(np.int64)
        at = self.slots[place]
        at[(at >= 0) & (self.words[at] != tokens_) & ~self.shared[place]] = -1
        again = np.flatnonzero(self.shared[place])
        if len(again):
            found = np.minimum(np.searchsorted(self.words, tokens_[again]), len(self.words) - 1)
            at[again] = np.where(self.words[found] == tokens_[again], found, -1)
        return at


@dataclass
class Totals:
    """Training tokens, distinct ones, and both for the words that the model does not know."""

    tokens: int
    distinct: int
    other_tokens: int
    other_distinct: int

    def log_base(self) -> float:
        return math.log10(self.tokens + 0.5 * (self.distinct + 1))

    def log_other(self) -> float:
        return math.log10(self.other_tokens + 0.5 * (self.other_distinct + 1))


def encoded(rows: DataFrame, head, totals: Totals) -> DataFrame:
    """Of ``key``, ``doc_id``, ``held_out`` and ``text``: the model's ids of the tokens, the
    sums over words in the head, and the hashes of the others."""
    schema = rows.drop("text").schema.simpleString()[7:-1] + (
        ",ids:binary,n_tokens:long,n_other:long,known:long,base:double,base_other:double,tail:array<long>"
    )
    names = [c for c in rows.columns if c != "text"]
    log_base = totals.log_base()

    def encode(batches):
        table = Head(*head.value)
        logs = np.log10(table.counts + 0.5) - log_base
        for batch in batches:
            for low, high, words, starts in tokens(batch.column("text")):
                at = table.find(words)
                inside = at >= 0
                ids = np.zeros(len(words), np.uint16)
                ids[inside] = table.ids[at[inside]]
                base = np.zeros(len(words))
                base[inside] = logs[at[inside]]
                sums = lambda x: np.add.reduceat(x, starts[:-1])  # noqa: E731  every text has a token
                ends = sums((~inside).astype(np.int64)).cumsum()
                tail = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, ends].astype(np.int32)), pa.array(words[~inside].view(np.int64)))
                part = batch.slice(low, high - low)
                made = [
                    pa.array([ids[a:b].tobytes() for a, b in zip(starts, starts[1:])], pa.binary()),
                    pa.array(np.diff(starts)), pa.array(sums((ids == 0).astype(np.int64))),
                    pa.array(sums(inside.astype(np.int64))), pa.array(sums(base)),
                    pa.array(sums(np.where(ids == 0, base, 0.0))), tail,
                ]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in names], *made],
                    names=[*names, "ids", "n_tokens", "n_other", "known", "base", "base_other", "tail"],
                )

    return rows.mapInArrow(encode, schema)


class Model:
    """``words`` and ``context`` (a vector per word), ``places`` (two vectors) and ``bias``."""

    def __init__(self, counts: np.ndarray, flat: np.ndarray | None = None) -> None:
        rng = np.random.default_rng(0)
        size = len(counts)
        self.noise = (counts + 1.0) / (counts + 1.0).sum()
        self.words = rng.normal(0, 0.1, (size, WIDTH)).astype(np.float32)
        self.context = rng.normal(0, 0.1, (size, WIDTH)).astype(np.float32)
        self.places = np.ones((2, WIDTH), np.float32)
        self.bias = np.log(self.noise).astype(np.float32)
        if flat is not None:
            self.take(flat)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.reshape(-1) for x in (self.words, self.context, self.places, self.bias)])

    def take(self, flat: np.ndarray) -> None:
        at = 0
        for name in ("words", "context", "places", "bias"):
            x = getattr(self, name)
            setattr(self, name, flat[at : at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """The part of a word's score that comes from the last word and its bias, and from
        the one before it: a row per preceding word."""
        return (self.context * self.places[0]) @ self.words.T + self.bias, (self.context * self.places[1]) @ self.words.T


class Trainer:
    """Noise-contrastive estimation by gradient steps of adapted size (Adagrad)."""

    def __init__(self, model: Model, seed: int) -> None:
        self.m, self.rng = model, np.random.default_rng(seed)
        self.log_noise = np.log(NOISE * model.noise).astype(np.float32)
        self.cumulative = np.cumsum(model.noise)
        self.seen = {n: np.full_like(getattr(model, n), 0.1) for n in ("words", "context", "places", "bias")}
        self.tokens = 0

    def _step(self, name: str, gradient: np.ndarray) -> None:
        self.seen[name] += gradient * gradient
        getattr(self.m, name)[...] += RATE * gradient / np.sqrt(self.seen[name])

    def learn(self, word: np.ndarray, before: np.ndarray, second: np.ndarray) -> None:
        order = self.rng.permutation(len(word))
        for at in range(0, len(word), BATCH):
            part = order[at : at + BATCH]
            self._batch(word[part], before[part], second[part])
        self.tokens += len(word)

    def _batch(self, word, before, second) -> None:
        m, size, rows = self.m, len(word), len(self.m.bias)
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), rows - 1)
        c1, c2 = m.context[before], m.context[second]
        query = c1 * m.places[0] + c2 * m.places[1]
        own = m.words[word]
        s = (query * own).sum(axis=1) + m.bias[word] - self.log_noise[word]
        true = 1 / (1 + np.exp(np.clip(s, -30, 30)))
        s = query @ m.words[noise].T + (m.bias[noise] - self.log_noise[noise])
        false = -1 / (1 + np.exp(-np.clip(s, -30, 30)))
        d_query = true[:, None] * own + false @ m.words[noise]
        scale = np.float32(1 / math.sqrt(size))

        def by_word(at, values):
            return np.stack([np.bincount(at, values[:, d], rows) for d in range(WIDTH)], axis=1)

        g_words = by_word(word, true[:, None] * query)
        np.add.at(g_words, noise, false.T @ query)
        g_bias = np.bincount(word, true, rows)
        np.add.at(g_bias, noise, false.sum(axis=0))
        g_context = by_word(before, d_query * m.places[0]) + by_word(second, d_query * m.places[1])
        g_places = np.stack([(d_query * c1).sum(axis=0), (d_query * c2).sum(axis=0)])
        for name, g in (("words", g_words), ("context", g_context), ("places", g_places), ("bias", g_bias)):
            self._step(name, g.astype(np.float32) * scale)


def with_context(batch: pa.RecordBatch, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts' tokens, the one and the second before each, and the texts' starts."""
    ids = batch.column("ids").to_pylist()
    word = np.frombuffer(b"".join(ids), np.uint16).astype(np.int64)
    starts = np.cumsum([0, *[len(x) // 2 for x in ids]])
    before, second = np.r_[end, word[:-1]], np.r_[end, end, word[:-2]][: len(word)]
    first = starts[:-1]
    before[first] = end
    second[first] = end
    later = first + 1
    second[later[later < starts[1:]]] = end
    return word, before, second, starts


def trained(texts: DataFrame, counts: np.ndarray, end: int, rounds: int = ROUNDS) -> Model:
    """The model after each text of ``texts`` (``key`` and ``ids``) was learned from in one round."""
    spark = texts.sparkSession
    model = Model(counts)
    for n in range(rounds):
        start = spark.sparkContext.broadcast((counts, model.flat()))
        part = texts.where(F.pmod(F.xxhash64("key"), F.lit(rounds)) == n).select("ids")

        def learn(batches, start=start, n=n):
            from pyspark import TaskContext

            trainer = Trainer(Model(*start.value), 1000 * n + TaskContext.get().partitionId())
            for batch in (p for whole in batches for p in parts_of(whole)):
                trainer.learn(*with_context(batch, end)[:3])
            if trainer.tokens:
                weighted = trainer.m.flat().astype(np.float64) * trainer.tokens
                yield blocks({k: x for k, x in enumerate(np.array_split(weighted, BLOCKS))}, trainer.tokens)

        def blocks(sums: dict[int, np.ndarray], weight: int | dict):
            weights = [weight if isinstance(weight, int) else weight[k] for k in sums]
            return pa.RecordBatch.from_arrays(
                [pa.array([*sums], pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary()),
                 pa.array(weights, pa.int64())], names=["block", "sums", "weight"])

        def add(batches):
            sums, weight = {}, {}
            for batch in batches:
                for k, x, w in zip(*[c.to_pylist() for c in batch.columns]):
                    sums[k] = sums.get(k, 0) + np.frombuffer(x)
                    weight[k] = weight.get(k, 0) + w
            if sums:
                yield blocks(sums, weight)

        schema = "block int, sums binary, weight long"
        learned = part.mapInArrow(learn, schema).repartition(BLOCKS, "block").mapInArrow(add, schema).collect()
        if learned:
            model.take(np.concatenate([np.frombuffer(r["sums"]) / r["weight"] for r in sorted(learned, key=lambda r: r["block"])]))
    return model


def log_sums(spark, model: Model) -> np.ndarray:
    """The logarithm of the sum over all words, for each pair of preceding words."""
    size = len(model.bias)
    shared = spark.sparkContext.broadcast(model.tables())

    def rows(batches):
        last, second = shared.value
        for batch in batches:
            for c in batch.column(0).to_pylist():
                s = second + last[c]
                top = s.max(axis=1, keepdims=True)
                z = (top[:, 0] + np.log(np.exp(s - top).sum(axis=1))).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([c]), pa.array([z.tobytes()], pa.binary())], names=["c", "z"])

    found = spark.range(0, size, 1, 32).mapInArrow(rows, "c long, z binary").collect()
    return np.stack([np.frombuffer(r["z"], np.float32) for r in sorted(found, key=lambda r: r["c"])])


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: Column | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (by
    counts alone) and ``score`` (the model's log10 probability of the text)."""
    spark = docs.sparkSession
    shared_folder(spark)
    if held_out is None:
        held_out = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 1
    rows = small_batches(docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text")))
    counts = word_counts(rows.where("NOT held_out").select("text")).checkpoint()
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = sorted(frequent(counts), key=lambda r: (-r["n"], r["word"]))
    words = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    n = np.array([r["n"] for r in top], np.int64)
    own = n[: VOCABULARY - 1]
    totals = Totals(whole["n"], whole["v"], whole["n"] - int(own.sum()), whole["v"] - len(own))
    at = np.flatnonzero(words[: VOCABULARY - 1] == END)
    end = int(at[0]) + 1 if len(at) else 0

    head = spark.sparkContext.broadcast((words, n))
    keyed = rows.select(F.monotonically_increasing_id().alias("key"), "*")
    texts = encoded(keyed, head, totals).checkpoint()
    model = trained(texts.where("NOT held_out"), np.r_[totals.other_tokens, own].astype(float), end)
    first, second = model.tables()
    shared = spark.sparkContext.broadcast((first, second, log_sums(spark, model), end))

    def score(batches):
        last, second, z, end = shared.value
        for batch in (p for whole in batches for p in parts_of(whole)):
            word, c1, c2, starts = with_context(batch, end)
            logs = (last[c1, word] + second[c2, word] - z[c1, c2]).astype(np.float64)
            sums = pa.array(np.add.reduceat(logs, starts[:-1]) / math.log(10))
            yield pa.RecordBatch.from_arrays([batch.column("key"), sums], names=["key", "log_model"])

    names = ["key", "doc_id", "held_out", "n_tokens", "n_other", "known", "base", "base_other"]
    log_base, shift = totals.log_base(), totals.log_base() - totals.log_other()
    rare = texts.select("key", F.explode("tail").alias("word")).join(counts, "word", "left").groupBy("key").agg(
        F.count("n").alias("rare_known"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5) - log_base).alias("rare_base"))
    done = texts.select(*names).join(texts.select("key", "ids").mapInArrow(score, "key long, log_model double"), "key")
    done = done.join(rare, "key", "left").na.fill(0, ["rare_known", "rare_base"])
    return done.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.col("rare_known")).alias("n_known"),
        F.lit(totals.tokens).cast("long").alias("train_tokens"), (F.col("base") + F.col("rare_base")).alias("base_score"),
        (F.col("log_model") + F.col("base_other") + F.col("rare_base") + F.col("n_other") * shift).alias("score"),
    )
