"""Document quality by weak supervision.

Rules vote good (1) or bad (-1) on a document, or abstain (0). Expectation
maximisation over the vote patterns of the documents that pass the base rules estimates how often each rule casts each vote
on good and on bad documents, and so the posterior probability that a document is
good. The patterns are counted by one aggregation; there are 3 to the power of the
number of rules at most, however many documents there are, so the estimation works
on a table of bounded size. Everything per document is built-in functions within
its own row: no document is sent anywhere but for the counts.

Words are runs of characters other than ASCII white space.

Defined results: a null or empty text has no words, all counts are 0, and it fails
the base rules. Repeated rows are judged alike and each counts. An empty table gives
an empty result (the estimates are the starting values). Other columns are kept; a
column with the name of an added one is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: name: (bad, good), of the measures below; neither is an abstention.
RULES = {
    "word_length": ("word_chars < 2 * n_words OR word_chars > 14 * n_words",
                    "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    "symbols": ("10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    "marks": ("2 * n_marks > n_words", "10 * n_marks <= 3 * n_words"),
    "capitals": ("10 * n_capitals > 3 * word_chars", "20 * n_capitals <= 3 * word_chars"),
    "lines": ("2 * n_dup_lines > n_lines", "20 * n_dup_lines <= n_lines"),
    "repeats": ("100 * n_repeat_words > 30 * n_words", "100 * n_repeat_words <= 15 * n_words"),
    "variety": ("5 * n_distinct_words < n_words AND n_words < 1000", "5 * n_distinct_words >= 2 * n_words"),
}
#: Starting share of bad documents, and of the votes (bad, none, good) by class; they also
#: count as so large a part of the documents, which keeps the estimates apart where data say little.
BAD_SHARE, ON_GOOD, ON_BAD, PRIOR_PART = 0.15, (0.01, 0.14, 0.85), (0.45, 0.20, 0.35), 0.02
ROUNDS, TOLERANCE = 100, 1e-7


MEASURES = {
    "n_words": "cast(size(_words) as bigint)",
    "word_chars": "cast(length(array_join(_words, '')) as bigint)",
    "n_symbols": "cast(regexp_count(_text, '[#*$%&|<>]') as bigint)",
    "n_marks": r"cast(regexp_count(_text, '[!?#*$%&|<>=\\[\\]{}~^_\\\\]') as bigint)",
    "n_capitals": r"cast(regexp_count(_text, '\\p{Lu}') as bigint)",
    "n_lines": "cast(size(_lines) as bigint)",
    "n_dup_lines": "cast(size(_lines) - size(array_distinct(_lines)) as bigint)",
    "n_distinct_words": "cast(size(array_distinct(_words)) as bigint)",
}


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts that the rules use, all long.

    Each step is a select of its own, since a lambda would evaluate a step that
    is written into it anew for each element.
    """
    own = {*MEASURES, "n_repeat_words", "_text", "_words", "_lines", "_windows", "_twice"}
    keep = [f"`{c}`" for c in docs.columns if c.lower() not in own]
    counts = [*MEASURES]
    return (
        docs.selectExpr(*keep, f"coalesce(`{text}`, '') AS _text")
        .selectExpr(
            "*",
            r"regexp_extract_all(_text, '[^\\x20\\x09-\\x0D]+', 0) AS _words",
            r"filter(split(_text, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]') AS _lines",
        )
        .selectExpr(
            *keep, *[f"{e} AS {n}" for n, e in MEASURES.items()],
            # Windows of three words as (hash, place), sorted: equal ones are neighbours.
            "CASE WHEN size(_words) < 3 THEN cast(array() as array<struct<h: bigint, i: int>>) ELSE"
            " sort_array(transform(sequence(0, size(_words) - 3), i -> named_struct("
            "'h', xxhash64(_words[i], _words[i + 1], _words[i + 2]), 'i', i))) END AS _windows",
        )
        .selectExpr(
            *keep, *counts,
            "sort_array(transform(filter(_windows, (x, j) ->"
            " get(_windows, j - 1).h <=> x.h OR get(_windows, j + 1).h <=> x.h), x -> x.i)) AS _twice",
        )
        .selectExpr(
            *keep, *counts,
            # A window covers its three words, or those up to the next window.
            "cast(aggregate(zip_with(_twice, slice(_twice, 2, size(_twice)),"
            " (a, b) -> least(3, coalesce(b - a, 3))), 0, (s, x) -> s + x) as bigint) AS n_repeat_words",
        )
    )


def with_votes(measured: DataFrame, rules: dict[str, tuple[str, str]] = RULES) -> DataFrame:
    votes = [
        F.expr(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END").cast("tinyint") for bad, good in rules.values()
    ]
    return measured.withColumn("votes", F.array(*votes))


def estimate(patterns: list[tuple[list[int], int]], n_rules: int) -> tuple[float, list[dict[int, float]]]:
    """The log odds of a good document, and what each vote of each rule adds to them.

    ``patterns`` are the distinct votes with their number of documents.
    """
    total = sum(n for _, n in patterns)
    prior = max(1.0, PRIOR_PART * total)
    bad_share = BAD_SHARE
    on = [[dict(zip((-1, 0, 1), p)) for _ in range(n_rules)] for p in (ON_BAD, ON_GOOD)]
    odds, adds = 0.0, []
    for _ in range(ROUNDS):
        before = odds
        odds = math.log((1 - bad_share) / bad_share)
        adds = [{v: math.log(on[1][j][v] / on[0][j][v]) for v in (-1, 0, 1)} for j in range(n_rules)]
        sums = [[dict.fromkeys((-1, 0, 1), 0.0) for _ in range(n_rules)] for _ in (0, 1)]
        mass = [0.0, 0.0]
        for votes, n in patterns:
            good = posterior(odds + sum(adds[j][v] for j, v in enumerate(votes)))
            for y, w in ((0, n * (1 - good)), (1, n * good)):
                mass[y] += w
                for j, v in enumerate(votes):
                    sums[y][j][v] += w
        bad_share = (mass[0] + prior * BAD_SHARE) / (total + prior)
        for y, start in ((0, ON_BAD), (1, ON_GOOD)):
            for j in range(n_rules):
                for v, p in zip((-1, 0, 1), start):
                    on[y][j][v] = (sums[y][j][v] + prior * p) / (mass[y] + prior)
        if abs(odds - before) < TOLERANCE:
            break
    # A rule that objects never speaks for a document.
    adds = [{v: min(a, 0.0) if v < 0 else a for v, a in add.items()} for add in adds]
    return odds, adds


def posterior(log_odds: float) -> float:
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, log_odds))))


def with_quality(measured: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Adds ``votes``, ``quality`` (the posterior probability of a good document),
    ``base_failed`` and ``kept`` to documents with measures.

    ``measured`` is read twice, for the counts and for the result: give it
    checkpointed where it is small without the texts.
    """
    voted = with_votes(measured).withColumn("base_failed", F.expr(
        f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"))
    # No filter before the aggregation, see ``keep_good``.
    counts = voted.groupBy("base_failed", "votes").agg(F.count("*").alias("n")).collect()
    odds, adds = estimate(sorted((list(r["votes"]), r["n"]) for r in counts if not r["base_failed"]), len(RULES))
    terms = F.lit(odds)
    for j, add in enumerate(adds):
        vote = F.col("votes")[j]
        terms = terms + F.when(vote < 0, F.lit(add[-1])).when(vote > 0, F.lit(add[1])).otherwise(F.lit(add[0]))
    return (
        voted.withColumn("quality", 1 / (1 + F.exp(-terms)))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
    )


def keep_good(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns as they are."""
    packed = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    measured = with_measures(packed).drop("text")
    # A column that depends on the place of the row keeps the filter above the measures: moved
    # below them it would repeat their expressions for every rule that uses them.
    measured = measured.withColumn("_place", F.monotonically_increasing_id())
    return with_quality(measured, threshold).where("kept AND _place >= 0").select("row.*")
