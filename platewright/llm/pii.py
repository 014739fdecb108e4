r"""Personal data and the terms that give it away.

Four kinds are found by patterns: e-mail addresses, IP addresses, card numbers (with
their check digit) and phone numbers. They are the protected entities. How strongly a
term reveals an entity is estimated from the corpus: over lines, the pointwise
mutual information of term and entity as a part of the entity's information content,
1 for a term that is only ever found with the entity. Terms are words beside the base spans,
and may also be parts of the entity. Those over the disclosure threshold,
seen with the entity in enough different lines, are spans of kind ``term`` in the documents
that have the entity or, if asked for, wherever they stand. Sanitising generalises spans to
their kind and removes terms.

All of it is built-in functions. Spans are counted in code points, end exclusive.
Patterns are possessive and bound at the start of a run, which finds the same matches
as the plain patterns but in time linear in the text.

Defined results: null and empty texts have no spans. Documents are told apart by id and
text, so repeated rows give a row each and a null id is an id like any other. Without an
entity in enough lines there are no terms. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewright.operators.joins import is_small
from platewright.session import shared_folder

KINDS = ["email", "ip", "card", "phone"]
#: The pattern of each kind, and characters without which there is no match.
PATTERNS = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains({}, '@')"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "contains({}, '.')"),
    "card": (r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])", "true"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "contains({}, '+')"),
}
#: Lines that a term and an entity need together, different in more than the entity and
#: case; the part of an entity's information that a term may give; letters of a term.
MIN_LINES, DISCLOSURE, TERM_LETTERS = 3, 0.8, 3
#: Tables up to so many bytes are sent to all tasks.
MAX_TERM_BYTES = 16 << 20
KEY = ["doc_id", "_h"]
WORD = r"[\p{L}\p{N}]+(?:['-][\p{L}\p{N}]+)*"
_SPAN = "struct<start: int, rank: int, stop: int, kind: string, value: string>"


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _valid(kind: str, value: str) -> str:
    digits = f"regexp_replace({value}, '[^0-9]', '')"
    if kind == "ip":
        return (f"forall(split({value}, '[.]'), p -> length(ltrim('0', p)) < 3"
                f" OR length(ltrim('0', p)) = 3 AND ltrim('0', p) <= '255')")
    if kind == "card":
        # Luhn: every second digit from the right is doubled, and its own digits added.
        return (
            f"aggregate(transform(sequence(1, length({digits})), i -> cast(substring({digits}, -i, 1) as int) * (2 - i % 2)),"
            " 0, (t, d) -> t + CASE WHEN d > 9 THEN d - 9 ELSE d END) % 10 = 0"
        )
    if kind == "phone":
        return f"length({digits}) BETWEEN 10 AND 15"
    return "true"


def _placed(pieces: str, matches: str, keep: str, rank: int, kind: str) -> str:
    """Spans of the matches, from what stands between them and themselves."""
    return (
        f"aggregate(zip_with(slice({pieces}, 1, size({matches})), {matches},"
        " (p, m) -> named_struct('before', length(p), 'm', m)),"
        f" named_struct('at', 0, 'out', cast(array() as array<{_SPAN}>)),"
        f" (s, x) -> named_struct('at', s.at + x.before + length(x.m), 'out', CASE WHEN {keep}"
        " THEN concat(s.out, array(named_struct('start', s.at + x.before,"
        f" 'rank', {rank}, 'stop', s.at + x.before + length(x.m), 'kind', '{kind}', 'value', x.m)))"
        " ELSE s.out END), s -> s.out)"
    )


def with_spans(rows: DataFrame, text: str, spans: str = "spans") -> DataFrame:
    """Adds the base spans of ``text``, by start and then by kind."""
    keep = [f"`{c}`" for c in rows.columns if c != spans]
    none = f"cast(array() as array<{_SPAN}>)"
    rows = rows.selectExpr(*keep, f"coalesce(`{text}`, '') AS _t")
    rows = rows.selectExpr("*", *[
        f"CASE WHEN {when.format('_t')} THEN regexp_extract_all(_t, {_literal(pattern)}, 0) END AS _m_{kind}"
        for kind, (pattern, when) in PATTERNS.items()
    ])
    rows = rows.selectExpr(*keep, *[f"_m_{kind}" for kind in KINDS], *[
        f"CASE WHEN size(_m_{kind}) > 0 THEN split(_t, {_literal(pattern)}, -1) END AS _p_{kind}"
        for kind, (pattern, _) in PATTERNS.items()
    ])
    every = [
        f"CASE WHEN size(_m_{kind}) > 0 THEN {_placed(f'_p_{kind}', f'_m_{kind}', _valid(kind, 'x.m'), rank, kind)}"
        f" ELSE {none} END" for rank, kind in enumerate(KINDS)
    ]
    return rows.selectExpr(*keep, f"sort_array(concat({', '.join(every)})) AS `{spans}`")


def joined(spans: str = "spans") -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')")


def _cut(spans: str, text: str, put: str, more: str = "''") -> str:
    """``text`` with ``put`` for each span ``x``. A span that begins within an earlier one is
    part of it, and has ``more`` for what is beyond that (from ``s.at`` on)."""
    return (
        f"aggregate({spans}, named_struct('at', 0, 'out', ''), (s, x) -> CASE WHEN x.start < s.at THEN"
        f" named_struct('at', greatest(s.at, x.stop), 'out', concat(s.out, {more}))"
        f" ELSE named_struct('at', x.stop, 'out', concat(s.out, substring({text}, s.at + 1, x.start - s.at), {put})) END,"
        f" s -> concat(s.out, substring({text}, s.at + 1)))"
    )


def _words(line: str) -> str:
    return f"regexp_extract_all(lower({line}), {_literal(WORD)}, 0)"


def disclosing_terms(docs: DataFrame, found: DataFrame, min_lines: int = MIN_LINES,
                     disclosure: float = DISCLOSURE) -> DataFrame:
    """``entity``, ``term`` and ``part`` (of the entity's information that the term gives).

    ``docs`` has ``text``; ``found`` also ``spans`` and ``n_lines``, its texts are needed
    where there are spans.
    """
    lines = found.where("size(spans) > 0").select(F.explode(F.split("text", "\n")).alias("line"))
    lines = with_spans(lines.groupBy("line").agg(F.count("*").alias("copies")), "line").where("size(spans) > 0")
    lines = lines.withColumn("beside", F.expr(_cut("spans", "line", "' '")))
    lines = lines.selectExpr("copies", "line", "spans", f"array_distinct({_words('line')}) AS within",
                             f"array_distinct({_words('beside')}) AS words").checkpoint()
    pairs = lines.selectExpr("copies", "line", "words",
                             "explode(array_distinct(transform(spans, s -> lower(s.value)))) AS entity")
    pairs = pairs.selectExpr("copies", "words", "entity", "xxhash64(replace(lower(line), entity, '')) AS rest")
    entities = pairs.groupBy("entity").agg(
        F.sum("copies").alias("n_entity"), F.countDistinct("rest").alias("different")
    ).where(F.col("different") >= min_lines)
    together = pairs.join(entities.drop("different"), "entity").select(
        "entity", "n_entity", "copies", "rest", F.explode("words").alias("term")
    ).where(f"length(term) >= {TERM_LETTERS} AND term rlike '\\\\p{{L}}'")
    together = together.groupBy("entity", "term").agg(
        F.first("n_entity").alias("n_entity"), F.sum("copies").alias("n_both"),
        F.countDistinct("rest").alias("different"))
    together = together.where(F.col("different") >= min_lines)
    every = docs.select(F.explode(F.split("text", "\n")).alias("line"))
    # Counted for all words: combined in the tasks, that is less to send than the lines of the terms.
    # Written, so that it is done alike whether there are terms or not.
    counts = every.select(F.expr(f"explode(array_distinct({_words('line')}))").alias("term"))
    counts = counts.where(f"length(term) >= {TERM_LETTERS}").groupBy("term").agg(F.count("*").alias("n_term")).checkpoint()
    # Lines that have a term in spans only don't have it.
    inside = lines.select("copies", F.explode(F.array_except("within", "words")).alias("term"))
    inside = inside.groupBy("term").agg(F.sum("copies").alias("n_inside"))
    beside = lines.select("copies", F.explode(F.array_except("words", "within")).alias("term"))
    beside = beside.groupBy("term").agg(F.sum("copies").alias("n_beside"))
    total = found.agg(F.coalesce(F.sum("n_lines"), F.lit(0))).first()[0]
    known = together.join(counts, "term", "left").join(inside, "term", "left").join(beside, "term", "left")
    # A word that a span cuts short is a word of its own beside it.
    known = known.withColumn(
        "n_term", F.expr("coalesce(n_term, 0) - coalesce(n_inside, 0) + coalesce(n_beside, 0)")
    ).withColumn(
        # An entity of every line gives no information.
        "part", F.expr(f"1 - ln(n_term / n_both) / nullif(ln({float(total)}D / n_entity), 0)")
    )
    return known.where(F.col("part") >= disclosure).select("entity", "term", "part")


def _of_entities(found: DataFrame, terms: DataFrame) -> DataFrame:
    """``doc_id``, ``_h`` and the ``terms`` that reveal an entity of the document."""
    listed = found.select(*KEY, F.explode("spans").alias("s")).select(*KEY, F.lower("s.value").alias("entity"))
    return listed.join(terms, "entity").groupBy(*KEY).agg(F.collect_set("term").alias("terms"))


def _of_all(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``doc_id``, ``_h`` and the ``terms`` that a document has, whatever entity they reveal."""
    terms = terms.select("term").distinct().checkpoint()
    words = docs.select(*KEY, F.expr(f"explode(array_distinct({_words('text')}))").alias("term"))
    words = words.where(f"length(term) >= {TERM_LETTERS}")
    return words.join(_small(terms), "term").groupBy(*KEY).agg(F.collect_set("term").alias("terms"))


def _small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if is_small(table, MAX_TERM_BYTES) else table


def _on_key(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
    other = other.withColumnsRenamed({"doc_id": "_id", "_h": "_key"})
    on = rows["_h"].eqNullSafe(other["_key"]) & rows["doc_id"].eqNullSafe(other["_id"])
    return rows.join(other, on, how).drop("_id", "_key")


def with_terms(docs: DataFrame, found: DataFrame, terms: DataFrame, everywhere: bool = False) -> DataFrame:
    """``found`` with the spans of the terms that reveal an entity of the document added, or
    with those of all terms. Only ids, terms and the texts that have them are joined."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"))
    listed = _of_all(docs, terms) if everywhere else _of_entities(found.where("size(spans) > 0"), terms)
    listed = listed.checkpoint()
    texts = _on_key(docs, _small(listed), "inner").dropDuplicates(KEY)
    # Spaces for base spans: terms are looked for beside them, and places stay.
    texts = with_spans(texts, "text").withColumn("text", F.expr(
        "CASE WHEN size(spans) = 0 THEN text ELSE " + _cut(
            "spans", "text", "repeat(' ', x.stop - x.start)", "repeat(' ', greatest(0, x.stop - s.at))") + " END"))
    pieces = texts.selectExpr(
        *KEY, "terms", f"regexp_extract_all(text, {_literal(WORD)}, 0) AS _m", f"split(text, {_literal(WORD)}, -1) AS _p")
    more = _placed("_p", "_m", "array_contains(terms, lower(x.m))", len(KINDS), "term")
    more = pieces.selectExpr(*KEY, f"{more} AS _more").where("size(_more) > 0").checkpoint()
    both = _on_key(found, _small(more), "left")
    return both.selectExpr(
        "doc_id", "text", "CASE WHEN _more IS NULL THEN spans ELSE sort_array(concat(spans, _more)) END AS spans")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", texts: bool = True,
         everywhere: bool = False) -> DataFrame:
    """``doc_id``, ``text`` and all ``spans``: base ones and disclosing terms, in documents
    that have the entity or ``everywhere``.

    Without ``texts`` only documents with base spans have theirs, and only those texts are
    written.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared_folder(docs.sparkSession)
    found = with_spans(own.withColumn("_h", F.xxhash64("text")), "text")
    found = found.withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)))
    if not texts:
        found = found.withColumn("text", F.when(F.size("spans") > 0, F.col("text")))
    found = found.checkpoint()
    return with_terms(own, found, disclosing_terms(own, found).checkpoint(), everywhere)


def sanitised(found: DataFrame) -> DataFrame:
    """``found`` with its texts made safe: a base span becomes its kind in brackets, a
    term is removed. A span that begins within an earlier one is part of it."""
    step = _cut("spans", "text", "CASE WHEN x.kind = 'term' THEN '' ELSE concat('[', upper(x.kind), ']') END")
    return found.withColumn("text", F.expr(f"CASE WHEN text IS NULL THEN NULL ELSE {step} END"))
