"""The queries of this subpackage, with their parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platewright.llm import bpe, decontaminate, linedup, lm, passages, pii, quality, ranked_bpe, repeats, shards, simhash, variants, warc
from platewright.session import new_folder, shared_folder

SHARDS = 16
#: Shingle length in words and largest number of differing bits.
SIMHASH = {"shingle": 3, "distance": 3}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_json(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared_passages(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines lost and what is left of each document that loses some; texts whole."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    deleted = linedup.deleted_lines(docs).checkpoint()
    left = linedup.without_lines(
        docs.join(deleted.select("doc_id"), "doc_id", "left_semi"), deleted, drop_emptied=False)
    return left.join(deleted, "doc_id").select(
        "doc_id", F.size("deleted").cast("long").alias("n_deleted"), "deleted", F.sha2("text", 256).alias("left_sha256")
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_folder(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.with_quality(quality.with_measures(docs).drop("text").checkpoint())
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"))


def sharded(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        "lang", "source", "n_chars",
    )
    dims = {"n_chars": shards.number(F.col("n_chars")), "source": shards.prefix(F.col("source")),
            "lang": shards.prefix(F.col("lang")), "doc_id": shards.number(F.col("doc_id"))}
    placed = shards.with_slots(shards.with_shards(rows, dims, F.col("size"), leaves=SHARDS), ["doc_id", "size", "text_crc32"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"), texts=False, everywhere=True)
    base = F.expr(f"filter(spans, s -> s.rank < {len(pii.KINDS)})")
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint) AS n_{k}") for k in pii.KINDS]
    return found.withColumn("base", base).select(
        "doc_id", *counts, F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans")
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives written into the shared folder and read back."""
    folder = new_folder(spark, "warc")
    warc.write_archives(warc.resolved(warc.with_headers(table(spark, sf_dir, "pages"))), folder)
    return warc.with_original_sizes(warc.read_archives(spark, folder)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), **SIMHASH)
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(docs, tokenizer_json())


def bpe_digests(docs: DataFrame, spec: str) -> DataFrame:
    return bpe.round_trip(docs, spec).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def ranks_file(name: str = "byte_bpe_multi_50k.tiktoken") -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op11_two_tier_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked_digests(docs, ranks_file(), split_pattern())


def ranked_digests(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return ranked_bpe.round_trip(docs, ranks, pattern).select(
        "doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents whose id's checksum ends in 0 get a tail that repeats."""
    g = F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        period = 1 + F.floor((n - a) / (3 + g % 8))
        times = F.ceil((n - a) / period).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), period.cast("int")), times))
        tail = F.slice(tail, F.lit(1), (n - a).cast("int"))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " "))

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # As the variable of a function the words are taken once.
    text = F.transform(F.array(words), planted)[0]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    return docs.withColumn("text", F.when(chosen, text).otherwise(F.col("text")))


def run_digests(docs: DataFrame) -> DataFrame:
    found = repeats.with_runs(with_planted_runs(docs.select("doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[n].cast("string") for n in ("start", "length", "period")]))
    lines = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.withColumn("_longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_longest.start")).alias("start"),
        F.col("_longest.length").alias("length"), (-F.col("_longest.period")).alias("period"),
        F.expr("1000 * _longest.length div -_longest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


#: Words of so many letters, found so often, in runs of letters.
WORD_LETTERS, WORD_COUNT = 7, 2
LETTERS = "A-Za-z\u00C0-\u00FF"


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(table(spark, sf_dir, "documents"))


def words_with_slips(docs: DataFrame) -> DataFrame:
    """``word`` and ``n``: runs of letters, of which some, by a checksum of document and run,
    lack a letter. A document without an id has no slips."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # Shorter runs have no words in them.
    found = F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{WORD_LETTERS},}}+"), F.lit(0)))
    runs = docs.select(F.col("doc_id").cast("string").alias("id"), found.alias("run"))
    runs = runs.select("id", F.translate("run", upper, upper.lower()).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    slip = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % 31 == 0, slip).otherwise(F.col("run")).alias("word"))
    words = words.filter(F.length("word") >= WORD_LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= WORD_COUNT)


def variant_groups(docs: DataFrame) -> DataFrame:
    return variants.variants(words_with_slips(docs)).select("word", "form", "root", "n", "n_near", "form_n")


#: The others estimate, train, align or hash in ways that SQL does not express; they are
#: tested against brute force.
ORACLE: dict[str, str] = {
    "op8_warc": """
        SELECT page_id, payload_bytes, payload_digest,
          CASE WHEN original > page_id THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN original > page_id THEN original END AS refers_to
        FROM (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                sha1(coalesce(html, '')) AS payload_digest,
                CASE WHEN strlen(coalesce(html, '')) >= 1000
                  THEN max(page_id) OVER (PARTITION BY coalesce(html, '')) END AS original
              FROM pages) t""",
}


def queries() -> dict:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_line_dedup": op2_line_dedup,
        "op3_decontamination": op3_decontamination,
        "op4_quality": op4_quality,
        "op5_lm_scoring": op5_lm_scoring,
        "op6_sharding": op6_sharding,
        "op7_pii": op7_pii,
        "op8_warc": op8_warc,
        "op9_simhash_near_dedup": op9_simhash_near_dedup,
        "op10_bpe_round_trip": op10_bpe_round_trip,
        "op11_two_tier_bpe": op11_two_tier_bpe,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_spelling_variants": op13_spelling_variants,
    }
