"""From raw documents to token ids: judged, freed of shared lines, near copies and
benchmark passages, and encoded.

Each stage takes the session, the documents its predecessor kept and the folder of
the tables; all but the last return documents with all their columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from platewright.llm import decontaminate, linedup, quality, simhash
from platewright.llm.queries import SIMHASH, bpe_digests, table, tokenizer_json
from platewright.session import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has go, and documents of nothing else."""
    return linedup.without_lines(docs, linedup.deleted_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.keep_one(docs, **SIMHASH)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the number of tokens, and digests of the ids and of the decoded text."""
    return bpe_digests(docs.select("doc_id", "text"), tokenizer_json())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]
#: No SQL: estimation by rounds, alignment and the tokenizer are not expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
