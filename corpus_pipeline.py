"""A corpus pipeline: language, near duplicates, benchmark passages, secrets, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns the columns of documents, the last one
the tokens. Stages, in order: texts whose language cannot be determined go; one document of each near-duplicate group stays;
documents that the benchmark contaminates go; secrets are replaced by a mark; every text is encoded and decoded.

Rows that no rule concerns stay byte for byte. A null text goes in the first stage (its language cannot be determined); rows with a null id are no
duplicates of others and pass the second; of rows that share an id one stays; further columns pass, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docflow.llm import decontaminate, language, near_duplicates, secrets, sentencepiece_bpe
from docflow.llm.common import discard, materialise, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trained on labelled rows of these documents; a text goes if no learned language leads or covers it as held-out labelled rows are covered."""
    return language.keep(docs, language.fit(docs, bounds=True))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), mode="documents")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encode(docs, ids=False)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("sentencepiece", token_stage),
]

#: SQL cannot express trained filters, sampling hashes or merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again by the next; what a stage has read is then deleted."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        kept: list[str] = []
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}", kept)
        discard(spark, before)
        before = kept
    return STAGES[-1][1](spark, docs, sf_dir)
