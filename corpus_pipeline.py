"""A training corpus from the documents table: the stages, and all of them in a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickspark.llm import bpe, jaccard, mixing, quality_rules, secrets
from tickspark.llm.common import stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.kept_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return jaccard.one_of_each(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced by a placeholder; all documents stay."""
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it, none to three times."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each document of the mix: its id, and its text as token ids."""
    return bpe.encode(docs)


STAGES = [
    ("quality_rules", keep_good),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scans", hide_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Estimates, models and encodings are not SQL; tests look at what each stage does.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, in order; what one keeps is stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
