"""The training-corpus pipeline: each stage works on all that the one before kept.

Quality rules reject documents and take frequent lines out; of each group of near copies (five-word
shingles, similarity 0.8) one document stays; secrets are replaced by a mark; sources are
mixed to their target weights within 90 per cent of the tokens, without repeating any; and what
is left is packed into sequences. Stages but the last return the columns of ``documents``.

Defined cases, stage by stage: a null text counts as empty, and so fails the quality rules; null ids and repeated rows are rows of their own
(of equal texts one stays); a null source or language is one of its own; very long texts are read whole and are cut only into pieces of a
sequence; ties are broken by id, then text; an empty table gives an empty result of the last stage's columns; extra columns, also with names that the stages
use themselves, pass through to the last stage, which returns pieces only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import mixing, near_dedup, packing, quality, secrets, store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filtered(docs, by="texts")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, budget_percent=90, max_epochs=1)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]

#: Near-duplicate groups, guess costs and packing have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = store.saved(docs, name.replace(" ", "-"))
    return docs
