"""A training-data pipeline of five operators over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``.

Null and empty texts have no language and go in the first stage. Repeated rows of
one doc_id and text become one in the near-duplicate stage; rows without doc_id
pass all stages that their text passes. A stage that leaves no row gives an empty
table to the next, which returns one too. Extra columns are carried through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontamination, jaccard_join, language_id, mixing, toxicity
from tessera.llm.common import table, written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told (score of at least 1/2) stay."""
    return language_id.identified(docs, language_id.trained(docs))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 1/2 stay."""
    return toxicity.untoxic(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard_join.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark stay."""
    return decontamination.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", language_stage),
    ("toxicity", toxicity_stage),
    ("jaccard_join", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: Two stages are trained models, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
