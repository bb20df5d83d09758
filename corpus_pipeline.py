"""From raw documents to a training mix, in five stages.

Every stage takes ``(spark, docs, sf_dir)``. Its result is written as Parquet
and read again as the next one's documents. All but the last stage return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curbside.llm.decontamination import drop_contaminated
from curbside.llm.exact_dedup import drop_exact_duplicates
from curbside.llm.mixing import mix_sources
from curbside.llm.simhash_dedup import drop_near_duplicates
from curbside.llm.tables import read, stored
from curbside.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not scored as toxic."""
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of close fingerprints."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mix_sources(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# SQL cannot score toxicity, link fingerprints or align words.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
