"""Corpus pipeline: raw documents to a deduplicated, decontaminated, mixed corpus.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept and returns documents; the last adds ``copies``, how often the mix takes
each document.  Every stage is written to the shared folder and read again.

Defined cases: rows with null or repeated ids are documents like others, told
apart by their texts; null and empty texts have no words, so no later stage
finds anything in them and the mix never takes them; columns of any name are
kept; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeguard.llm import decontaminate, jaccard_join, line_runs, mixing, pu_classifier
from lakeguard.llm.common import finished, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Positive-unlabelled quality classifier; rejected documents go."""
    return pu_classifier.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut out of the texts."""
    return line_runs.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar documents stays."""
    return jaccard_join.one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are taken up to their target weights; ``copies`` tells how often."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
]

# A trained classifier stands first, so no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        # Written whole, and what the stage wrote on its way is dropped.
        docs = finished(spark, name, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
