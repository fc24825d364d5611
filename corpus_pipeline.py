"""A corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, mixing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; ``run``
writes each stage's rows to the shared folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorloom.llm import decontam, mixing, simhash, substrings, toxicity
from sensorloom.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5. Labels of documents that are no longer there
    teach nothing."""
    return toxicity.non_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each component of near-duplicates by SimHash: texts
    whose fingerprints of three-word shingles differ in three bits at most."""
    return simhash.representatives(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand in one of a smaller id."""
    return substrings.cut_documents(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order of the documents, sources mixed to their target weights."""
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", drop_repeats),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


#: The stages learn and scan in ways that SQL cannot express; tests/llm holds them to brute force.
ORACLE_SQL = None
