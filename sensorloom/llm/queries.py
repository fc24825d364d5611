"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sensorloom.llm import (
    bytepieces,
    decontam,
    embeddings,
    langid,
    licences,
    manifest,
    maxent,
    mixing,
    simhash,
    spellings,
    substrings,
    toxicity,
    warc,
)
from sensorloom.llm.common import table
from sensorloom.llm.oracles import ORACLES as ORACLES


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mixed(docs).drop("text")


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.predictions(table(spark, sf_dir, "documents"))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scanned(table(spark, sf_dir, "documents"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_bytepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytepieces.digests(table(spark, sf_dir, "documents"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verified(table(spark, sf_dir, "documents"))


def op13_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_lm_score": op4_lm_score,
    "op5_licences": op5_licences,
    "op6_substrings": op6_substrings,
    "op7_language": op7_language,
    "op8_decontamination": op8_decontamination,
    "op9_warc": op9_warc,
    "op10_embeddings": op10_embeddings,
    "op11_bytepieces": op11_bytepieces,
    "op12_manifest": op12_manifest,
    "op13_spellings": op13_spellings,
}
