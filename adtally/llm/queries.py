"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adtally.llm import (
    alignment, decontam, langid, lines, neardup, neighbours, packing, pii, quality, secrets, tokenstore,
    toxicity, whitening,
)
from adtally.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbour_report(table(spark, sf_dir, "embeddings"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=4)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_report(table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(table(spark, sf_dir, "documents"))


def op13_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenstore.store_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_pii": op2_pii,
    "op3_secrets": op3_secrets,
    "op4_language": op4_language,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_neighbours": op9_neighbours,
    "op10_decontamination": op10_decontamination,
    "op11_whitening": op11_whitening,
    "op12_token_alignment": op12_token_alignment,
    "op13_token_store": op13_token_store,
}

ORACLE: dict[str, str] = {
    "op2_pii": pii.SQL,
    "op3_secrets": secrets.SQL,
    "op5_line_dedup": lines.SQL,
    "op8_near_duplicates": neardup.SQL,
    "op10_decontamination": decontam.SQL,
}
