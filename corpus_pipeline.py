"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the last return the columns
of documents, any further ones included. A stage's result is stored as Parquet and read again by the
next, so each judges the whole of what its predecessor kept:

1. quality: documents that the line field scores under its threshold go; fitted on labels of sf_dir.
2. lines: boilerplate lines go, save their first occurrence; ``n_chars`` follows the text. A document
   of which nothing is left goes.
3. near duplicates: of each component (five-word shingles, similarity 0.8) the smallest id stays.
4. decontamination: documents with a hit word of a benchmark window go.
5. packing: the rest, cut into pieces and packed into sequences.

Null texts, null ids, empty tables and repeated rows pass through as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adtally.llm import decontam, lines, neardup, packing, quality
from adtally.llm.common import table
from adtally.session import materialize

SHINGLE_WORDS = 5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.deduped(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs, SHINGLE_WORDS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The model of the first stage has no form in SQL; tests compare all stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
