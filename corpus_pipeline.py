"""A corpus pipeline: documents to packed sequences, in five stages.

Each stage reads what the one before wrote and works on all of it. Rows that have no doc_id pass the
stages that go by doc_id unchanged; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pluvia.llm import decontamination, line_dedup, packing, quality_classifier, simhash
from pluvia.llm.common import table
from pluvia.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. A null text is scored as an empty one, a row without a doc_id stays, and each
    repeated row is judged by its own text."""
    return quality_classifier.keep_good(docs, quality_classifier.train(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that a larger doc_id keeps. A null text stays null, a row without a doc_id keeps all its lines, and
    repeated rows count as one document."""
    return line_dedup.without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash fingerprints: that with the smallest doc_id. Rows without a doc_id stay, a null or
    empty text has fingerprint zero and is linked like any other, and a repeated row stays or goes with its document."""
    return simhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. A null text holds none; repeated rows stay or go together, and a row without a doc_id stays."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences. A null text is an empty one; every row is packed, repeated ones and those without a doc_id too."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack),
]

#: SQL cannot express a trained classifier; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
