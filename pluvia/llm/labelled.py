"""Labelled rows to learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import bucket

FOLDS = 5

#: Classifiers learn from at most this many labelled documents of each class. The sample is the
#: documents with the smallest hash of doc_id, so it does not depend on order or partitioning.
SAMPLE_PER_CLASS = 12_000


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, y): one label a document; where a document has several, the majority, and 1 on a tie."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    return known.groupBy("doc_id").agg((F.avg(F.col(column).cast("double")) >= 0.5).cast("int").alias("y"))


def training_sample(labels: DataFrame, column: str, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(doc_id, y, fold) of a bounded sample of rows outside fold 0."""
    rows = labelled(labels, column).withColumn("fold", bucket("doc_id", FOLDS).cast("int")).where("fold <> 0")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return rows.where("y = 1").orderBy(*order).limit(per_class).unionByName(rows.where("y = 0").orderBy(*order).limit(per_class))
