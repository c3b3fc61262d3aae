"""Raw weather documents: one JSON object with parallel daily arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pluvia.schemas import document_schema


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    multi_line: bool = True,
    infer: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Read every document under ``path``.

    With ``multi_line`` a document may span a whole file and each file is one task, so parallelism
    comes from many files. Documents landed one per line are read with ``multi_line=False`` and are
    split like any text. The schema is declared; ``infer=True`` costs one more pass over the files.
    A broken document stops the read unless ``mode`` says otherwise.
    """
    reader = spark.read.option("multiLine", multi_line).option("mode", mode)
    if not infer:
        reader = reader.schema(schema or document_schema())
    return reader.json(path)
