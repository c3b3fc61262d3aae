"""Tabular sources: CSV, Parquet, JDBC and literal rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


#: How CSV is laid out on both sides: blanks are part of a value, and a quote inside one is doubled.
CSV_LAYOUT = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, *, multi_line: bool = False, mode: str = "FAILFAST"
) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads the files twice.

    Nothing between two commas is null and ``""`` is an empty text (the reader tells them apart only when the
    null mark is one that no file has). A value that is not of its type, or a row with too many
    columns, stops the read unless ``mode`` says otherwise. Values with line breaks need ``multi_line``, which
    makes a file one task.
    """
    reader = spark.read.options(**CSV_LAYOUT, nullValue="\x00", emptyValue="", mode=mode, multiLine=str(multi_line).lower())
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def jdbc_options(
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower: Any = None,
    upper: Any = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    connection: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC scan. Credentials and driver come from the caller in ``connection``.

    With a partition column the table is read by ``partitions`` queries at once; rows outside the
    bounds are still read, by the first and the last of them.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(connection or {})}
    if partition_column is not None:
        if lower is None or upper is None or partitions < 1:
            raise ValueError("a partitioned read needs lower, upper and partitions >= 1")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs: Any) -> DataFrame:
    """Full extract of a relational table, in parallel when a partition column is given."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()


def inline_rows(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: T.StructType) -> DataFrame:
    """A few literal rows with declared types."""
    return spark.createDataFrame([tuple(r) for r in rows], schema)
