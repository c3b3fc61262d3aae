"""Descriptive statistics and reports on a frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.functions.columns import date_columns, numeric_columns


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, count, mean, stddev, min, max) for every numeric column, from one pass over the data."""
    names = list(numeric_columns(df) if columns is None else columns)
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(c).cast("double").alias("mean"),
                F.stddev_samp(c).cast("double").alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in names
        ]
    )
    return wide.select(F.inline(F.array(*[F.col(f"`{c}`") for c in names])))


def describe_dates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, count, min, max) for every date column, from one pass over the data."""
    names = list(date_columns(df) if columns is None else columns)
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.min(c).cast("date").alias("min"),
                F.max(c).cast("date").alias("max"),
            ).alias(c)
            for c in names
        ]
    )
    return wide.select(F.inline(F.array(*[F.col(f"`{c}`") for c in names])))


def emptiness(df: DataFrame, name: str) -> DataFrame:
    """The emptiness gate as a row (input, is_empty). One row is enough to settle it, so no task reads on after its first."""
    found = df.select(F.lit(1).alias("_one")).limit(1).agg(F.count("*").alias("_n"))
    return found.select(F.lit(name).alias("input"), (F.col("_n") == 0).alias("is_empty"))


def is_empty(df: DataFrame) -> bool:
    return emptiness(df, "").first()["is_empty"]


def preview(df: DataFrame, order: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows in a stated order: a distributed top-k, not a sort of everything."""
    return df.orderBy(*order).limit(rows)


def schema_report(df: DataFrame) -> DataFrame:
    """(position, name, type, nullable) of each column, with the nulls found in it, from one pass."""
    fields = df.schema.fields
    wide = df.agg(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(f.nullable).alias("nullable"),
                F.count_if(F.col(f"`{f.name}`").isNull()).alias("null_rows"),
            ).alias(f"c{i}")
            for i, f in enumerate(fields)
        ]
    )
    return wide.select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(fields))])))
