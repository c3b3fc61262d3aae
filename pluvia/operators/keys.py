"""A dense row number over a total order, without passing all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvia.session import materialise

# monotonically_increasing_id() holds the partition number above 33 bits of row position.
_ROW_BITS = 33


def dense_index(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Add ``name``: the 0-based position of each row in ``order``, which must be a total order.

    The global sort is range-partitioned on the whole ordering, so no value of its first column can
    overload a task. The sorted rows are written once, as the range bounds of a second run may
    differ. Row counts per sorted partition then give each partition its first position; that table
    has one row per shuffle partition, which bounds both its window and its broadcast.
    """
    position = F.col("_position")
    rows = materialise(df.orderBy(*order).withColumn("_position", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright(position, _ROW_BITS)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    row = position.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        rows.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + row)
        .drop("_part", "_start", "_position")
    )


def surrogate_key(df: DataFrame, order: Sequence[str | Column], name: str, start: int = 1) -> DataFrame:
    """A gapless integer key from ``start``, in first position."""
    indexed = dense_index(df, order, name)
    return indexed.select((F.col(name) + F.lit(start)).cast("long").alias(name), *df.columns)


def continued_key(df: DataFrame, name: str, start: int) -> DataFrame:
    """Add ``name``: gapless integers from ``start``, in no stated order and without a sort.

    The rows are written once. Rows counted by file give each file its range, and a row's place in its file the rest, so a repeated task
    gives the same numbers. The table of ranges has one row per file written, which bounds its window and its broadcast.
    """
    schema = df.schema
    rows = materialise(df, "numbered").select(*[F.col(f"`{c}`") for c in schema.names], F.col("_metadata.file_name").alias("_part"), F.col("_metadata.row_index").alias("_position"))
    counts = rows.groupBy("_part").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) + start).alias("_start"))
    numbered = rows.join(F.broadcast(starts), "_part").withColumn(name, (F.col("_start") + F.col("_position")).cast("long"))
    return numbered.drop("_part", "_position", "_start")
