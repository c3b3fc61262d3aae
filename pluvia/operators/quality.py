"""Table rules as jobs: each finds the rows that break a rule, or repairs them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.operators.joins import lookup_join

_PLAIN_NUMBERS = (T.DoubleType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, null_rows) for each mandatory column, from one pass."""
    wide = df.agg(
        *[F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("null_rows")).alias(c) for c in columns]
    )
    return wide.select(F.inline(F.array(*columns)))


def null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in a mandatory column; ``nulls`` names the columns, in the order given."""
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), c) for c in columns])
    return df.withColumn("nulls", names).where(F.col("nulls") != "")


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once or hold a null, with their row count ``n``.

    Counts are combined before the shuffle, so a key with very many rows costs one partial count a task.
    """
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    return df.groupBy(*key).agg(F.count("*").alias("n")).where((F.col("n") > 1) | has_null)


def keep_one_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``, the remaining columns breaking ties.

    The choice is a minimum, which is combined before the shuffle, so the copies of one key are never
    brought together in a task.
    """
    rest = [c for c in df.columns if c not in {*key, *order}]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return df.groupBy(*key).agg(first).select(*key, "_first.*").select(*df.columns)


def orphans(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Child rows whose key is set but has no parent."""
    return lookup_join(child.where(" AND ".join(f"`{c}` IS NOT NULL" for c in on)), parent, on, "left_anti")


def cascade_delete(child: DataFrame, deleted_parents: DataFrame, on: Sequence[str]) -> DataFrame:
    """Child rows left after the given parents and their children are deleted."""
    return lookup_join(child, deleted_parents, on, "left_anti")


def misfit(field: T.StructField, source: T.DataType, limit: int | None = None) -> Column:
    """True where a value of type ``source`` does not fit a declared type or text length."""
    col, declared = F.col(field.name), field.dataType
    if isinstance(declared, T.VarcharType):
        return F.char_length(col) > (limit if limit is not None else declared.length)
    if isinstance(declared, T.StringType):
        return F.char_length(col) > (limit if limit is not None else 2**31 - 1)
    if isinstance(declared, T.DecimalType) and declared.precision <= 15 and isinstance(source, _PLAIN_NUMBERS):
        # What rounds to a digit too many; far cheaper than a decimal cast of every value.
        bound = 10.0 ** (declared.precision - declared.scale) - 0.5 * 10.0**-declared.scale
        return F.abs(col.cast("double")) >= bound
    return col.isNotNull() & col.try_cast(declared).isNull()


def type_misfits(df: DataFrame, schema: T.StructType, limits: Mapping[str, int] | None = None) -> DataFrame:
    """Rows with a value that does not fit ``schema``; ``misfits`` names the columns, in schema order.

    A declared column that ``df`` does not have raises: it cannot be said to fit.
    """
    limits = limits or {}
    if absent := [f.name for f in schema.fields if f.name not in df.columns]:
        raise ValueError(f"declared columns are absent: {', '.join(absent)}")
    found = [F.when(misfit(f, df.schema[f.name].dataType, limits.get(f.name)), f.name) for f in schema.fields]
    names = F.concat_ws(",", *found)
    return df.withColumn("misfits", names).where(F.col("misfits") != "")


def default_timestamp(df: DataFrame, column: str) -> DataFrame:
    """Fill missing timestamps with the time of the query."""
    dtype = df.schema[column].dataType
    return df.withColumn(column, F.coalesce(F.col(column), F.current_timestamp().cast(dtype)))
