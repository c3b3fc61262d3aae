"""Column expressions shared by the operators. All of them stay in generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_LOW_BITS = 20


def exact_sum(column: str | Column, scale: int = 2) -> Column:
    """Sum of a double recorded with at most ``scale`` decimals, whatever the order of addition.

    The value is counted in units of its last decimal. The low 20 bits of that count and the rest
    are summed as two longs and put together in decimal arithmetic once per group, which is several
    times faster than a decimal sum over the rows. Counts below 2^40 leave room for 2^43 rows a group;
    beyond that the sum raises an overflow and never wraps, as long as ANSI mode is on. A value with
    more decimals, NaN or infinity raises as well: nothing is rounded away.
    """
    col = F.col(column) if isinstance(column, str) else column
    scaled = col * F.lit(10.0**scale)
    exact = ~F.isnan(scaled) & (F.abs(scaled - F.rint(scaled)) <= F.lit(1e-6) + F.abs(scaled) * F.lit(1e-14))
    error = F.raise_error(F.concat(F.lit(f"exact_sum: more than {scale} decimals, or not finite: "), col.cast("string")))
    units = F.when(col.isNull(), None).when(exact, F.rint(scaled)).otherwise(error.cast("double")).cast("long")
    high = F.sum(F.shiftright(units, _LOW_BITS)).cast("decimal(19,0)")
    low = F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast("decimal(19,0)")
    total = high * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + low
    return (total * F.lit(f"1e-{scale}").cast(T.DecimalType(scale + 1, scale))).cast("double")


def is_complete(df: DataFrame, columns: Iterable[str]) -> Column:
    """True where no listed column is null or NaN.

    Written as ``IS NOT NULL`` terms, which a Parquet scan takes as pushed filters;
    ``na.drop()`` plans as one opaque predicate that it does not take.
    """
    terms = []
    for name in columns:
        terms.append(F.col(name).isNotNull())
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            terms.append(~F.isnan(name))
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def date_columns(df: DataFrame) -> list[str]:
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]
