"""Next-row target and k-row lags over ordered series.

Lags count rows, not calendar days: over a gap, lag 1 is the previous row present.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvia.operators.keys import dense_index
from pluvia.schemas import PRECIPITATION, TARGET, TEMPERATURE, TIME

# Measure -> prefix of its lag columns, in output order.
LAGGED = {PRECIPITATION: "precipitation_lag", TEMPERATURE: "temperature_lag"}

# A block this long sorts in memory; its copied rows are a negligible part of it.
BLOCK_ROWS = 1 << 16
# The longest series one window task is given. A date column has fewer distinct values than this.
SERIES_ROWS = 4_000_000


def _shifts(lags: int, measure: str, target: str, lagged: Mapping[str, str]) -> list[tuple[str, str, int]]:
    """(output column, source column, rows back); the target is one row ahead."""
    ahead = [(target, measure, -1)]
    return ahead + [(f"{p}_{k}", c, k) for c, p in lagged.items() for k in range(1, lags + 1)]


def lag_features(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str] = (TIME,),
    *,
    lags: int = 3,
    measure: str = PRECIPITATION,
    target: str = TARGET,
    lagged: Mapping[str, str] = LAGGED,
    repeats: str | None = None,
) -> DataFrame:
    """Lead and lags by one window per series: one shuffle on the series key, one sort.

    For series of bounded length, such as one row per date. ``lag_features_blocked`` has no such
    need and ``series_features`` chooses by measuring. ``repeats`` names an extra column that marks
    rows with the same order value as the row before, for which a lag is not well defined.
    """
    if not series:
        raise ValueError("a window needs a series key; use lag_features_blocked for one global series")
    window = Window.partitionBy(*series).orderBy(*order)
    added = {name: F.lag(source, step).over(window) for name, source, step in _shifts(lags, measure, target, lagged)}
    if repeats:
        here = F.struct(*order)
        added[repeats] = F.coalesce(F.lag(here, 1).over(window) == here, F.lit(False))
    return df.withColumns(added)


def lag_features_blocked(
    df: DataFrame,
    series: Sequence[str] = (),
    order: Sequence[str] = (TIME,),
    *,
    lags: int = 3,
    measure: str = PRECIPITATION,
    target: str = TARGET,
    lagged: Mapping[str, str] = LAGGED,
    repeats: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Same result as a window per series (or over everything), with work split evenly by row position.

    Rows get a position in (series, order). A block is ``block_rows`` positions; the ``lags`` rows
    before it and the one after it are copied into it, so each block can be computed alone. Blocks
    are of equal size however long a series is. (series, order) must identify a row.
    """
    if block_rows < 1:
        raise ValueError("block_rows must be at least 1")
    indexed = dense_index(df, [*series, *order], "_ix")
    first = f"greatest(_ix - 1, 0) div {block_rows}"
    last = f"(_ix + {lags}) div {block_rows}"
    copies = indexed.withColumn("_block", F.explode(F.expr(f"sequence({first}, {last})")))

    window = Window.partitionBy("_block").orderBy("_ix")

    def same(columns: Sequence[str], step: int) -> Column:
        """The row ``step`` back agrees in ``columns``; rows of one block may be of several series."""
        return reduce(lambda a, b: a & b, [F.lag(c, step).over(window).eqNullSafe(F.col(c)) for c in columns])

    added = {}
    for name, source, step in _shifts(lags, measure, target, lagged):
        value = F.lag(source, step).over(window)
        added[name] = F.when(same(series, step), value) if series else value
    if repeats:
        added[repeats] = F.lag("_ix", 1).over(window).isNotNull() & same([*series, *order], 1)
    rows = copies.withColumns(added).where(F.expr(f"_block = _ix div {block_rows}"))
    return rows.drop("_ix", "_block")


def longest_series(df: DataFrame, series: Sequence[str]) -> int:
    """Rows of the longest series, from one pass over the key columns with counts combined early."""
    counts = df.groupBy(*series).agg(F.count("*").alias("_n"))
    return counts.agg(F.coalesce(F.max("_n"), F.lit(0)).alias("n")).first()["n"]


def series_features(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str] = (TIME,),
    *,
    longest: int | None = None,
    series_rows: int = SERIES_ROWS,
    **options,
) -> DataFrame:
    """Lag features by a plain window where every series is measured to fit one task, in blocks otherwise.

    ``longest`` is an upper bound on the rows of a series, if the caller has one; else it is counted.
    """
    if series and longest is None:
        longest = longest_series(df, series)
    if series and longest <= series_rows:
        return lag_features(df, series, order, **options)
    return lag_features_blocked(df, series, order, **options)


def drop_boundary_rows(df: DataFrame, *, lags: int = 3, target: str = TARGET, lagged: Mapping[str, str] = LAGGED) -> DataFrame:
    """Drop the rows at the ends of a series, where the target or a lag is missing."""
    for name, _, _ in _shifts(lags, PRECIPITATION, target, lagged):
        df = df.where(F.col(name).isNotNull())
    return df
