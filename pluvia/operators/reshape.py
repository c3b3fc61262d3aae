"""Row and column shaping: documents to rows, renames, casts and null handling."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.functions.columns import is_complete, numeric_columns
from pluvia.schemas import PRECIPITATION, STATION_COLLISIONS, TARGET, TEMPERATURE, TIME

DAILY_FIELDS = (TIME, TEMPERATURE, PRECIPITATION)


def unpivot_daily(
    documents: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str] = DAILY_FIELDS,
    *,
    record: str = "daily",
) -> DataFrame:
    """One row per array position, with the document's key columns beside the zipped values.

    Shorter arrays are padded with nulls. A document with a null or empty array set gives no row.
    Only the listed arrays are read.
    """
    zipped = F.arrays_zip(*[F.col(f"{record}.{f}") for f in fields])
    rows = documents.select(*keys, F.explode(zipped).alias("_row"))
    return rows.select(*keys, *[F.col(f"_row.{f}").alias(f) for f in fields])


def prefix_columns(df: DataFrame, names: Iterable[str] = STATION_COLLISIONS, prefix: str = "station_") -> DataFrame:
    """Prefix the listed columns where they exist, so that a later join has no name twice."""
    return df.withColumnsRenamed({n: prefix + n for n in names})


def parse_date(df: DataFrame, column: str = TIME) -> DataFrame:
    """Cast to date. A value that is no date becomes null; ``date_rejects`` lists such rows."""
    return df.withColumn(column, F.col(column).try_cast("date"))


def date_rejects(df: DataFrame, column: str = TIME) -> DataFrame:
    return df.where(F.col(column).isNotNull() & F.col(column).try_cast("date").isNull())


def numeric_as_float(df: DataFrame) -> DataFrame:
    """Every numeric column as single-precision float; the others stay as they are."""
    return df.withColumns({c: F.col(c).cast("float") for c in numeric_columns(df)})


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any of the columns (all by default)."""
    return df.where(is_complete(df, df.columns if columns is None else columns))


def with_label(df: DataFrame, target: str = TARGET, features: Sequence[str] | None = None, keys: Sequence[str] = (TIME,)) -> DataFrame:
    """The frame a model is trained on: key columns, features and the target renamed to ``label``.

    Without ``features`` every column is kept.
    """
    kept = df.select(*keys, *features, target) if features is not None else df
    return kept.withColumnRenamed(target, "label")


def feature_columns(df: DataFrame, excluded: Iterable[str] = (TIME, PRECIPITATION, TARGET), keys: Iterable[str] = ()) -> list[str]:
    """Model inputs in column order: everything but the time, the current measure, the target and the series keys."""
    out = {*excluded, *keys, "label"}
    return [c for c in df.columns if c not in out]
