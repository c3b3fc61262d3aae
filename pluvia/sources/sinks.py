"""Sinks. Each writes from the executors and returns the number of rows written; none gathers rows on the driver.

An overwrite that fails leaves the old rows: the new ones are written beside them and take their place when they are complete.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.sources import folders
from pluvia.sources.tables import CSV_LAYOUT


def counted(df: DataFrame, save: Callable[[DataFrame], None], **counts: Column) -> dict[str, int]:
    """Run the write and return its ``rows`` and other aggregates, taken on the way rather than by a second read."""
    counter = Observation()
    save(df.observe(counter, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in counts.items()]))
    return {name: int(counter.get.get(name) or 0) for name in ("rows", *counts)}


def written(df: DataFrame, save: Callable[[DataFrame], None]) -> int:
    return counted(df, save)["rows"]


def _saver(spark: SparkSession, kind: str, path: str, mode: str, **options: str) -> Callable[[DataFrame], None]:
    """How to save a frame at ``path``: an overwrite goes beside it first."""

    def save(out: DataFrame) -> None:
        if mode == "overwrite":
            folders.replace(spark, path, lambda place: out.write.options(**options).format(kind).save(place))
        else:
            out.write.mode(mode).options(**options).format(kind).save(path)

    return save


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    return written(df, _saver(df.sparkSession, "parquet", path, mode))


def write_parquet_counted(df: DataFrame, path: str, mode: str = "overwrite", **counts: Column) -> dict[str, int]:
    """Write, and return ``rows`` beside the named aggregates of what was written."""
    return counted(df, _saver(df.sparkSession, "parquet", path, mode), **counts)


def write_json(df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "overwrite") -> int:
    """JSON lines of the chosen columns. Null fields are left out of the lines."""
    return written(df.select(*columns) if columns else df, _saver(df.sparkSession, "json", path, mode))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", *, multi_line: bool = False) -> int:
    """CSV with a header that ``read_csv`` reads back as it was: a null is nothing, an empty text is ``""``,
    blanks stay, and a quote inside a value is doubled.

    Files stay splittable, so a value with a line break raises, unless ``multi_line`` allows it (and the
    reader is told). A null in a table of one column would be a blank line, which readers skip; it raises too.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]

    def checked(name: str) -> Column:
        bad = F.lit(False) if multi_line or name not in texts else F.col(f"`{name}`").rlike("[\\r\\n]")
        if len(df.columns) == 1:
            bad = F.coalesce(bad, F.lit(True)) | F.col(f"`{name}`").isNull()
        message = f"{name}: a value that this CSV layout cannot hold (line break, or null in a single column)"
        return F.when(bad, F.raise_error(F.lit(message)).cast(df.schema[name].dataType)).otherwise(F.col(f"`{name}`")).alias(name)

    rows = df.select(*map(checked, df.columns))
    return written(rows, _saver(df.sparkSession, "csv", path, mode, **CSV_LAYOUT, emptyValue='""', nullValue=""))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order, cast to its types and carrying its comments.

    A field whose metadata has ``default_now`` is filled with the time of the query where it is null or absent.
    A value that does not fit raises; list such rows first with ``quality.type_misfits``.
    """

    def column(f: T.StructField) -> Column:
        kind = T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType
        if f.metadata.get("default_now"):
            now = F.current_timestamp().cast(kind)
            value = F.coalesce(F.col(f.name).cast(kind), now) if f.name in df.columns else now
        else:
            value = F.col(f.name).cast(kind)
        return value.alias(f.name, metadata=f.metadata)

    return df.select(*map(column, schema.fields))


def create_table(df: DataFrame, name: str, schema: T.StructType, path: str) -> DataFrame:
    """Create a typed table with column comments, its files under ``path``. Declared text lengths are enforced on every write."""
    spark = df.sparkSession
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    conform(df, schema).write.insertInto(name, overwrite=True)
    return spark.table(name)


def insert_rows(df: DataFrame, name: str) -> DataFrame:
    """Append rows to an existing table, matched by column name and cast to the table's types."""
    spark = df.sparkSession
    conform(df, spark.table(name).schema).write.insertInto(name)
    return spark.table(name)


def write_bucketed(df: DataFrame, name: str, series: Sequence[str], order: Sequence[str], buckets: int, path: str) -> DataFrame:
    """Write a table whose rows are dealt into ``buckets`` by series and sorted within them, so that later windows over a series need
    no shuffle. The rows are shuffled once here, and each bucket is one file. Size the buckets as shuffle partitions are sized."""
    dealt = df.repartition(buckets, *series)
    dealt.write.bucketBy(buckets, *series).sortBy(*series, *order).option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
