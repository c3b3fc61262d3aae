"""Days that arrive after the first load: only the months that they change are read and written.

The trusted zone and its features are partitioned by month. New rows replace stored ones of the same series and time. Lags and the next-day
target cross months, so the features of a changed month are made from it and a halo: the last rows of each series before it and the first
after it; and rows just outside the month, whose neighbours have changed, are made anew with it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.functions.columns import is_complete
from pluvia.operators.joins import lookup_join
from pluvia.operators.quality import keep_one_per_key
from pluvia.operators.reshape import parse_date, unpivot_daily
from pluvia.operators.stats import is_empty
from pluvia.operators.temporal import drop_boundary_rows, series_features
from pluvia.schemas import PRECIPITATION, TEMPERATURE, TIME
from pluvia.session import materialise
from pluvia.sources import folders
from pluvia.sources.documents import read_documents

MONTH = "month"


@dataclass(frozen=True)
class Increment:
    """Months that got rows, months whose features were made anew, and months read for that."""

    changed: tuple[str, ...]
    remade: tuple[str, ...]
    read: tuple[str, ...]
    undated: int


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.date_format(TIME, "yyyy-MM"))


def write_months(df: DataFrame, path: str, months: Iterable[str]) -> None:
    """Put the rows of ``months`` in the place of what is stored for them; all other months stay. The months change when all rows are
    written. Rows are dealt by month, and adaptive execution splits a large one."""
    df.hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    spark = df.sparkSession
    filled = {r[MONTH] for r in df.select(MONTH).distinct().collect()}
    for month in set(months) - filled:
        folders.delete(spark, f"{path.rstrip('/')}/{MONTH}={month}")


def months_of(spark: SparkSession, path: str) -> list[str]:
    return [n.removeprefix(f"{MONTH}=") for n in folders.names(spark, path) if n.startswith(f"{MONTH}=")]


def read_months(spark: SparkSession, path: str, months: Iterable[str]) -> DataFrame:
    """Rows of the given months; no other folder is opened."""
    wanted = list(months)
    rows = spark.read.option("basePath", path).parquet(*[f"{path.rstrip('/')}/{MONTH}={m}" for m in wanted])
    return rows.withColumn(MONTH, F.col(MONTH).cast("string"))


def reach(spark: SparkSession, path: str, series: Sequence[str], within: DataFrame, months: Sequence[str], rows: int) -> list[str]:
    """The first of ``months``, in the order given, in which every series of ``within`` has ``rows`` complete rows, or all it has.

    Months are counted one, two, four, ... at a time, from the columns that a count needs. For a series without rows there this
    ends at the last month.
    """
    if rows < 1 or not months:
        return []
    key = list(series) or ["_all"]  # one global series has a key that is the same everywhere

    def keyed(df: DataFrame) -> DataFrame:
        return df if series else df.withColumn("_all", F.lit(1))

    lacking = materialise(keyed(within).select(*key, F.lit(0).cast("long").alias("_n")).distinct(), "lacking")
    used, step = 0, 1
    while used < len(months) and not is_empty(lacking):
        batch = months[used : used + step]
        found = read_months(spark, path, batch)
        found = keyed(found.where(is_complete(found, [TIME, PRECIPITATION, TEMPERATURE]))).groupBy(*key).agg(F.count("*").alias("_more"))
        total = F.col("_n") + F.coalesce("_more", F.lit(0))
        counted = lookup_join(lacking, found, key, "left").withColumn("_n", total).drop("_more")
        lacking = materialise(counted.where(F.col("_n") < rows), "lacking")
        used, step = used + len(batch), 2 * step
    return list(months[:used])


def add_days(spark: SparkSession, days: DataFrame, trusted: str, features: str, series: Sequence[str], *, lags: int = 3) -> Increment:
    """Merge daily rows into the trusted zone and bring its features up to date. The result is what a full run over all rows would give.

    Of new rows with the same series and time one counts (the smallest values); rows without a date are counted and left out.
    """
    key = [*series, TIME]
    came = materialise(days, "days")
    undated = came.where(F.col(TIME).isNull()).count()
    new = materialise(with_month(keep_one_per_key(came.where(F.col(TIME).isNotNull()), key, [])), "new")
    changed = sorted(r[MONTH] for r in new.select(MONTH).distinct().collect())
    if not changed:
        return Increment((), (), (), undated)
    stored = set(months_of(spark, trusted))
    merged = new
    if old := [m for m in changed if m in stored]:
        kept = lookup_join(read_months(spark, trusted, old), new.select(*key), key, "left_anti")
        merged = materialise(kept.select(*new.columns).unionByName(new), "merged")
    write_months(merged, trusted, changed)

    known = months_of(spark, trusted)
    remade, read = set(), set()
    touched = new.select(*series).distinct() if series else new.limit(1)
    for run in _runs(known, changed):
        first, last = known.index(run[0]), known.index(run[-1])
        before, after = known[:first][::-1], known[last + 1 :]
        # The row before has a new target and the next ``lags`` rows new lags; these months are made anew as well ...
        near_before = reach(spark, trusted, series, touched, before, 1)
        near_after = reach(spark, trusted, series, touched, after, lags)
        here = [*near_before[::-1], *run, *near_after]
        # ... and need their own neighbours.
        own = read_months(spark, trusted, here).select(*series).distinct() if series else touched
        halo = [*reach(spark, trusted, series, own, before[len(near_before) :], lags), *reach(spark, trusted, series, own, after[len(near_after) :], 1)]
        remade |= set(here)
        read |= {*here, *halo}
        rows = read_months(spark, trusted, [*here, *halo])
        rows = rows.where(is_complete(rows, [TIME, PRECIPITATION, TEMPERATURE])).select(*key, PRECIPITATION, TEMPERATURE)
        made = drop_boundary_rows(series_features(rows, series, lags=lags), lags=lags)
        made = materialise(with_month(made).where(F.col(MONTH).isin(here)), "features")
        write_months(made, features, here)
    return Increment(tuple(changed), tuple(sorted(remade)), tuple(sorted(read)), undated)


def add_documents(
    spark: SparkSession,
    documents_path: str,
    trusted: str,
    features: str,
    series: Sequence[str] = ("latitude", "longitude"),
    *,
    lags: int = 3,
    document_schema: T.StructType | None = None,
    multi_line: bool = True,
) -> Increment:
    """``add_days`` for landed documents. A document may repeat days that are stored; its rows replace them."""
    documents = read_documents(spark, documents_path, document_schema, multi_line=multi_line)
    days = parse_date(unpivot_daily(documents, series)).select(*series, TIME, PRECIPITATION, TEMPERATURE)
    return add_days(spark, days, trusted, features, series, lags=lags)


def _runs(known: Sequence[str], changed: Iterable[str]) -> list[list[str]]:
    """Changed months, those next to each other together."""
    runs: list[list[str]] = []
    places = sorted(known.index(m) for m in changed)
    for i, p in enumerate(places):
        if i and p == places[i - 1] + 1:
            runs[-1].append(known[p])
        else:
            runs.append([known[p]])
    return runs
