"""Days that arrive later: the same features as a full run, from the months that they change and their halo."""

from __future__ import annotations

import datetime as dt
import glob
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvia.operators import temporal
from pluvia.plans import increments
from pluvia.session import scratch_path
from tests.conftest import rows_of

SCHEMA = "key long, time date, precipitation_sum double, temperature_2m_max double"


def series(spark, seed=1, days=330, keys=(1, 2, 3), gap=0.3):
    """Days with gaps; a measure is missing now and then; the last key has long gaps."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in keys:
        for d in range(days):
            if rng.random() < gap or (k == 3 and d % 100 > 5):
                continue
            p, t = (round(float(v), 2) for v in rng.uniform(0, 30, 2))
            rows.append((k, dt.date(2023, 1, 1) + dt.timedelta(d), None if rng.random() < 0.03 else p, t))
    return spark.createDataFrame(rows, SCHEMA)


def full(df, keys):
    whole = df.where(F.col("precipitation_sum").isNotNull())
    return temporal.drop_boundary_rows(temporal.series_features(whole, keys))


def run(spark, parts, keys):
    trusted, features = scratch_path(spark, "trusted"), scratch_path(spark, "features")
    done = [increments.add_days(spark, part, trusted, features, keys) for part in parts]
    return done, trusted, features


@pytest.mark.parametrize("keys", [["key"], []])
def test_increments_equal_a_full_run(spark, keys):
    df = series(spark, keys=(1, 2, 3) if keys else (1,))
    month = F.month("time")
    parts = [df.where(month.isin(1, 2, 3, 6, 7, 11)), df.where(month.isin(4, 8, 9)), df.where(month.isin(5, 10))]
    again = df.where(month.isin(3, 9)).withColumn("precipitation_sum", F.col("precipitation_sum") + 1)
    done, trusted, features = run(spark, [*parts, again], keys)
    final = df.where(~month.isin(3, 9)).unionByName(again)
    assert rows_of(spark.read.parquet(trusted).drop("month")) == rows_of(final)
    want = full(final, keys)
    assert rows_of(spark.read.parquet(features).select(*want.columns if keys else [c for c in want.columns if c != "key"])) == rows_of(want if keys else want.drop("key"))
    assert [d.changed for d in done][-1] == ("2023-03", "2023-09")


def test_a_new_day_reads_and_writes_few_months(spark):
    df = series(spark, keys=(1, 2), gap=0.1)
    last = df.agg(F.max("time")).first()[0]
    new = spark.createDataFrame([(k, last + dt.timedelta(1), 1.0, 2.0) for k in (1, 2)], SCHEMA)
    trusted, features = scratch_path(spark, "trusted"), scratch_path(spark, "features")
    increments.add_days(spark, df, trusted, features, ["key"])
    before = {p: hashlib.md5(open(p, "rb").read()).hexdigest() for p in glob.glob(f"{trusted}/*/*.parquet")}
    done = increments.add_days(spark, new, trusted, features, ["key"])
    assert done.changed == ("2023-11",) and done.remade == ("2023-10", "2023-11") and len(done.read) <= 4
    after = {p: hashlib.md5(open(p, "rb").read()).hexdigest() for p in glob.glob(f"{trusted}/*/*.parquet")}
    assert {p for p in before if after.get(p) != before[p]} == {p for p in before if "month=2023-11" in p}
    assert rows_of(spark.read.parquet(features).drop("month")) == rows_of(full(df.unionByName(new), ["key"]))


def test_only_the_named_months_are_read(spark):
    trusted, features = scratch_path(spark, "trusted"), scratch_path(spark, "features")
    increments.add_days(spark, series(spark), trusted, features, ["key"])
    rows = increments.read_months(spark, trusted, ["2023-02", "2023-05"])
    files = {r[0] for r in rows.select("_metadata.file_path").distinct().collect()}
    assert {f.split("month=")[1][:7] for f in files} == {"2023-02", "2023-05"}
    assert {f.split("month=")[1][:7] for f in rows.inputFiles()} == {"2023-02", "2023-05"}


def test_repeats_undated_and_nothing(spark):
    rows = [(1, dt.date(2024, 1, d), float(d), 1.0) for d in range(1, 9)] + [(1, dt.date(2024, 1, 3), 2.0, 1.0), (1, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    (done,), trusted, features = run(spark, [df], ["key"])
    assert done.undated == 1 and spark.read.parquet(trusted).count() == 8 and spark.read.parquet(features).count() == 4
    assert increments.add_days(spark, df.where("time IS NULL"), trusted, features, ["key"]) == increments.Increment((), (), (), 1)


def test_a_month_that_loses_its_features(spark):
    """A replaced measure is null now: the month's features go, and its neighbours' change."""
    rows = [(1, dt.date(2024, 1, 1) + dt.timedelta(d), float(d), 1.0) for d in (*range(28), 40, *range(62, 80))]
    df = spark.createDataFrame(rows, SCHEMA)
    gone = spark.createDataFrame([(1, dt.date(2024, 2, 10), None, 1.0)], SCHEMA)
    _, trusted, features = run(spark, [df, gone], ["key"])
    final = df.where("time <> DATE'2024-02-10'")
    assert rows_of(spark.read.parquet(features).drop("month")) == rows_of(full(final, ["key"]))


def test_documents_from_the_command_line(spark, tmp_path):
    import json

    from pluvia.__main__ import main

    trusted, features = f"{tmp_path}/trusted", f"{tmp_path}/features"

    def land(name, first, days):
        dates = [str(dt.date(2024, 1, 1) + dt.timedelta(d)) for d in range(first, first + days)]
        values = [round(float(np.cos(d)), 3) for d in range(first, first + days)]
        (tmp_path / name).mkdir()
        document = {"latitude": 1.0, "longitude": 2.0, "daily": {"time": dates, "temperature_2m_max": values, "precipitation_sum": values}}
        (tmp_path / name / "a.json").write_text(json.dumps(document, indent=1))
        return str(tmp_path / name)

    assert main(["add", land("one", 0, 40), trusted, features]) == 0
    assert main(["add", land("two", 38, 30), trusted, features]) == 0
    rows = spark.read.parquet(trusted)
    assert rows.count() == 68 and spark.read.parquet(features).count() == 64
    want = full(rows.drop("month"), ["latitude", "longitude"])
    assert rows_of(spark.read.parquet(features).select(*want.columns)) == rows_of(want)
