from __future__ import annotations

import datetime as dt
import statistics

import pytest

from pluvia.operators import stats


def test_describe_counts_what_is_present(spark):
    values = [1.0, 2.5, 4.0]
    df = spark.createDataFrame([(v, None, i) for i, v in enumerate(values)] + [(None, None, 9)], "a double, b double, c int")
    out = {r["column"]: r for r in stats.describe_numeric(df).collect()}
    assert out["a"]["count"] == 3 and out["a"]["mean"] == pytest.approx(2.5)
    assert out["a"]["stddev"] == pytest.approx(statistics.stdev(values))
    assert (out["a"]["min"], out["a"]["max"]) == (1.0, 4.0)
    assert out["b"]["count"] == 0 and out["b"]["mean"] is None and out["b"]["min"] is None
    assert out["c"]["count"] == 4 and out["c"]["max"] == 9.0


def test_describe_equals_the_built_in_summary(spark):
    df = spark.range(100).selectExpr("cast(id AS double) AS x", "sin(id) AS y")
    built_in = {r["summary"]: r for r in df.describe().collect()}
    for row in stats.describe_numeric(df).collect():
        for name in ("count", "mean", "stddev", "min", "max"):
            assert row[name] == pytest.approx(float(built_in[name][row["column"]]))


def test_describe_of_nothing(spark):
    empty = spark.createDataFrame([], "a double, d date")
    assert [tuple(r) for r in stats.describe_numeric(empty).collect()] == [("a", 0, None, None, None, None)]
    assert [tuple(r) for r in stats.describe_dates(empty).collect()] == [("d", 0, None, None)]


def test_describe_dates(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5),), (dt.date(2023, 1, 5),), (None,)], "d date")
    assert [tuple(r) for r in stats.describe_dates(df).collect()] == [("d", 2, dt.date(2023, 1, 5), dt.date(2024, 1, 5))]


def test_gate(spark):
    assert stats.is_empty(spark.range(0)) and not stats.is_empty(spark.range(1))
    assert stats.emptiness(spark.range(0), "x").first()["is_empty"] is True


def test_preview_is_ordered(spark):
    assert [r.id for r in stats.preview(spark.range(100).repartition(5), ["id"], 3).collect()] == [0, 1, 2]


def test_schema_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in stats.schema_report(df).orderBy("position").collect()] == [
        (0, "a", "int", True, 0),
        (1, "b", "string", True, 1),
    ]
