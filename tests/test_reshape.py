from __future__ import annotations

import datetime as dt
import math

import pytest

from pluvia.operators import reshape
from pluvia.schemas import document_schema
from tests.conftest import rows_of

DAY = "2024-02-{:02d}".format


def documents(spark, *daily):
    rows = [(float(i), 0.0, None, None, None, None, None, d) for i, d in enumerate(daily)]
    return spark.createDataFrame(rows, document_schema())


def test_unpivot_pads_shorter_arrays_with_null(spark):
    out = reshape.unpivot_daily(documents(spark, ([DAY(1), DAY(2)], [1.0, 2.0], [5.0])), ["latitude"])
    assert [tuple(r) for r in out.orderBy("time").collect()] == [(0.0, DAY(1), 1.0, 5.0), (0.0, DAY(2), 2.0, None)]


def test_unpivot_keeps_null_elements_and_drops_null_or_empty_arrays(spark):
    docs = documents(spark, ([DAY(1)], [None], [1.0]), ([DAY(1)], None, [1.0]), ([], [], []), None)
    assert rows_of(reshape.unpivot_daily(docs, ["latitude"])) == [(0.0, 1.0, None, DAY(1))]


def test_unpivot_takes_other_fields_and_record(spark):
    df = spark.createDataFrame([(1, (["a", "b"], [1, 2]))], "id int, r struct<x:array<string>,y:array<int>>")
    assert rows_of(reshape.unpivot_daily(df, ["id"], ["x", "y"], record="r")) == [(1, "a", 1), (1, "b", 2)]


@pytest.mark.parametrize(
    "columns, expected",
    [
        (["station_id", "date"], ["station_id", "station_date"]),
        (["date", "temperature_2m_max", "precipitation_sum"], ["station_date", "station_temperature_2m_max", "station_precipitation_sum"]),
        (["station_id", "name"], ["station_id", "name"]),
    ],
)
def test_prefix_only_where_present(spark, columns, expected):
    df = spark.createDataFrame([tuple("x" for _ in columns)], columns)
    assert reshape.prefix_columns(df).columns == expected


def test_parse_date_and_rejects(spark):
    df = spark.createDataFrame([("2024-01-02",), ("not a date",), ("2024-02-30",), (None,)], "time string")
    assert {r.time for r in reshape.parse_date(df).collect()} == {dt.date(2024, 1, 2), None}
    assert rows_of(reshape.date_rejects(df)) == [("2024-02-30",), ("not a date",)]


def test_drop_incomplete_drops_null_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, math.nan), (None, 4.0)], "a int, b double")
    assert rows_of(reshape.drop_incomplete(df)) == [(1, 1.0)]
    assert rows_of(reshape.drop_incomplete(df, ["b"])) == [(1, 1.0), (None, 4.0)]
    assert rows_of(reshape.drop_incomplete(df)) == rows_of(df.na.drop())


def test_numeric_as_float_leaves_other_types(spark):
    df = spark.createDataFrame([(1, 2.5, "x", dt.date(2024, 1, 1))], "a int, b double, c string, d date")
    assert [f.dataType.simpleString() for f in reshape.numeric_as_float(df).schema] == ["float", "float", "string", "date"]


def test_label_and_feature_columns(spark):
    df = spark.createDataFrame(
        [(7, dt.date(2024, 1, 1), 1.0, 2.0, 3.0, 4.0)],
        "series int, time date, precipitation_sum double, temperature_2m_max double, next_day_precipitation double, precipitation_lag_1 double",
    )
    features = reshape.feature_columns(df, keys=["series"])
    assert features == ["temperature_2m_max", "precipitation_lag_1"]
    assert reshape.with_label(df, features=features).columns == ["time", *features, "label"]
    assert "label" in reshape.with_label(df).columns and len(reshape.with_label(df).columns) == 6
