from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.operators import quality
from pluvia.schemas import DAILY_WEATHER, LOCATION, TEXT_LIMITS
from pluvia.sources import sinks
from tests.conftest import rows_of

DAILY = "weather_id long, location_id long, observation_date date, temperature_2m_max double, precipitation_sum double, temperature_unit string"
DAY = dt.date(2024, 1, 1)


def daily(spark, *rows):
    return spark.createDataFrame(list(rows), DAILY)


def test_null_counts(spark):
    df = daily(spark, (1, 1, None, 1.0, 1.0, "C"), (2, 1, DAY, None, 1.0, "C"), (3, None, None, 1.0, 1.0, "C"))
    found = quality.null_counts(df, ["observation_date", "location_id", "weather_id"])
    assert [tuple(r) for r in found.collect()] == [("observation_date", 2), ("location_id", 1), ("weather_id", 0)]


def test_key_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert rows_of(quality.key_violations(df, ["k"])) == [(1, 2), (None, 1)]


def test_keep_one_takes_the_first_and_breaks_ties(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (1, 1, "a"), (2, 5, "x"), (2, 5, "x")], "k int, o int, v string")
    kept = quality.keep_one_per_key(df, ["k"], ["o"])
    assert kept.columns == df.columns and rows_of(kept) == [(1, 1, "a"), (2, 5, "x")]


def test_keep_one_with_a_hot_group_of_copies(spark):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit(1).alias("o"))
    kept = quality.keep_one_per_key(hot, ["k"], ["o"])
    assert kept.count() == hot.select("k").distinct().count() == kept.select("k").distinct().count()


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "location_id int, v int")
    parent = spark.createDataFrame([(1,)], "location_id int")
    assert rows_of(quality.orphans(child, parent, ["location_id"])) == [(2, 20)]


def test_cascade_delete_keeps_children_without_parent_key(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "location_id int, v int")
    deleted = spark.createDataFrame([(1,), (1,)], "location_id int")
    assert rows_of(quality.cascade_delete(child, deleted, ["location_id"])) == [(2, 20), (None, 30)]


def test_type_misfits_name_the_columns(spark):
    df = daily(
        spark,
        (1, 1, DAY, 25.855, 1.0, "C"),
        (2, 1, DAY, 1234.5, 1.0, "C"),
        (3, 1, DAY, 1.0, 99999.0, "degrees Celsius"),
        (4, 1, DAY, None, None, None),
    )
    found = quality.type_misfits(df.withColumn("precipitation_unit", F.lit("mm")), DAILY_WEATHER, TEXT_LIMITS)
    assert {r.weather_id: r.misfits for r in found.collect()} == {2: "temperature_2m_max", 3: "precipitation_sum,temperature_unit"}


@pytest.mark.parametrize("declared", ["decimal(5,2)", "decimal(9,6)", "decimal(10,0)", "decimal(18,2)"])
@pytest.mark.parametrize("source", ["double", "long", "string"])
def test_misfits_are_the_values_a_cast_loses(spark, declared, source):
    edges = [m * 10.0**e + d for e in range(-1, 12) for m in (1, -1) for d in (0, 0.004, 0.005, -0.005, -0.006, 0.0000005)]
    values = [999.995, 999.994999, -999.995, 999.9999995, 9999999999.5, 9999999999.49, None, *edges]
    if source != "string":
        values += [float("nan"), float("inf")] if source == "double" else [2**63 - 1, -(2**63)]
    convert = {"double": lambda v: v, "long": lambda v: v if v is None else int(v), "string": lambda v: v if v is None else repr(v)}[source]
    df = spark.createDataFrame([(convert(v),) for v in values], f"x {source}")
    schema = spark.createDataFrame([], f"x {declared}").schema
    lost = df.where(F.col("x").isNotNull() & F.col("x").try_cast(declared).isNull())
    found = quality.type_misfits(df, schema).select("x")
    assert [repr(r) for r in rows_of(found)] == [repr(r) for r in rows_of(lost)]


def test_extra_digits_round_half_up(spark):
    df = spark.createDataFrame([(25.855,)], "x double")
    assert str(df.select(F.col("x").cast("decimal(5,2)")).first()[0]) == "25.86"


def test_text_limits_are_for_declared_columns():
    declared = {f.name for f in LOCATION.fields} | {f.name for f in DAILY_WEATHER.fields}
    assert set(TEXT_LIMITS) <= declared


def test_default_timestamp_fills_only_what_is_missing(spark):
    then = dt.datetime(2020, 1, 1)
    df = spark.createDataFrame([(1, then), (2, None)], "id int, at timestamp")
    out = {r.id: r["at"] for r in quality.default_timestamp(df, "at").collect()}
    assert out[1] == then and out[2] is not None and out[2].year >= 2024


def test_an_absent_declared_column_raises(spark):
    with pytest.raises(ValueError, match="absent: precipitation_unit"):
        quality.type_misfits(spark.range(1).selectExpr("'C' AS temperature_unit"), T.StructType(DAILY_WEATHER.fields[5:]))


def test_null_rows_name_the_columns(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", None), (3, "a", "b")], "id int, x string, y string")
    assert {r.id: r.nulls for r in quality.null_rows(df, ["x", "y"]).collect()} == {1: "x,y", 2: "y"}


def test_declared_lengths_and_default_time_hold_on_insert(spark, folder):
    row = {f.name: None for f in LOCATION.fields} | {"location_id": 1, "latitude": 1.0, "longitude": 2.0, "timezone": "t" * 255}
    schema = "location_id long, latitude double, longitude double, generationtime_ms double, utc_offset_seconds int, timezone string, timezone_abbreviation string, elevation double, data_retrieval_timestamp timestamp"
    df = spark.createDataFrame([tuple(row.values())], schema)
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    assert sinks.create_table(df, name, LOCATION, folder).first().data_retrieval_timestamp is not None
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        sinks.insert_rows(df.selectExpr("* EXCEPT (timezone)", "repeat('t', 256) AS timezone"), name)
