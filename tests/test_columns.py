from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pluvia.functions.columns import date_columns, exact_sum, is_complete, numeric_columns

cents = st.integers(-(10**14), 10**14)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(st.one_of(st.none(), cents), min_size=1, max_size=40))
def test_exact_sum_is_the_sum_in_whole_units(spark, units):
    df = spark.createDataFrame([(None if u is None else u / 100,) for u in units], "x double").repartition(3)
    total = [u for u in units if u is not None]
    assert df.agg(exact_sum("x").alias("s")).first().s == (sum(total) / 100 if total else None)


def test_exact_sum_equals_the_decimal_sum_in_any_order(spark):
    df = spark.range(200_000).select((F.pmod(F.xxhash64("id"), F.lit(50_000_000)) / 100).alias("x"), (F.col("id") % 7).alias("k"))
    decimal = F.sum(F.col("x").cast("decimal(18,2)")).cast("double")
    sums = df.repartition(13).groupBy("k").agg(exact_sum("x").alias("a"), decimal.alias("b"))
    assert sums.where("a <> b").count() == 0 and sums.count() == 7


@pytest.mark.parametrize("scale, value", [(0, 7.0), (1, 0.1), (3, 0.125), (6, 0.000001)])
def test_exact_sum_with_other_scales(spark, scale, value):
    df = spark.range(10).select(F.lit(value).alias("x"))
    assert df.agg(exact_sum("x", scale).alias("s")).first().s == pytest.approx(10 * value, abs=1e-12)


def test_exact_sum_of_nothing_is_null(spark):
    assert spark.createDataFrame([], "x double").agg(exact_sum("x").alias("s")).first().s is None


def test_is_complete_and_column_kinds(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, math.nan, "b"), (None, 1.0, None)], "i int, d double, s string")
    assert [r.i for r in df.where(is_complete(df, df.columns)).collect()] == [1]
    assert df.where(is_complete(df, [])).count() == 3
    assert numeric_columns(df) == ["i", "d"] and date_columns(df.withColumn("t", F.current_timestamp())) == ["t"]


@pytest.mark.parametrize("value", [0.125, float("nan"), float("inf")])
def test_exact_sum_refuses_what_it_would_round(spark, value):
    with pytest.raises(Exception, match="exact_sum"):
        spark.createDataFrame([(value,), (1.25,)], "x double").agg(exact_sum("x")).collect()
