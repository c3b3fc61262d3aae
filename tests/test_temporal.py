from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pluvia.operators import keys, temporal
from tests.conftest import rows_of

SCHEMA = "series string, time date, precipitation_sum double, temperature_2m_max double"
START = dt.date(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame([(s, START + dt.timedelta(d), p, t) for s, d, p, t in rows], SCHEMA)


def brute_force(rows, lags, by_series=True):
    """Neighbours by position in each sorted series, in plain Python."""
    out = []
    groups = {}
    for row in rows:
        groups.setdefault(row[0] if by_series else None, []).append(row)
    for group in groups.values():
        group.sort(key=lambda r: r[1])
        for i, (s, d, p, t) in enumerate(group):
            at = lambda j, c: group[j][c] if 0 <= j < len(group) else None
            named = {"series": s, "time": START + dt.timedelta(d), "precipitation_sum": p, "temperature_2m_max": t}
            named["next_day_precipitation"] = at(i + 1, 2)
            for k in range(1, lags + 1):
                named[f"precipitation_lag_{k}"] = at(i - k, 2)
                named[f"temperature_lag_{k}"] = at(i - k, 3)
            out.append(tuple(named[n] for n in sorted(named)))
    return sorted(out, key=repr)


# Unique days with gaps; sizes from less than the number of lags up.
days = st.lists(st.integers(0, 400), unique=True, min_size=1, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(series=st.dictionaries(st.sampled_from("abc"), days, min_size=1, max_size=3), block=st.integers(1, 9), lags=st.integers(1, 4))
def test_blocks_equal_series_windows(spark, series, block, lags):
    rows = [(s, d, float(d), float(-d)) for s, ds in series.items() for d in ds]
    df = frame(spark, rows)
    expected = brute_force(rows, lags)
    assert rows_of(temporal.lag_features(df, ["series"], lags=lags)) == expected
    assert rows_of(temporal.lag_features_blocked(df, ["series"], lags=lags, block_rows=block)) == expected


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(ds=days, block=st.sampled_from([1, 2, 3, 5, 64]), lags=st.integers(1, 4))
def test_blocks_equal_one_global_window(spark, ds, block, lags):
    rows = [("x", d, float(d), float(-d)) for d in ds]
    assert rows_of(temporal.lag_features_blocked(frame(spark, rows), lags=lags, block_rows=block)) == brute_force(rows, lags, False)


def test_hot_series_and_equal_times_are_split_evenly(spark):
    """A third of the rows in one series and many rows at one time: blocks stay of equal size."""
    rows = [("hot" if i % 3 == 0 else f"s{i % 50}", i // 100, float(i), float(-i)) for i in range(3000)]
    df = frame(spark, rows).withColumn("id", (-keys.F.col("temperature_2m_max")).cast("long"))
    blocked = temporal.lag_features_blocked(df, ["series"], ["time", "id"], block_rows=100)
    assert rows_of(blocked) == rows_of(temporal.lag_features(df, ["series"], ["time", "id"]))


def test_null_measures_are_carried(spark):
    rows = [("a", 1, None, 1.0), ("a", 2, 2.0, None), ("a", 3, 3.0, 3.0)]
    df = frame(spark, rows)
    assert rows_of(temporal.lag_features_blocked(df, ["series"], block_rows=2)) == brute_force(rows, 3)


def test_repeats_are_marked(spark):
    df = frame(spark, [("a", 1, 1.0, 1.0), ("a", 1, 2.0, 2.0), ("a", 2, 3.0, 3.0), ("b", 2, 4.0, 4.0)])
    for out in (
        temporal.lag_features(df, ["series"], repeats="again"),
        temporal.lag_features_blocked(df, ["series"], repeats="again", block_rows=2),
    ):
        assert out.where("again").count() == 1 and out.where("NOT again").count() == 3


def test_boundary_rows_and_short_series(spark):
    df = frame(spark, [("long", d, 1.0, 1.0) for d in range(10)] + [("short", d, 1.0, 1.0) for d in range(3)])
    kept = temporal.drop_boundary_rows(temporal.lag_features(df, ["series"]))
    assert {r["series"] for r in kept.collect()} == {"long"} and kept.count() == 10 - 3 - 1


def test_empty_input(spark):
    empty = frame(spark, [])
    assert temporal.lag_features_blocked(empty).count() == 0
    assert temporal.series_features(empty, ["series"]).count() == 0


def test_choice_by_measured_length(spark):
    df = frame(spark, [("a", d, 1.0, 1.0) for d in range(5)] + [("b", 1, 1.0, 1.0)])
    assert temporal.longest_series(df, ["series"]) == 5
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "_block" not in plan(temporal.series_features(df, ["series"], series_rows=5))
    assert "_block" in plan(temporal.series_features(df, ["series"], series_rows=4))


def test_wrong_arguments(spark):
    df = frame(spark, [])
    with pytest.raises(ValueError):
        temporal.lag_features(df, [])
    with pytest.raises(ValueError):
        temporal.lag_features_blocked(df, block_rows=0)


@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_dense_index_has_no_gaps(spark, n):
    df = spark.range(n).selectExpr("(id * 7919) % 1009 AS a", "id")
    out = keys.surrogate_key(df, ["a", "id"], "key").orderBy("key").collect()
    assert [r.key for r in out] == list(range(1, n + 1))
    assert [(r.a, r.id) for r in out] == sorted((r.a, r.id) for r in out)
