from __future__ import annotations

import datetime as dt

import pytest

from pluvia.operators import joins
from tests.conftest import rows_of


@pytest.fixture
def skewed(spark):
    """Half of the rows on one key, a tenth without a key, the rest spread; every fifth key has no lookup row."""
    rows = [(None if i % 10 == 0 else (1 if i % 2 else i % 97), i) for i in range(2000)]
    lookup = [(k, f"name{k}") for k in range(97) if k % 5] + [(None, "nobody")]
    return spark.createDataFrame(rows, "k int, v int"), spark.createDataFrame(lookup, "k int, name string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("limit", [0, 200, joins.BROADCAST_BYTES])
def test_lookup_join_equals_plain_join(skewed, how, limit):
    rows, lookup = skewed
    assert rows_of(joins.lookup_join(rows, lookup, ["k"], how, broadcast_bytes=limit)) == rows_of(rows.join(lookup, ["k"], how))


def test_costly_rows_are_computed_once(skewed):
    rows, lookup = skewed
    out = joins.lookup_join(rows, lookup, ["k"], "left", broadcast_bytes=0, costly_rows=True)
    assert rows_of(out) == rows_of(rows.join(lookup, ["k"], "left"))
    assert "FileScan" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_on_two_keys_with_repeats_in_the_lookup(spark, how):
    rows = spark.createDataFrame([(i % 2, "x" if i % 3 else "y", i) for i in range(60)], "a int, b string, v int")
    lookup = spark.createDataFrame([(1, "x", 1), (1, "x", 2), (0, "y", 3)], "a int, b string, w int")
    assert rows_of(joins.lookup_join(rows, lookup, ["a", "b"], how, broadcast_bytes=0)) == rows_of(rows.join(lookup, ["a", "b"], how))


def test_hot_keys_are_few_and_found(skewed):
    rows, _ = skewed
    assert [r.k for r in joins.hot_keys(rows.where("k IS NOT NULL"), ["k"]).collect()] == [1]
    spread = rows.sparkSession.range(1000).selectExpr("id AS k")
    assert joins.hot_keys(spread, ["k"]) is None
    assert joins.hot_keys(rows.where("k IS NOT NULL"), ["k"], partitions=2).count() == 1
    assert joins.hot_keys(rows.where("k IS NOT NULL"), ["k"], partitions=1) is None


def test_size_is_measured_on_rows_and_text(spark):
    short = spark.createDataFrame([("a", i) for i in range(10)], "t string, n int")
    long = spark.createDataFrame([("a" * 1000, i) for i in range(10)], "t string, n int")
    assert joins.fits(short, 10 * (16 * 2 + 9)) and not joins.fits(short, 10 * (16 * 2 + 9) - 1)
    assert joins.fits(long, 10 * (16 * 2 + 1008)) and not joins.fits(long, 10_000)
    assert joins.fits(short.select("n"), 320) and not joins.fits(short.select("n"), 319)
    assert joins.fits(short.where("false"), 0)


def test_one_location_meets_every_station(spark):
    """With one location, each day is beside each station: all pairs, by brute force."""
    weather = [(1, dt.date(2024, 1, d), float(d), 0.5) for d in range(1, 6)]
    stations = [(1, f"s{i}", dt.date(2020, 1, 1), float(i)) for i in range(4)]
    out = joins.attach_stations(
        spark.createDataFrame(weather, "location_id int, time date, temperature_2m_max double, precipitation_sum double"),
        spark.createDataFrame(stations, "location_id int, station_name string, date date, temperature_2m_max double"),
        ["location_id"],
    )
    assert out.columns == [
        "location_id", "time", "temperature_2m_max", "precipitation_sum",
        "station_name", "station_date", "station_temperature_2m_max",
    ]
    pairs = [(*w, *s[1:]) for w in weather for s in stations]
    assert sorted(tuple(r) for r in out.collect()) == sorted(pairs)


def test_locations_meet_their_own_stations(spark):
    weather = spark.createDataFrame([(1, "d1"), (2, "d1"), (3, "d1")], "location_id int, time string")
    stations = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "location_id int, station_name string")
    assert rows_of(joins.attach_stations(weather, stations, ["location_id"])) == [
        (1, "a", "d1"), (2, "b", "d1"), (2, "c", "d1"), (3, None, "d1"),
    ]


def test_nested_columns_are_measured(spark):
    rows = spark.range(20).selectExpr("id", "sequence(1, 2000) AS a", "map('k', repeat('x', 500)) AS m", "struct(repeat('y', 300) AS s) AS t")
    for column, size in (("a", 20 * 8000), ("m", 20 * 500), ("t", 20 * 300)):
        assert not joins.fits(rows.select(column), size) and joins.fits(rows.select(column), 2 * size)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_keys_whose_lookup_does_not_fit_are_salted(spark, skewed, how):
    rows, lookup = skewed
    wide = lookup.unionByName(spark.range(50).selectExpr("1 AS k", "repeat('z', 200) AS name"))
    out = joins.lookup_join(rows, wide, ["k"], how, broadcast_bytes=120)
    assert rows_of(out) == rows_of(rows.join(wide, ["k"], how))
    assert how in ("left_semi", "left_anti") or "_salt" in out._jdf.queryExecution().optimizedPlan().toString()


def test_even_keys_are_not_written_to_look_for_hot_ones(spark, monkeypatch):
    """Counts are kept by bucket: what is written does not grow with the number of keys."""
    written = []
    real = joins.materialise

    def measured(df, label):
        out = real(df, label)
        written.append(out.count())
        return out

    monkeypatch.setattr(joins, "materialise", measured)
    monkeypatch.setattr(joins, "BUCKETS", 128, raising=False)
    keys = spark.range(20_000).selectExpr("id AS k")
    assert joins.hot_keys(keys, ["k"]) is None and sum(written) <= 128
    hot = joins.hot_keys(keys.unionByName(spark.range(9000).selectExpr("7L AS k")), ["k"])
    assert [r.k for r in hot.collect()] == [7] and sum(written) <= 2 * 128 + 1
