"""Inserts under declared rules."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from pluvia.operators import joins, merge
from pluvia.schemas import DAILY_WEATHER, LOCATION
from pluvia.session import scratch_path
from pluvia.sources import versions
from tests.conftest import rows_of

DAY = "location_id long, observation_date date, temperature_2m_max double, precipitation_sum double, temperature_unit string, precipitation_unit string"


def days(spark, *rows):
    return spark.createDataFrame([(i, d and dt.date(2024, 1, d), t, 0.5, u, "mm") for i, d, t, u in rows], DAY)


def rules(spark, **more):
    parents = spark.createDataFrame([(1,), (2,), (2,)], "location_id int")
    return merge.Rules(DAILY_WEATHER, ["weather_id"], [["location_id", "observation_date"]], [merge.Reference(["location_id"], parents)], serial="weather_id", **more)


def test_each_rule_and_the_second_insert(spark, folder):
    rows = days(spark, (1, 1, 20.0, "C"), (1, 1, 10.0, "C"), (1, None, 1.0, "C"), (2, 1, 12345.0, "C"), (2, 2, 1.0, "x" * 11), (3, 1, 1.0, "C"), (None, 1, 1.0, "C"), (None, 1, 1.0, "C"))
    done = merge.insert(spark, rows, folder, rules(spark))
    assert (done.version, done.inserted, done.replaced, done.kept, done.rejected) == (1, 3, 0, 0, 5)
    assert sorted((r.location_id, r.temperature_2m_max, r.rule) for r in done.rejects.collect()) == [
        (1, 1.0, "not null (observation_date)"),
        (1, 20.0, "unique (location_id, observation_date)"),
        (2, 1.0, "type (temperature_unit)"),
        (2, 12345.0, "type (temperature_2m_max)"),
        (3, 1.0, "foreign key (location_id)"),
    ]
    again = merge.insert(spark, rows, folder, rules(spark))
    # The two rows without a location are no repeats of each other: a null is like nothing.
    assert (again.version, again.inserted, again.rejected) == (2, 2, 6)
    stored = versions.read(spark, folder).collect()
    assert sorted(r.weather_id for r in stored) == [1, 2, 3, 4, 5]
    assert {str(r.temperature_2m_max) for r in stored if r.location_id == 1} == {"10.00"}
    assert [f.metadata.get("comment") for f in versions.read(spark, folder).schema][1] == "location the row belongs to"


def test_same_rows_twice_give_them_once(spark, folder):
    rows = days(spark, (1, 1, 1.0, "C"), (1, 2, 1.0, "C"), (2, 1, 1.0, "C"))
    for _ in range(2):
        merge.insert(spark, rows, folder, rules(spark))
    assert versions.read(spark, folder).count() == 3


def test_nothing_good_makes_no_version(spark, folder):
    merge.insert(spark, days(spark, (1, 1, 1.0, "C")), folder, rules(spark))
    done = merge.insert(spark, days(spark, (9, 1, 1.0, "C")), folder, rules(spark))
    assert (done.version, done.inserted, done.rejected) == (1, 0, 1) and versions.numbers(spark, folder) == [1]


def test_defaults_and_absent_columns(spark, folder):
    rows = spark.createDataFrame([(1.5, 2.0, "UTC", "extra")], "latitude double, longitude double, timezone string, other string")
    merge.insert(spark, rows, folder, merge.Rules(LOCATION, ["location_id"], serial="location_id"))
    (row,) = versions.read(spark, folder).collect()
    assert (row.location_id, row.timezone, row.elevation) == (1, "UTC", None) and row.data_retrieval_timestamp is not None


SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("v", T.LongType(), False)])
ROW = st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["x", "y", None]), st.one_of(st.none(), st.integers(0, 9)))


def plain(batches, mode):
    """The table after each batch, and counts, as the rules say."""
    stored, counts = [], []
    for batch in batches:
        rejected = sum(v is None or a is None for a, _, v in batch)
        good = [r for r in batch if r[2] is not None and r[0] is not None]
        order = lambda r: (r[2], r[1] is not None, r[1] or "")
        winners, late = {}, 0
        for r in sorted(good, key=order, reverse=mode == merge.REPLACE):
            if r[0] in winners:
                late += 1
            winners.setdefault(r[0], r)
        known = {r[0] for r in stored}
        met = [k for k in winners if k in known]
        if mode == merge.REPLACE:
            stored = [r for r in stored if r[0] not in winners] + list(winners.values())
            counts.append((len(winners) - len(met), len(met), late, rejected))
        else:
            stored += [r for k, r in winners.items() if k not in known]
            lost = late + len(met)
            counts.append((len(winners) - len(met), 0, *((0, rejected + lost) if mode == merge.REJECT else (lost, rejected))))
    return sorted(stored, key=repr), counts


@pytest.mark.parametrize("mode", [merge.REJECT, merge.KEEP, merge.REPLACE])
@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.lists(ROW, max_size=8), min_size=2, max_size=2))
def test_against_a_plain_version(spark, mode, batches):
    folder = scratch_path(spark, "merge")
    counts = []
    for batch in batches:
        frame = spark.createDataFrame(batch, "a long, b string, v long").repartition(2)
        done = merge.insert(spark, frame, folder, merge.Rules(SCHEMA, ["a"]), mode, ["v"])
        counts.append((done.inserted, done.replaced, done.kept, done.rejected))
        assert done.rejects.count() == done.rejected
    want, expected = plain(batches, mode)
    assert counts == expected
    got = rows_of(versions.read(spark, folder)) if versions.numbers(spark, folder) else []
    assert got == want


def test_second_key_and_hot_keys(spark, folder):
    """A third of the rows have one key; the second key is tested among those that pass the first."""
    rows = spark.range(900).selectExpr("IF(id % 3 = 0, 0, id) AS a", "cast(id % 450 AS string) AS b", "id AS v")
    both = merge.Rules(SCHEMA, ["a"], [["b"]])
    done = merge.insert(spark, rows, folder, both, order=["v"])
    assert (done.inserted, done.rejected) == (301, 599)
    assert {r.rule: r["count"] for r in done.rejects.groupBy("rule").count().collect()} == {"unique (a)": 299, "unique (b)": 300}


def test_second_key_of_rows_that_are_kept_out_or_replaced(spark, folder):
    both = merge.Rules(SCHEMA, ["a"], [["b"]])
    frame = lambda *rows: spark.createDataFrame(rows, "a long, b string, v long")
    for mode in (merge.KEEP, merge.REPLACE):
        merge.insert(spark, frame((1, "x", 1), (2, "y", 1), (3, "z", 1)), f"{folder}/{mode}", both)
    # (1, w) is kept out by the stored row and does not block (4, w).
    done = merge.insert(spark, frame((1, "w", 2), (4, "w", 3)), f"{folder}/keep", both, merge.KEEP, ["v"])
    assert (done.inserted, done.kept, done.rejected) == (1, 1, 0)
    # 1 keeps its own x; 2 takes the z that 3 gives up; 5 wants the x that 1 still has.
    done = merge.insert(spark, frame((1, "x", 2), (2, "z", 2), (3, "q", 2), (5, "y", 2)), f"{folder}/replace", both, merge.REPLACE)
    assert (done.inserted, done.replaced, done.rejected) == (1, 3, 0)
    assert rows_of(versions.read(spark, f"{folder}/replace")) == [(1, "x", 2), (2, "z", 2), (3, "q", 2), (5, "y", 2)]
    done = merge.insert(spark, frame((6, "x", 3)), f"{folder}/replace", both, merge.REPLACE)
    assert (done.inserted, done.rejected) == (0, 1)


@pytest.mark.parametrize("mode", [merge.REJECT, merge.KEEP, merge.REPLACE])
def test_large_deliveries_are_written_as_they_came_and_once_more(spark, folder, monkeypatch, mode):
    """As where no side can be broadcast: beside the table, the rows are written as they came and once with what became of them."""
    rows = [[(i % 700, f"b{i % 3}", i) for i in range(1000)], [(i % 900 + 300, None, i) for i in range(1500)]]
    written = []
    real = merge.materialise

    def measured(df, label):
        out = real(df, label)
        written.append(out.count())
        return out

    monkeypatch.setattr(merge, "materialise", measured)
    monkeypatch.setattr(joins, "materialise", measured)
    monkeypatch.setattr(joins, "fits", lambda df, limit: False)
    monkeypatch.setattr(joins, "BUCKETS", 64, raising=False)
    monkeypatch.setattr(merge, "passing", lambda rows, keys, on: rows)
    counts = []
    for batch in rows:
        done = merge.insert(spark, spark.createDataFrame(batch, "a long, b string, v long"), folder, merge.Rules(SCHEMA, ["a"]), mode, ["v"])
        counts.append((done.inserted, done.replaced, done.kept, done.rejected))
        assert done.rejects.count() == done.rejected
    want, expected = plain(rows, mode)
    assert counts == expected and rows_of(versions.read(spark, folder)) == want
    assert sum(written) <= 2 * 2500 + 8 * 64


def test_rejected_rows_are_as_they_came(spark, folder):
    """Values that are one once stored: the row that loses keeps what it had, under a repeated and under a stored key."""
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("v", T.DecimalType(5, 2))])
    for batch, lost in (([("1", 0.251), ("1", 0.254), ("x", 0.1)], [("1", 0.254), ("x", 0.1)]), ([("01", 0.5), ("2", 0.111)], [("01", 0.5)])):
        done = merge.insert(spark, spark.createDataFrame(batch, "a string, v double"), folder, merge.Rules(schema, ["a"]), order=["v"])
        assert sorted((r.a, r.v) for r in done.rejects.collect()) == lost


def test_unknown_mode(spark, folder):
    with pytest.raises(ValueError):
        merge.insert(spark, spark.createDataFrame([], "a long, b string, v long"), folder, merge.Rules(SCHEMA), "update")
