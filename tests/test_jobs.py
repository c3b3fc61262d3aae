from __future__ import annotations

import datetime as dt
import json
import os

import numpy as np
import pytest

from pluvia.plans import jobs
from pluvia.sources import sinks
from tests.conftest import rows_of

DAYS = 40


def weather(location, day):
    """A repeatable daily value pair."""
    return round(20 + 5 * np.sin(day / 3 + location), 2), round(abs(7 * np.cos(day * (1.3 + location))), 2)


@pytest.fixture
def zones(tmp_path):
    """Two locations landed as indented documents, one station each."""
    raw, stations = f"{tmp_path}/raw", f"{tmp_path}/stations"
    os.makedirs(raw), os.makedirs(stations)
    for location in (1, 2):
        values = [weather(location, d) for d in range(DAYS)]
        daily = {
            "time": [str(dt.date(2024, 1, 1) + dt.timedelta(d)) for d in range(DAYS)],
            "temperature_2m_max": [v[0] for v in values],
            "precipitation_sum": [v[1] for v in values],
        }
        with open(f"{raw}/{location}.json", "w") as f:
            json.dump({"latitude": float(location), "longitude": 0.0, "daily": daily}, f, indent=1)
    with open(f"{stations}/all.csv", "w") as f:
        f.write("latitude,longitude,station_name,date,temperature_2m_max\n1.0,0.0,one,2020-01-01,5.5\n2.0,0.0,two,2020-01-01,6.5\n")
    return raw, stations, f"{tmp_path}/trusted", f"{tmp_path}/refined"


def test_raw_to_refined(spark, zones):
    titles = []
    log = jobs.raw_to_refined(spark, *zones, report=lambda title, df: titles.append((title, df.count())))
    assert [(r.stage, r.status, r.rows) for r in log.collect()] == [
        ("etl", jobs.COMPLETED, 2 * DAYS),
        ("analyse", jobs.COMPLETED, 2 * (DAYS - 4)),
    ]
    assert titles == [("schema", 12), ("first rows", 5), ("statistics", 9), ("dates", 1), ("coefficients", 8)]
    trusted = spark.read.parquet(zones[2])
    assert {"station_name", "station_date", "station_temperature_2m_max"} <= set(trusted.columns)
    assert trusted.schema["time"].dataType.simpleString() == "date"

    refined = spark.read.json(zones[3])
    assert set(refined.columns) == {
        "latitude", "longitude", "time", "temperature_2m_max",
        "precipitation_lag_1", "precipitation_lag_2", "precipitation_lag_3",
        "temperature_lag_1", "temperature_lag_2", "temperature_lag_3",
        "actual_next_day_precipitation", "predicted_next_day_precipitation",
    }
    x, y = [], []
    for location in (1, 2):
        values = [weather(location, d) for d in range(DAYS)]
        for d in range(3, DAYS - 1):
            x.append([1, values[d][0], *[values[d - k][1] for k in (1, 2, 3)], *[values[d - k][0] for k in (1, 2, 3)]])
            y.append(values[d + 1][1])
    expected = np.array(x) @ np.linalg.lstsq(np.array(x), np.array(y), rcond=None)[0]
    got = [r.predicted_next_day_precipitation for r in refined.orderBy("latitude", "time").collect()]
    assert got == pytest.approx(list(expected))


def test_undated_rows_are_counted(spark, zones):
    raw, stations, trusted, _ = zones
    with open(f"{raw}/3.json", "w") as f:
        daily = {"time": ["2024-13-01", "x"], "temperature_2m_max": [1.0, 2.0, 3.0], "precipitation_sum": []}
        json.dump({"latitude": 1.0, "longitude": 0.0, "daily": daily}, f)
    assert jobs.etl(spark, raw, stations, trusted) == jobs.Outcome(jobs.COMPLETED, 2 * DAYS + 3, 3, fan_out=1)


def test_second_run_overwrites(spark, zones):
    for _ in range(2):
        jobs.raw_to_refined(spark, *zones)
    assert spark.read.json(zones[3]).count() == 2 * (DAYS - 4)


def test_global_series(spark, zones):
    raw, stations, trusted, refined = zones
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(d), *map(float, weather(1, d))) for d in range(DAYS)]
    sinks.write_parquet(spark.createDataFrame(rows, "time date, temperature_2m_max double, precipitation_sum double"), trusted)
    assert jobs.analyse(spark, trusted, refined, []) == jobs.Outcome(jobs.COMPLETED, DAYS - 4)


def test_incomplete_and_undated_rows_are_no_neighbours(spark, zones):
    """The next day and the lags are those of the complete rows, as if the others were not there."""
    good = [(str(dt.date(2024, 1, 1) + dt.timedelta(d)), *map(float, weather(1, d))) for d in range(DAYS)]
    bad = [("2024-02-30", 1.0, 1.0), ("2024-01-05", None, 1.0), ("2024-01-05", 1.0, float("nan")), (None, 1.0, 1.0)]
    schema = "time string, temperature_2m_max double, precipitation_sum double"
    outputs = []
    for rows in (good, good + bad):
        sinks.write_parquet(spark.createDataFrame(rows, schema), zones[2])
        jobs.analyse(spark, zones[2], zones[3], [])
        outputs.append(rows_of(spark.read.json(zones[3])))
    assert len(outputs[0]) == DAYS - 4
    assert [r[:-2] for r in outputs[0]] == [r[:-2] for r in outputs[1]]


def test_repeated_times_stop_the_analysis(spark, zones):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(1, day, 1.0, 1.0), (1, day, 2.0, 2.0)], "s int, time date, temperature_2m_max double, precipitation_sum double")
    sinks.write_parquet(df, zones[2])
    for series in (["s"], []):
        with pytest.raises(ValueError, match="not unique"):
            jobs.analyse(spark, zones[2], zones[3], series)
    log = jobs.run([("a", lambda: jobs.analyse(spark, zones[2], zones[3], ["s"])), ("b", lambda: jobs.Outcome(jobs.COMPLETED))], spark)
    assert [(r.stage, r.status) for r in log.collect()] == [("a", jobs.FAILED), ("b", jobs.NOT_RUN)]
    assert "not unique" in log.first().message


@pytest.mark.parametrize("days", [0, 3])
def test_too_little_data_is_skipped(spark, zones, days):
    """No rows at all, or fewer rows than the lags need."""
    rows = [(1, dt.date(2024, 1, 1 + d), 1.0, 1.0) for d in range(days)]
    sinks.write_parquet(spark.createDataFrame(rows, "s int, time date, temperature_2m_max double, precipitation_sum double"), zones[2])
    assert jobs.analyse(spark, zones[2], zones[3], ["s"]).status == jobs.SKIPPED_EMPTY
    assert not os.path.exists(zones[3])


def test_empty_raw_zone_gates_the_analysis(spark, zones):
    raw, stations, trusted, refined = zones
    empty = f"{raw}-empty"
    os.makedirs(empty)
    log = jobs.raw_to_refined(spark, empty, stations, trusted, refined)
    assert [(r.stage, r.status) for r in log.collect()] == [("etl", jobs.SKIPPED_EMPTY), ("analyse", jobs.NOT_RUN)]


def test_extract_writes_csv(spark, zones, folder, monkeypatch):
    """The extract beyond the connection itself: gate, dump and count."""
    table = spark.createDataFrame([(1, "a"), (2, "b,c")], "id long, name string")
    monkeypatch.setattr(jobs, "read_jdbc", lambda *args, **kwargs: table)
    assert jobs.extract(spark, "jdbc:x:", "t", folder) == jobs.Outcome(jobs.COMPLETED, 2)
    assert rows_of(spark.read.schema(table.schema).option("header", True).csv(folder)) == rows_of(table)
    monkeypatch.setattr(jobs, "read_jdbc", lambda *args, **kwargs: table.where("false"))
    assert jobs.extract(spark, "jdbc:x:", "t", folder).status == jobs.SKIPPED_EMPTY


def test_several_stations_a_location(spark, zones):
    """Copies of a day that differ in their station only are one day; days that differ in a measure still stop the job."""
    raw, stations, trusted, refined = zones
    with open(f"{stations}/more.csv", "w") as f:
        f.write("latitude,longitude,station_name,date,temperature_2m_max\n1.0,0.0,uno,2021-01-01,1.5\n1.0,0.0,un,2021-01-01,2.5\n")
    log = {r.stage: r for r in jobs.raw_to_refined(spark, *zones).collect()}
    assert (log["etl"].status, log["etl"].rows, log["etl"].fan_out) == (jobs.COMPLETED, 4 * DAYS, 3)
    assert (log["analyse"].status, log["analyse"].rows) == (jobs.COMPLETED, 2 * (DAYS - 4))


def test_without_keys_stations_are_a_table_of_their_own(spark, zones, capsys):
    from pluvia.__main__ import main

    raw, _, trusted, _ = zones
    os.remove(f"{raw}/2.json")
    assert main(["run", *zones, "--series", ""]) == 0
    assert "FAILED" not in capsys.readouterr().out
    assert spark.read.parquet(trusted).count() == DAYS and spark.read.parquet(f"{trusted}-stations").count() == 2


def test_left_out_rows_are_counted(spark, zones):
    rows = [(str(dt.date(2024, 1, 1) + dt.timedelta(d)), *map(float, weather(1, d))) for d in range(25)]
    rows += [("bad", 1.0, 1.0)] * 5 + [("2024-03-01", None, 1.0), ("2024-03-02", 1.0, float("nan"))]
    sinks.write_parquet(spark.createDataFrame(rows, "time string, temperature_2m_max double, precipitation_sum double"), zones[2])
    assert jobs.analyse(spark, zones[2], zones[3], []) == jobs.Outcome(jobs.COMPLETED, 21, undated=5, incomplete=2)


def test_broken_documents_are_set_aside(spark, zones):
    raw, stations, trusted, _ = zones
    with open(f"{raw}/broken.json", "w") as f:
        f.write('{"latitude": 1.0, "daily": ')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        jobs.etl(spark, raw, stations, trusted)
    outcome = jobs.etl(spark, raw, stations, trusted, mode="PERMISSIVE")
    assert (outcome.status, outcome.rows, outcome.rejected) == (jobs.COMPLETED, 2 * DAYS, 1)
    assert spark.read.json(f"{trusted}-rejected").count() == 1


def test_the_run_is_gated_on_its_extract(spark, zones):
    for outcome, later in ((jobs.Outcome(jobs.COMPLETED, 2), jobs.COMPLETED), (jobs.Outcome(jobs.SKIPPED_EMPTY), jobs.NOT_RUN)):
        log = jobs.raw_to_refined(spark, *zones, ingest=lambda outcome=outcome: outcome)
        assert [(r.stage, r.status) for r in log.collect()] == [("extract", outcome.status), ("etl", later), ("analyse", later)]


def test_every_report_row_is_printed(spark, zones, capsys):
    from pluvia.__main__ import main

    assert main(["run", *zones, "--lags", "12"]) == 0
    lines = capsys.readouterr().out.split("\n")
    part = lambda a, b: lines[lines.index(a) + 2 : lines.index(b)]
    assert (len(part("schema", "first rows")), len(part("statistics", "dates")), len(part("coefficients", "run"))) == (30, 27, 26)
    assert any(line.startswith("intercept") for line in part("coefficients", "run"))


def test_schemas_on_the_command_line(spark, zones):
    from pluvia.__main__ import main

    raw, stations, trusted, _ = zones
    with open(f"{raw}/3.json", "w") as f:
        json.dump({"location_id": 7, "daily": {"time": ["2024-01-01"], "temperature_2m_max": [1.0], "precipitation_sum": [1.0]}}, f)
    with open(f"{stations}/all.csv", "w") as f:
        f.write("location_id,station_name\n7,seven\n")
    schemas = ["--document-schema", "location_id long", "--stations-schema", "location_id long, station_name string"]
    assert main(["etl", raw, stations, trusted, "--series", "location_id", *schemas]) == 0
    assert spark.read.parquet(trusted).where("station_name = 'seven'").count() == 1


def test_command_line(spark, zones, capsys):
    from pluvia.__main__ import main

    assert main(["run", *zones]) == 0
    shown = capsys.readouterr().out
    assert "coefficients" in shown and "COMPLETED" in shown
    assert main(["analyse", zones[2], zones[3], "--series", "latitude,longitude", "--lags", "2"]) == 0
    assert main(["etl", *zones[:3]]) == 0
    assert main(["analyse", f"{zones[2]}-missing", zones[3]]) == 1


def test_a_run_goes_on_where_it_failed(spark, zones, monkeypatch):
    raw, stations, trusted, refined = zones
    log, went = f"{trusted}-log", []
    etl = jobs.etl
    monkeypatch.setattr(jobs, "etl", lambda *a, **k: went.append("etl") or etl(*a, **k))
    analyse = jobs.analyse
    monkeypatch.setattr(jobs, "analyse", lambda *a, **k: 1 / 0)
    first = jobs.raw_to_refined(spark, *zones, log_path=log).collect()
    assert [(r.stage, r.status) for r in first] == [("etl", jobs.COMPLETED), ("analyse", jobs.FAILED)]
    monkeypatch.setattr(jobs, "analyse", analyse)
    second = jobs.raw_to_refined(spark, *zones, log_path=log).collect()
    assert [(r.stage, r.status, r.message) for r in second] == [("etl", jobs.COMPLETED, jobs.RESUMED), ("analyse", jobs.COMPLETED, None)]
    assert went == ["etl"] and second[0].rows == first[0].rows
    # All stages done: nothing is repeated. Other options or other raw files: all of it is.
    assert {r.message for r in jobs.raw_to_refined(spark, *zones, log_path=log).collect()} == {jobs.RESUMED} and went == ["etl"]
    jobs.raw_to_refined(spark, *zones, log_path=log, lags=2)
    assert went == ["etl"] * 2
    with open(f"{raw}/9.json", "w") as f:
        json.dump({"latitude": 1.0, "longitude": 0.0, "daily": {"time": ["2025-01-01"], "temperature_2m_max": [1.0], "precipitation_sum": [1.0]}}, f)
    assert jobs.raw_to_refined(spark, *zones, log_path=log, lags=2).collect()[0].rows == first[0].rows + 1 and went == ["etl"] * 3


def test_command_line_with_versions_and_a_log(spark, zones):
    from pluvia.__main__ import main
    from pluvia.sources import versions

    for _ in range(2):
        assert main(["run", *zones, "--versions", "--log", f"{zones[2]}-log"]) == 0
    assert versions.numbers(spark, zones[3]) == [1] and versions.read(spark, zones[3]).count() == 2 * (DAYS - 4)


def test_a_stage_leaves_no_copies(spark, zones):
    from pluvia.session import scratch_root

    before = set(os.listdir(scratch_root(spark))) if os.path.isdir(scratch_root(spark)) else set()
    assert {r.status for r in jobs.raw_to_refined(spark, *zones).collect()} == {jobs.COMPLETED}
    assert set(os.listdir(scratch_root(spark))) <= before
