from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import types as T

from pluvia.schemas import DAILY_WEATHER, document_schema
from pluvia.sources import sinks, tables
from pluvia.sources.documents import read_documents
from tests.conftest import rows_of

SERIES = "key long, time date, temperature_2m_max double, precipitation_sum double"
ROWS = [(1, dt.date(2024, 1, 1), 1.5, None), (1, dt.date(2024, 1, 2), None, 0.25), (2, dt.date(2024, 1, 1), -3.0, 1e-3)]


@pytest.fixture
def series(spark):
    return spark.createDataFrame(ROWS, SERIES)


def document(latitude, days, **extra):
    daily = {"time": days, "temperature_2m_max": [1.0] * len(days), "precipitation_sum": [None] * len(days)}
    return json.dumps({"latitude": latitude, "longitude": 1.0, "timezone": "UTC", "daily": daily, **extra}, indent=2)


def land(folder, *texts):
    os.makedirs(folder)
    for i, text in enumerate(texts):
        with open(f"{folder}/{i}.json", "w") as f:
            f.write(text)
    return folder


def test_documents_that_span_files(spark, tmp_path):
    path = land(f"{tmp_path}/raw", document(1.0, ["2024-01-01"]), document(2.0, ["2024-01-01", "2024-01-02"], daily_units={"time": "iso8601"}))
    declared = read_documents(spark, path)
    assert declared.schema == document_schema()
    assert {(r.latitude, len(r.daily.time)) for r in declared.collect()} == {(1.0, 1), (2.0, 2)}
    assert {r.latitude for r in read_documents(spark, path, infer=True).collect()} == {1.0, 2.0}


def test_broken_document_stops_the_read(spark, tmp_path):
    path = land(f"{tmp_path}/raw", document(1.0, ["2024-01-01"])[:-20])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_documents(spark, path).collect()
    assert read_documents(spark, path, mode="DROPMALFORMED").count() == 0


@pytest.mark.parametrize("kind", ["parquet", "json", "csv"])
def test_what_is_written_is_read(spark, series, folder, kind):
    assert getattr(sinks, f"write_{kind}")(series, folder) == 3
    if kind == "csv":
        back = tables.read_csv(spark, folder, series.schema)
    else:
        back = getattr(spark.read.schema(series.schema), kind)(folder)
    assert rows_of(back) == rows_of(series)


@pytest.mark.parametrize("kind", ["parquet", "json", "csv"])
def test_overwrite_replaces(spark, series, folder, kind):
    write = getattr(sinks, f"write_{kind}")
    write(series, folder)
    assert write(series.where("key = 2"), folder) == 1
    assert write(series.where("key = 3"), folder) == 0
    assert spark.read.schema(series.schema).option("header", True).format(kind).load(folder).count() == 0


def test_json_leaves_out_null_fields_and_projects(spark, series, folder):
    sinks.write_json(series, folder, ["time", "precipitation_sum"])
    lines = [json.loads(r.value) for r in spark.read.text(folder).collect()]
    assert {"time": "2024-01-01"} in lines and all("key" not in line for line in lines)


def test_csv_inference_and_header_only(spark, folder, series):
    sinks.write_csv(series, folder)
    kinds = {f.name: f.dataType.simpleString() for f in tables.read_csv(spark, folder).schema.fields}
    assert kinds == {"key": "int", "time": "date", "temperature_2m_max": "double", "precipitation_sum": "double"}
    os.makedirs(f"{folder}-empty")
    with open(f"{folder}-empty/part.csv", "w") as f:
        f.write("key,time,temperature_2m_max,precipitation_sum\n")
    assert tables.read_csv(spark, f"{folder}-empty", series.schema).count() == 0


def test_csv_header_is_checked_against_the_schema(spark, folder, series):
    sinks.write_csv(series.withColumnRenamed("key", "other"), folder)
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_csv(spark, folder, series.schema).collect()


def test_parquet_projection(spark, series, folder):
    sinks.write_parquet(series, folder)
    assert tables.read_parquet(spark, folder, ["time"]).columns == ["time"]


def test_typed_table_and_insert(spark, folder):
    days = spark.createDataFrame(
        [(1, 7, "2024-01-01", 25.855, 0.1, "C", "mm")],
        "weather_id int, location_id int, observation_date string, temperature_2m_max double, precipitation_sum double, temperature_unit string, precipitation_unit string",
    )
    name = "t_" + folder.rsplit("-", 1)[1]
    table = sinks.create_table(days, name, DAILY_WEATHER, folder)
    assert [f.dataType for f in table.schema.fields] == [T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType for f in DAILY_WEATHER.fields]
    assert table.schema["temperature_2m_max"].metadata["comment"] == "highest temperature of the day"
    assert str(table.first().temperature_2m_max) == "25.86"
    more = sinks.insert_rows(days.withColumn("weather_id", days.weather_id + 1).select(*reversed(days.columns)), name)
    assert {(r.weather_id, r.location_id) for r in more.collect()} == {(1, 7), (2, 7)}


def test_conform_raises_on_overflow(spark):
    bad = spark.createDataFrame([(1, 1, dt.date(2024, 1, 1), 1234.5, 0.0, "C", "mm")], DAILY_WEATHER.names)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        sinks.conform(bad, DAILY_WEATHER).collect()


def test_inline_rows(spark):
    df = tables.inline_rows(spark, [[1, dt.date(2024, 1, 1), 1.0, 2.0]], spark.createDataFrame([], SERIES).schema)
    assert df.count() == 1 and df.schema["time"].dataType.simpleString() == "date"


def test_jdbc_options():
    plain = tables.jdbc_options("jdbc:x:", "readings", connection={"user": "u", "driver": "d"})
    assert plain == {"url": "jdbc:x:", "dbtable": "readings", "fetchsize": "10000", "user": "u", "driver": "d"}
    split = tables.jdbc_options("jdbc:x:", "t", partition_column="id", lower=0, upper=100, partitions=4)
    assert {k: split[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4",
    }
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x:", "t", partition_column="id", lower=0)


ODD = [(1, "  two  "), (2, 'say ""hi"'), (3, "back\\slash\\"), (4, ""), (5, None), (6, ",\""), (7, "\\N")]


@pytest.mark.parametrize("multi_line", [False, True])
def test_csv_comes_back_as_it_was(spark, folder, multi_line):
    rows = spark.createDataFrame(ODD + ([(8, "a\r\nb\n")] if multi_line else []), "id long, t string")
    sinks.write_csv(rows, folder, multi_line=multi_line)
    assert rows_of(tables.read_csv(spark, folder, rows.schema, multi_line=multi_line)) == rows_of(rows)


def test_csv_that_would_lose_values_raises(spark, folder, tmp_path):
    with pytest.raises(Exception, match="line break"):
        sinks.write_csv(spark.createDataFrame([(1, "a\nb")], "id long, t string"), folder)
    with pytest.raises(Exception, match="single column"):
        sinks.write_csv(spark.createDataFrame([("a",), (None,)], "t string"), folder)
    for line in ("abc,x", "1,x,y"):
        (tmp_path / "t.csv").write_text(f"id,t\n{line}\n")
        with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
            tables.read_csv(spark, str(tmp_path), T.StructType.fromDDL("id int, t string")).collect()


def test_csv_quoted_by_doubling_is_read(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,t\n1,"say ""hi"", twice"\n2,\n')
    assert rows_of(tables.read_csv(spark, str(tmp_path))) == [(1, 'say "hi", twice'), (2, None)]
