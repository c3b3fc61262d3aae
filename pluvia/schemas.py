"""Declared schemas. Column names and types are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the daily series and of the refined output.
TIME = "time"
TEMPERATURE = "temperature_2m_max"
PRECIPITATION = "precipitation_sum"
TARGET = "next_day_precipitation"
STATION_COLLISIONS = ("date", "temperature_2m_max", "precipitation_sum")
ACTUAL = "actual_next_day_precipitation"
PREDICTED = "predicted_next_day_precipitation"


def _field(name: str, dtype: T.DataType, comment: str, nullable: bool = True, **more: object) -> T.StructField:
    return T.StructField(name, dtype, nullable, {"comment": comment, **more})


# Longest text each declared column takes.
TEXT_LIMITS = {
    "timezone": 255,
    "timezone_abbreviation": 50,
    "temperature_unit": 10,
    "precipitation_unit": 10,
}


def _text(name: str, comment: str) -> T.StructField:
    return _field(name, T.VarcharType(TEXT_LIMITS[name]), comment)


DAILY_ARRAYS = T.StructType(
    [
        T.StructField(TIME, T.ArrayType(T.StringType())),
        T.StructField(TEMPERATURE, T.ArrayType(T.DoubleType())),
        T.StructField(PRECIPITATION, T.ArrayType(T.DoubleType())),
    ]
)

DOCUMENT_METADATA = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("generationtime_ms", T.DoubleType()),
        T.StructField("utc_offset_seconds", T.IntegerType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("timezone_abbreviation", T.StringType()),
        T.StructField("elevation", T.DoubleType()),
    ]
)


def document_schema(metadata: T.StructType = DOCUMENT_METADATA) -> T.StructType:
    """Schema of a raw document: its metadata fields, then ``daily`` with three parallel arrays."""
    return T.StructType([*metadata.fields, T.StructField("daily", DAILY_ARRAYS)])


LOCATION = T.StructType(
    [
        _field("location_id", T.LongType(), "surrogate key", nullable=False),
        _field("latitude", T.DecimalType(9, 6), "latitude in degrees", nullable=False),
        _field("longitude", T.DecimalType(9, 6), "longitude in degrees", nullable=False),
        _field("generationtime_ms", T.DecimalType(10, 5), "time the source took to answer"),
        _field("utc_offset_seconds", T.IntegerType(), "offset from UTC"),
        _text("timezone", "time zone name"),
        _text("timezone_abbreviation", "short time zone name"),
        _field("elevation", T.DecimalType(10, 2), "elevation in metres"),
        _field("data_retrieval_timestamp", T.TimestampType(), "time of ingestion", default_now=True),
    ]
)

DAILY_WEATHER = T.StructType(
    [
        _field("weather_id", T.LongType(), "surrogate key", nullable=False),
        _field("location_id", T.LongType(), "location the row belongs to"),
        _field("observation_date", T.DateType(), "day of the observation", nullable=False),
        _field(TEMPERATURE, T.DecimalType(5, 2), "highest temperature of the day"),
        _field(PRECIPITATION, T.DecimalType(5, 2), "precipitation of the day"),
        _text("temperature_unit", "unit of the temperature"),
        _text("precipitation_unit", "unit of the precipitation"),
    ]
)
