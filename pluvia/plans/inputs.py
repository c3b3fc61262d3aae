"""Daily series and raw-zone files derived from the given tables, for the registered queries.

Each series has one row per key and date, so a series is never longer than the calendar. All sums
are combined per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.functions.columns import exact_sum
from pluvia.schemas import PRECIPITATION, TEMPERATURE, TIME, document_schema
from pluvia.session import scratch_path
from pluvia.sources.sinks import write_csv

EVENT_DOCUMENT = document_schema(T.StructType([T.StructField("event_type", T.StringType()), T.StructField("period", T.StringType())]))
USER_DOCUMENT = document_schema(T.StructType([T.StructField("user_id", T.LongType()), T.StructField("period", T.StringType())]))

STATION = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField(TEMPERATURE, T.DoubleType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One global series: a row per order date."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias(TIME))
        .agg(
            (exact_sum("o_totalprice") / 1e6).alias(PRECIPITATION),
            (F.max("o_totalprice") / 1e4).alias(TEMPERATURE),
        )
    )


def event_series(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Many series: a row per ``key`` and date of the events."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(key, F.col("ts").cast("date").alias(TIME))
        .agg(exact_sum("value").alias(PRECIPITATION), F.max("value").alias(TEMPERATURE))
    )


def with_gaps(df: DataFrame) -> DataFrame:
    """Nulls in the temperature on every 13th of a month, NaN in the precipitation on every 17th."""
    day = F.dayofmonth(TIME)
    return df.withColumns(
        {
            TEMPERATURE: F.when(day != 13, F.col(TEMPERATURE)),
            PRECIPITATION: F.when(day == 17, F.lit(float("nan"))).otherwise(F.col(PRECIPITATION)),
        }
    )


def as_documents(series: DataFrame, key: str) -> DataFrame:
    """One raw document per series and month: at most 31 entries an array."""
    entry = F.struct(TIME, TEMPERATURE, PRECIPITATION)
    entries = F.array_sort(F.collect_list(entry)).alias("_e")
    nested = series.groupBy(key, F.date_format(TIME, "yyyy-MM").alias("period")).agg(entries)
    return nested.select(
        key,
        "period",
        F.struct(
            F.transform("_e", lambda e: e[TIME].cast("string")).alias(TIME),
            F.transform("_e", lambda e: e[TEMPERATURE]).alias(TEMPERATURE),
            F.transform("_e", lambda e: e[PRECIPITATION]).alias(PRECIPITATION),
        ).alias("daily"),
    )


def land_files(documents: DataFrame) -> str:
    """Land each document as an indented JSON file of its own."""
    path = scratch_path(documents.sparkSession, "documents")
    text = F.to_json(F.struct(*documents.columns), {"pretty": "true"}).alias("value")
    documents.select(text).write.option("maxRecordsPerFile", 1).text(path)
    return path


def land_lines(documents: DataFrame) -> str:
    """Land documents one per line, many to a file."""
    path = scratch_path(documents.sparkSession, "documents")
    documents.write.json(path)
    return path


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A station for every customer, with column names that collide with the daily series."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("station_name"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey")).alias("date"),
        F.col("c_acctbal").alias(TEMPERATURE),
    )


def station_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two or three stations for every customer."""
    copies = F.explode(F.sequence(F.lit(0), 1 + F.col("user_id") % 2))
    return stations(spark, sf_dir).withColumn("copy", copies).withColumn("station_name", F.concat_ws(" ", "station_name", "copy")).drop("copy")


def odd_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with what a CSV file can lose: blanks at the ends, quotes, backslashes, empty texts and nulls."""
    kind = F.col("doc_id") % 5
    text = (
        F.when(kind == 0, F.lit(""))
        .when(kind == 1, F.lit(None))
        .when(kind == 2, F.concat(F.lit("  "), "text", F.lit(" ")))
        .when(kind == 3, F.concat(F.lit('"'), "text", F.lit('\\" ,""')))
        .otherwise(F.col("text"))
    )
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), "source")


def land_csv(df: DataFrame, *, multi_line: bool = False) -> str:
    path = scratch_path(df.sparkSession, "csv")
    write_csv(df, path, multi_line=multi_line)
    return path
