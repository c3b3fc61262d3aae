"""Every registered query beside the SQL it is checked against.

A query takes (spark, sf_dir) and reads the tables in that folder whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.functions.columns import exact_sum
from pluvia.operators import drift, joins, keys, leastsquares, merge, model, quality, reshape, stats, temporal
from pluvia.plans import increments, inputs, jobs
from pluvia.plans import oracles as sql
from pluvia.schemas import DAILY_WEATHER, LOCATION, PRECIPITATION, PREDICTED, TARGET, TEMPERATURE, TIME
from pluvia.session import materialise, scratch_path
from pluvia.sources import sinks, tables, versions
from pluvia.sources.documents import read_documents

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def checked_by(oracle: str) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        ORACLES[query.__name__] = oracle
        return query

    return register


BY_DAY = "ORDER BY time"
BY_USER = "PARTITION BY user_id ORDER BY time"

# --- sources and sinks -------------------------------------------------------------------------


@checked_by(
    f"""WITH {sql.event_series("event_type")}
    SELECT event_type, strftime(time, '%Y-%m') AS period, CAST(count(*) AS BIGINT) AS times,
           CAST(count(*) AS BIGINT) AS temperatures, CAST(count(*) AS BIGINT) AS precipitations
    FROM e GROUP BY 1, 2"""
)
def scan_json_documents(spark, sf_dir):
    documents = inputs.as_documents(inputs.event_series(spark, sf_dir, "event_type"), "event_type")
    landed = read_documents(spark, inputs.land_files(documents), inputs.EVENT_DOCUMENT)
    return landed.select(
        "event_type",
        "period",
        F.size(f"daily.{TIME}").cast("long").alias("times"),
        F.size(f"daily.{TEMPERATURE}").cast("long").alias("temperatures"),
        F.size(f"daily.{PRECIPITATION}").cast("long").alias("precipitations"),
    )


@checked_by(f"WITH {sql.event_series('event_type')} SELECT event_type, time, temperature_2m_max, precipitation_sum FROM e")
def unpivot_daily(spark, sf_dir):
    documents = inputs.as_documents(inputs.event_series(spark, sf_dir, "event_type"), "event_type")
    landed = read_documents(spark, inputs.land_files(documents), inputs.EVENT_DOCUMENT)
    return reshape.parse_date(reshape.unpivot_daily(landed, ["event_type"]))


@checked_by(f"WITH {sql.event_series('user_id')} SELECT user_id, time, temperature_2m_max, precipitation_sum FROM e")
def unpivot_daily_lines(spark, sf_dir):
    documents = inputs.as_documents(inputs.event_series(spark, sf_dir, "user_id"), "user_id")
    landed = read_documents(spark, inputs.land_lines(documents), inputs.USER_DOCUMENT, multi_line=False)
    return reshape.parse_date(reshape.unpivot_daily(landed, ["user_id"]))


@checked_by(
    f"""WITH {sql.event_series("event_type")}
    SELECT event_type, time, temperature_2m_max,
           CASE WHEN time < max(time) OVER (PARTITION BY event_type, strftime(time, '%Y-%m')) THEN precipitation_sum END
             AS precipitation_sum
    FROM e"""
)
def zip_uneven_arrays(spark, sf_dir):
    documents = inputs.as_documents(inputs.event_series(spark, sf_dir, "event_type"), "event_type")
    shorter = F.expr(f"slice(daily.{PRECIPITATION}, 1, size(daily.{PRECIPITATION}) - 1)")
    uneven = documents.withColumn("daily", F.col("daily").withField(PRECIPITATION, shorter))
    return reshape.parse_date(reshape.unpivot_daily(uneven, ["event_type"]))


@checked_by("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_csv_stations(spark, sf_dir):
    source = inputs.table(spark, sf_dir, "supplier")
    return tables.read_csv(spark, inputs.land_csv(source), source.schema)


@checked_by(
    """SELECT c_custkey AS station_id, c_name AS station_name,
              CAST(DATE '2024-01-01' + c_nationkey AS DATE) AS date, c_acctbal AS temperature_2m_max
       FROM customer"""
)
def csv_dump(spark, sf_dir):
    written = inputs.land_csv(inputs.stations(spark, sf_dir).withColumnRenamed("user_id", "station_id"))
    return tables.read_csv(spark, written).withColumn("station_id", F.col("station_id").cast("long"))


@checked_by(
    r"""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '  ' || text || ' '
              WHEN 3 THEN '"' || text || '\" ,""' ELSE text END AS text, source
       FROM documents"""
)
def csv_text(spark, sf_dir):
    rows = inputs.odd_texts(spark, sf_dir)
    return tables.read_csv(spark, inputs.land_csv(rows, multi_line=True), rows.schema, multi_line=True)


@checked_by(f"WITH {sql.DAILY} SELECT time, precipitation_sum FROM d")
def scan_parquet_project(spark, sf_dir):
    path = scratch_path(spark, "trusted")
    sinks.write_parquet(inputs.daily_series(spark, sf_dir), path)
    return tables.read_parquet(spark, path, [TIME, PRECIPITATION])


@checked_by(f"WITH {sql.DAILY} SELECT time, precipitation_sum, temperature_2m_max FROM d")
def parquet_overwrite(spark, sf_dir):
    path = scratch_path(spark, "trusted")
    daily = inputs.daily_series(spark, sf_dir)
    sinks.write_parquet(daily.select(TIME), path)
    sinks.write_parquet(daily, path)
    return tables.read_parquet(spark, path)


@checked_by(f"WITH {sql.GAPPY} SELECT time, temperature_2m_max FROM g")
def json_overwrite(spark, sf_dir):
    path = scratch_path(spark, "refined")
    gappy = inputs.with_gaps(inputs.daily_series(spark, sf_dir))
    sinks.write_json(gappy, path, [TIME, TEMPERATURE])
    return spark.read.schema(f"{TIME} date, {TEMPERATURE} double").json(path)


STATION_TABLE = T.StructType(
    [
        T.StructField("station_id", T.LongType(), False, {"comment": "surrogate key"}),
        T.StructField("station_name", T.StringType(), True, {"comment": "name of the station"}),
        T.StructField("elevation", T.DecimalType(10, 2), True, {"comment": "elevation in metres"}),
    ]
)


def _supplier_table(spark, sf_dir):
    path = scratch_path(spark, "table")
    rows = inputs.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("station_id"), F.col("s_name").alias("station_name"), F.col("s_acctbal").alias("elevation")
    )
    name = path.rsplit("/", 1)[1].replace("-", "_")
    sinks.create_table(rows, name, STATION_TABLE, path)
    return name


@checked_by("SELECT s_suppkey AS station_id, s_name AS station_name, CAST(s_acctbal AS DECIMAL(10, 2)) AS elevation FROM supplier")
def typed_table(spark, sf_dir):
    return spark.table(_supplier_table(spark, sf_dir))


@checked_by(
    """SELECT row_number() OVER (ORDER BY user_id, CAST(ts AS DATE)) AS weather_id, user_id AS location_id,
              CAST(ts AS DATE) AS observation_date, CAST(max(value) AS DECIMAL(5, 2)) AS temperature_2m_max,
              CAST(min(value) AS DECIMAL(5, 2)) AS precipitation_sum, 'C' AS temperature_unit, 'mm' AS precipitation_unit
       FROM events GROUP BY user_id, CAST(ts AS DATE)"""
)
def daily_weather_table(spark, sf_dir):
    """The daily table with generated keys, declared types and comments."""
    days = (
        inputs.table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("location_id"), F.col("ts").cast("date").alias("observation_date"))
        .agg(F.max("value").alias(TEMPERATURE), F.min("value").alias(PRECIPITATION))
        .withColumns({"temperature_unit": F.lit("C"), "precipitation_unit": F.lit("mm")})
    )
    path = scratch_path(spark, "table")
    keyed = keys.surrogate_key(days, ["location_id", "observation_date"], "weather_id")
    return sinks.create_table(keyed, path.rsplit("/", 1)[1].replace("-", "_"), DAILY_WEATHER, path)


@checked_by(
    """SELECT row_number() OVER (ORDER BY s_suppkey) AS location_id, CAST(s_suppkey % 90 AS DECIMAL(9, 6)) AS latitude,
              CAST(s_nationkey AS DECIMAL(9, 6)) AS longitude, CAST(s_suppkey / 10.0 AS DECIMAL(10, 5)) AS generationtime_ms,
              CAST(s_nationkey * 60 AS INTEGER) AS utc_offset_seconds, s_name AS timezone, left(s_name, 3) AS timezone_abbreviation,
              CAST(s_acctbal AS DECIMAL(10, 2)) AS elevation,
              CASE WHEN s_acctbal >= 0 THEN TIMESTAMP '2024-01-01' END AS known_timestamp, true AS has_timestamp
       FROM supplier"""
)
def location_table(spark, sf_dir):
    """The location table with generated keys, declared text lengths, and the time of ingestion filled in on insert."""
    rows = inputs.table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        (F.col("s_suppkey") % 90).alias("latitude"),
        F.col("s_nationkey").alias("longitude"),
        (F.col("s_suppkey").cast("decimal(18,1)") / 10).alias("generationtime_ms"),
        (F.col("s_nationkey") * 60).alias("utc_offset_seconds"),
        F.col("s_name").alias("timezone"),
        F.left("s_name", F.lit(3)).alias("timezone_abbreviation"),
        F.col("s_acctbal").alias("elevation"),
        F.when(F.col("s_acctbal") >= 0, F.lit("2024-01-01").cast("timestamp")).alias("data_retrieval_timestamp"),
    )
    path = scratch_path(spark, "table")
    keyed = keys.surrogate_key(rows, ["s_suppkey"], "location_id")
    made = sinks.create_table(keyed, path.rsplit("/", 1)[1].replace("-", "_"), LOCATION, path)
    stamp = F.col("data_retrieval_timestamp")
    known = F.when(stamp == F.lit("2024-01-01").cast("timestamp"), stamp.cast("timestamp_ntz"))
    return made.select("*", known.alias("known_timestamp"), stamp.isNotNull().alias("has_timestamp")).drop("data_retrieval_timestamp")


@checked_by(
    """SELECT s_suppkey AS station_id, s_name AS station_name, CAST(s_acctbal AS DECIMAL(10, 2)) AS elevation FROM supplier
       UNION ALL SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(10, 2)) FROM customer"""
)
def insert_rows(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("station_id"), F.col("c_name").alias("station_name"), F.col("c_acctbal").alias("elevation")
    )
    return sinks.insert_rows(rows, _supplier_table(spark, sf_dir))


# --- projections, predicates, reports ----------------------------------------------------------


@checked_by(
    f"""WITH {sql.event_series("event_type")}
    SELECT event_type, time, temperature_2m_max AS station_temperature_2m_max, precipitation_sum AS station_precipitation_sum
    FROM e"""
)
def prefix_collisions(spark, sf_dir):
    return reshape.prefix_columns(inputs.event_series(spark, sf_dir, "event_type"))


@checked_by(
    f"""WITH {sql.event_series("user_id")}
    SELECT user_id, time, temperature_2m_max, precipitation_sum,
           {sql.lag_columns(BY_USER).replace("next_day_precipitation", "label")}
    FROM e"""
)
def rename_label(spark, sf_dir):
    return reshape.with_label(temporal.lag_features(inputs.event_series(spark, sf_dir, "user_id"), ["user_id"]))


@checked_by(
    f"""WITH {sql.DAILY}
    SELECT CASE WHEN day(time) <> 13 THEN time END AS time, day(time) = 13 AS rejected, precipitation_sum FROM d"""
)
def cast_date(spark, sf_dir):
    text = F.when(F.dayofmonth(TIME) == 13, F.lit("no date")).otherwise(F.col(TIME).cast("string"))
    raw = inputs.daily_series(spark, sf_dir).select(text.alias("text"), PRECIPITATION)
    parsed = reshape.parse_date(raw.withColumn(TIME, F.col("text")))
    return parsed.select(TIME, (F.col("text").isNotNull() & F.col(TIME).isNull()).alias("rejected"), PRECIPITATION)


@checked_by(
    f"""WITH {sql.DAILY}
    SELECT time, CAST(precipitation_sum AS REAL) AS precipitation_sum, CAST(temperature_2m_max AS REAL) AS temperature_2m_max
    FROM d"""
)
def cast_float(spark, sf_dir):
    return reshape.numeric_as_float(inputs.daily_series(spark, sf_dir))


@checked_by(
    f"""WITH {sql.event_series("user_id")}, f AS (SELECT *, {sql.lag_columns(BY_USER)} FROM e)
    SELECT {", ".join(sql.FEATURES)} FROM f"""
)
def feature_list(spark, sf_dir):
    frame = temporal.lag_features(inputs.event_series(spark, sf_dir, "user_id"), ["user_id"])
    return frame.select(*reshape.feature_columns(frame, keys=["user_id"]))


@checked_by(
    f"""WITH {sql.GAPPY}
    SELECT time, precipitation_sum, temperature_2m_max FROM g
    WHERE temperature_2m_max IS NOT NULL AND NOT isnan(precipitation_sum)"""
)
def drop_nulls(spark, sf_dir):
    return reshape.drop_incomplete(inputs.with_gaps(inputs.daily_series(spark, sf_dir)))


@checked_by(
    f"""WITH {sql.DAILY}
    SELECT 'daily' AS input, count(*) = 0 AS is_empty FROM d
    UNION ALL SELECT 'negative days', count(*) = 0 FROM d WHERE precipitation_sum < 0"""
)
def empty_gate(spark, sf_dir):
    daily = inputs.daily_series(spark, sf_dir)
    negative = daily.where(F.col(PRECIPITATION) < 0)
    return stats.emptiness(daily, "daily").unionByName(stats.emptiness(negative, "negative days"))


@checked_by(f"WITH {sql.DAILY} SELECT time, precipitation_sum, temperature_2m_max FROM d ORDER BY time LIMIT 5")
def preview(spark, sf_dir):
    return stats.preview(inputs.daily_series(spark, sf_dir), [TIME])


@checked_by(
    """SELECT 0 AS position, 'o_orderkey' AS name, 'bigint' AS type, true AS nullable, CAST(count(*) - count(o_orderkey) AS BIGINT) AS null_rows FROM orders
    UNION ALL SELECT 1, 'o_custkey', 'bigint', true, CAST(count(*) - count(o_custkey) AS BIGINT) FROM orders
    UNION ALL SELECT 2, 'o_orderstatus', 'string', true, CAST(count(*) - count(o_orderstatus) AS BIGINT) FROM orders
    UNION ALL SELECT 3, 'o_totalprice', 'double', true, CAST(count(*) - count(o_totalprice) AS BIGINT) FROM orders
    UNION ALL SELECT 4, 'o_orderdate', 'timestamp_ntz', true, CAST(count(*) - count(o_orderdate) AS BIGINT) FROM orders
    UNION ALL SELECT 5, 'o_orderpriority', 'string', true, CAST(count(*) - count(o_orderpriority) AS BIGINT) FROM orders"""
)
def schema_report(spark, sf_dir):
    return stats.schema_report(inputs.table(spark, sf_dir, "orders"))


# --- joins -------------------------------------------------------------------------------------


@checked_by(
    f"""WITH {sql.event_series("user_id")}
    SELECT user_id, time, temperature_2m_max, precipitation_sum, c_name AS station_name,
           CAST(DATE '2024-01-01' + c_nationkey AS DATE) AS station_date, c_acctbal AS station_temperature_2m_max
    FROM e LEFT JOIN customer ON user_id = c_custkey"""
)
def station_join(spark, sf_dir):
    weather = inputs.event_series(spark, sf_dir, "user_id")
    return joins.attach_stations(weather, inputs.stations(spark, sf_dir), ["user_id"])


@checked_by(
    """SELECT c_custkey, c_name, c_nationkey AS location_id, n_name, n_regionkey
       FROM customer JOIN nation ON c_nationkey = n_nationkey"""
)
def location_join(spark, sf_dir):
    child = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("location_id"))
    parent = inputs.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("location_id"), "n_name", "n_regionkey")
    return joins.join_parent(child, parent, ["location_id"])


# --- windows -----------------------------------------------------------------------------------


@checked_by(f"WITH {sql.event_series('user_id')} SELECT *, {sql.lag_columns(BY_USER)} FROM e")
def lag_features_series(spark, sf_dir):
    return temporal.lag_features(inputs.event_series(spark, sf_dir, "user_id"), ["user_id"])


@checked_by(f"WITH {sql.feature_frame(sql.event_series('user_id'), BY_USER, 'e')} SELECT * FROM f")
def lag_features_dropped(spark, sf_dir):
    return temporal.drop_boundary_rows(lag_features_series(spark, sf_dir))


@checked_by(f"WITH {sql.DAILY} SELECT *, {sql.lag_columns(BY_DAY)} FROM d")
def lag_features_global(spark, sf_dir):
    return temporal.lag_features_blocked(inputs.daily_series(spark, sf_dir))


@checked_by(
    f"""SELECT o_orderkey, o_orderdate AS time, o_totalprice AS precipitation_sum, o_totalprice / 1e4 AS temperature_2m_max,
           {sql.lag_columns("ORDER BY o_orderdate, o_orderkey", "o_totalprice", "o_totalprice / 1e4")}
    FROM orders"""
)
def lag_features_orders(spark, sf_dir):
    """Every order in one global series, with many orders on each date."""
    orders = inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").alias(TIME),
        F.col("o_totalprice").alias(PRECIPITATION),
        (F.col("o_totalprice") / 1e4).alias(TEMPERATURE),
    )
    return temporal.lag_features_blocked(orders, order=[TIME, "o_orderkey"])


@checked_by(
    f"""SELECT event_type, event_id, ts AS time, value AS precipitation_sum, user_id / 1e1 AS temperature_2m_max,
           {sql.lag_columns("PARTITION BY event_type ORDER BY ts, event_id", "value", "user_id / 1e1")}
    FROM events"""
)
def lag_features_events(spark, sf_dir):
    """Every event, in five series that each hold a large share of the rows."""
    events = inputs.table(spark, sf_dir, "events").select(
        "event_type",
        "event_id",
        F.col("ts").alias(TIME),
        F.col("value").alias(PRECIPITATION),
        (F.col("user_id") / 1e1).alias(TEMPERATURE),
    )
    return temporal.lag_features_blocked(events, ["event_type"], [TIME, "event_id"])


# --- statistics --------------------------------------------------------------------------------

_MEASURES = (PRECIPITATION, TEMPERATURE, TARGET, *sql.FEATURES[1:])


def _daily_features(spark, sf_dir):
    return temporal.drop_boundary_rows(temporal.lag_features_blocked(inputs.daily_series(spark, sf_dir)))


_DAILY_FEATURES_SQL = sql.feature_frame(sql.DAILY, BY_DAY, "d")


@checked_by(
    f"WITH {_DAILY_FEATURES_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS "count", round(avg({c}), 6) AS mean,
            round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max FROM f"""
        for c in _MEASURES
    )
)
def describe_numeric(spark, sf_dir):
    described = stats.describe_numeric(_daily_features(spark, sf_dir))
    return described.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


_LINEITEM_NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@checked_by(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS "count", round(avg({c}), 6) AS mean,
            round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
        for c in _LINEITEM_NUMBERS
    )
)
def describe_lineitem(spark, sf_dir):
    described = stats.describe_numeric(inputs.table(spark, sf_dir, "lineitem"))
    return described.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


@checked_by(
    f"""WITH {_DAILY_FEATURES_SQL}
    SELECT 'time' AS "column", CAST(count(time) AS BIGINT) AS "count", min(time) AS min, max(time) AS max FROM f"""
)
def describe_dates(spark, sf_dir):
    return stats.describe_dates(_daily_features(spark, sf_dir))


# --- regression --------------------------------------------------------------------------------


@checked_by(
    f"""WITH {sql.GAPPY}
    SELECT time, precipitation_sum, temperature_2m_max FROM g
    WHERE temperature_2m_max IS NOT NULL AND NOT isnan(precipitation_sum)"""
)
def skip_invalid_rows(spark, sf_dir):
    gappy = inputs.with_gaps(inputs.daily_series(spark, sf_dir))
    return model.assemble(gappy, [PRECIPITATION, TEMPERATURE]).drop("features")


@checked_by(f"WITH {_DAILY_FEATURES_SQL} SELECT time, {', '.join(f'{c} AS f{i}' for i, c in enumerate(sql.FEATURES))} FROM f")
def assemble_features(spark, sf_dir):
    frame = _daily_features(spark, sf_dir)
    features = reshape.feature_columns(frame)
    vectors = model.assemble(frame, features).select(TIME, "features")
    return model.vector_columns(vectors, [f"f{i}" for i in range(len(features))])


@checked_by(sql.coefficients(_DAILY_FEATURES_SQL))
def ols_coefficients(spark, sf_dir):
    _, coefficients = jobs.predict(materialise(_daily_features(spark, sf_dir), "features"))
    return coefficients.withColumn("coefficient", F.round("coefficient", 6))


@checked_by(sql.predictions(_DAILY_FEATURES_SQL, ["time"]))
def predict_next_day(spark, sf_dir):
    predictions, _ = jobs.predict(materialise(_daily_features(spark, sf_dir), "features"))
    return predictions.withColumn(PREDICTED, F.round(PREDICTED, 6))


@checked_by(sql.predictions(sql.feature_frame(sql.event_series("user_id"), BY_USER, "e"), ["user_id", "time"]))
def predict_next_day_series(spark, sf_dir):
    """One model over the rows of all series, as large as the data."""
    frame = materialise(lag_features_dropped(spark, sf_dir), "features")
    predictions, _ = jobs.predict(frame, ["user_id"])
    return predictions.withColumn(PREDICTED, F.round(PREDICTED, 6))


#: The temperature as a function of the precipitation: of the seven inputs four are independent.
_DEPENDENT = sql.feature_frame(
    f"{sql.DAILY}, d2 AS (SELECT time, precipitation_sum, 2 * precipitation_sum + 1 AS temperature_2m_max FROM d)", BY_DAY, "d2"
)
_INDEPENDENT = sql.FEATURES[:4]


def _dependent_sql() -> str:
    y, chains, rows = TARGET, [], []
    for i, x in enumerate(_INDEPENDENT):
        chains.append(sql.orthogonal([*[f for f in _INDEPENDENT if f != x], x], f"c{i}"))
        rows.append(f"SELECT {i} AS i, (SELECT regr_slope({y}, c{i}u3) FROM c{i}g3) AS b")
    # What the least norm makes of a coefficient on p where p and 2 p + 1 both are inputs: one and two fifths of it.
    shares = [f"SELECT '{_INDEPENDENT[0]}' AS term, b AS c FROM s WHERE i = 0"]
    shares += [f"SELECT 'precipitation_lag_{k}', b / 5 FROM s WHERE i = {k} UNION ALL SELECT 'temperature_lag_{k}', 2 * b / 5 FROM s WHERE i = {k}" for k in (1, 2, 3)]
    means = " UNION ALL ".join(f"SELECT '{x}' AS term, avg({x}) AS m FROM f" for x in sql.FEATURES)
    chain, union, share = ", ".join(chains), " UNION ALL ".join(rows), " UNION ALL ".join(shares)
    return f"""WITH {_DEPENDENT}, {chain}, s AS ({union}), terms AS ({share}), means AS ({means})
SELECT term, round(c, 6) AS coefficient, 4 AS rank FROM terms
UNION ALL SELECT 'intercept', round((SELECT avg({y}) FROM f) - sum(c * m), 6), 4 FROM terms JOIN means USING (term)"""


@checked_by(_dependent_sql())
def ols_dependent_inputs(spark, sf_dir):
    """Inputs that depend on each other: the answer of least norm, and the rank."""
    daily = inputs.daily_series(spark, sf_dir).withColumn(TEMPERATURE, 2 * F.col(PRECIPITATION) + 1)
    frame = materialise(temporal.drop_boundary_rows(temporal.lag_features_blocked(daily)), "features")
    fitted = leastsquares.fit(frame, list(sql.FEATURES), TARGET)
    terms = [*zip(fitted.features, fitted.coefficients, strict=True), ("intercept", fitted.intercept)]
    rows = spark.createDataFrame([(t, c, fitted.rank) for t, c in terms], "term string, coefficient double, rank int")
    return rows.withColumn("coefficient", F.round("coefficient", 6))


@checked_by(
    f"""WITH {_DAILY_FEATURES_SQL}, {sql.orthogonal(sql.FEATURES, "")}
    SELECT time, round((SELECT avg({TARGET}) FROM f){"".join(f" + (SELECT regr_slope({TARGET}, u{j}) FROM g6) * u{j}" for j in range(7))}, 6) AS {PREDICTED} FROM g6"""
)
def predict_by_qr(spark, sf_dir):
    """Next-day predictions from the distributed QR."""
    frame = materialise(_daily_features(spark, sf_dir), "features")
    fitted = leastsquares.fit(frame, list(sql.FEATURES), TARGET)
    return frame.select(TIME, F.round(fitted.predict(), 6).alias(PREDICTED))


_LINE_FEATURES = ["l_quantity", "l_discount", "l_tax"]


@checked_by(f"WITH {sql.grouped_coefficients('lineitem', 'l_suppkey', _LINE_FEATURES, 'l_extendedprice', leastsquares.TOLERANCE_OF_VARIANCE)}")
def ols_by_supplier(spark, sf_dir):
    """One model for each supplier."""
    return _rounded(leastsquares.fit_each(inputs.table(spark, sf_dir, "lineitem"), ["l_suppkey"], _LINE_FEATURES, "l_extendedprice"))


def _rounded(models):
    doubles = [n for n, kind in models.dtypes if kind == "double"]
    return models.withColumns({c: F.round(c, 6) for c in doubles})


@checked_by(
    f"""WITH {sql.event_series("user_id")}, h AS (SELECT user_id, temperature_2m_max, precipitation_sum, CAST(day(time) AS DOUBLE) AS day FROM e),
    {sql.grouped_coefficients("h", "user_id", ["day", "precipitation_sum"], "temperature_2m_max", leastsquares.TOLERANCE_OF_VARIANCE)}"""
)
def ols_by_user(spark, sf_dir):
    """One model for each user, many of whom have too few days for one."""
    series = inputs.event_series(spark, sf_dir, "user_id").withColumn("day", F.dayofmonth(TIME).cast("double"))
    return _rounded(leastsquares.fit_each(series, ["user_id"], ["day", PRECIPITATION], TEMPERATURE))


# --- table rules -------------------------------------------------------------------------------


@checked_by(
    f"""WITH {sql.GAPPY}
    SELECT 'time' AS "column", CAST(count(*) - count(time) AS BIGINT) AS null_rows FROM g
    UNION ALL SELECT 'temperature_2m_max', count(*) - count(temperature_2m_max) FROM g
    UNION ALL SELECT 'precipitation_sum', count(*) - count(precipitation_sum) FROM g"""
)
def dq_not_null(spark, sf_dir):
    return quality.null_counts(inputs.with_gaps(inputs.daily_series(spark, sf_dir)), [TIME, TEMPERATURE, PRECIPITATION])


@checked_by(
    f"""WITH {sql.GAPPY}
    SELECT time, precipitation_sum, temperature_2m_max, 'temperature_2m_max' AS nulls FROM g WHERE temperature_2m_max IS NULL"""
)
def dq_not_null_rows(spark, sf_dir):
    return quality.null_rows(inputs.with_gaps(inputs.daily_series(spark, sf_dir)), [TIME, TEMPERATURE, PRECIPITATION])


@checked_by("SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1 OR l_orderkey IS NULL")
def dq_primary_key(spark, sf_dir):
    return quality.key_violations(inputs.table(spark, sf_dir, "lineitem"), ["l_orderkey"])


@checked_by("SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique(spark, sf_dir):
    return quality.key_violations(inputs.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@checked_by(
    """SELECT * EXCLUDE (rn) FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey,
           l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem)
       WHERE rn = 1"""
)
def dq_unique_repair(spark, sf_dir):
    return quality.keep_one_per_key(inputs.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@checked_by("SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def dq_orphans(spark, sf_dir):
    child = inputs.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return quality.orphans(child, inputs.table(spark, sf_dir, "labels"), ["doc_id"])


@checked_by(
    """SELECT l_orderkey, l_linenumber, l_extendedprice, 'l_extendedprice' AS misfits
       FROM lineitem WHERE abs(l_extendedprice) >= 99999.995"""
)
def dq_type_fit(spark, sf_dir):
    declared = T.StructType([T.StructField("l_extendedprice", T.DecimalType(7, 2))])
    rows = inputs.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return quality.type_misfits(rows, declared)


@checked_by(
    """SELECT c_custkey, c_name, c_mktsegment, c_acctbal,
         concat_ws(',', CASE WHEN length(c_mktsegment) > 9 THEN 'c_mktsegment' END,
                        CASE WHEN abs(c_acctbal) >= 999.995 THEN 'c_acctbal' END) AS misfits
       FROM customer WHERE length(c_mktsegment) > 9 OR abs(c_acctbal) >= 999.995"""
)
def dq_text_fit(spark, sf_dir):
    declared = T.StructType([T.StructField("c_mktsegment", T.StringType()), T.StructField("c_acctbal", T.DecimalType(5, 2))])
    rows = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    return quality.type_misfits(rows, declared, {"c_mktsegment": 9})


@checked_by("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def dq_cascade(spark, sf_dir):
    child = inputs.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey"), "o_totalprice")
    customers = inputs.table(spark, sf_dir, "customer")
    deleted = customers.where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return quality.cascade_delete(child, deleted, ["o_custkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


@checked_by("SELECT row_number() OVER (ORDER BY c_acctbal, c_custkey) AS location_id, c_custkey, c_name, c_acctbal FROM customer")
def dq_surrogate_key(spark, sf_dir):
    customers = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return keys.surrogate_key(customers, ["c_acctbal", "c_custkey"], "location_id")


@checked_by(
    """SELECT event_id, value < 1 AS was_missing, true AS is_filled,
              CASE WHEN value >= 1 THEN ts END AS kept
       FROM events"""
)
def dq_default_timestamp(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events").select("event_id", F.when(F.col("value") >= 1, F.col("ts")).alias("ts"))
    before = events.withColumn("kept", F.col("ts"))
    filled = quality.default_timestamp(before, "ts")
    return filled.select("event_id", F.col("kept").isNull().alias("was_missing"), F.col("ts").isNotNull().alias("is_filled"), "kept")


# --- stored tables -----------------------------------------------------------------------------


def _failing(df, column):
    """The rows, of which some cannot be computed."""
    return df.withColumn(column, F.when(F.dayofmonth(TIME) == 28, F.raise_error(F.lit("not to be computed")).cast("double")).otherwise(F.col(column)))


def _attempt(job) -> None:
    """Run a job that is meant to fail."""
    try:
        job()
    except Exception as failure:  # whatever class the failed task comes back as
        if "not to be computed" not in str(failure):
            raise


@checked_by(ORACLES["scan_parquet_project"])
def failed_overwrite(spark, sf_dir):
    """The rows of a folder after an overwrite that failed half-way."""
    path = scratch_path(spark, "trusted")
    daily = inputs.daily_series(spark, sf_dir)
    sinks.write_parquet(daily.drop(TEMPERATURE), path)
    _attempt(lambda: sinks.write_parquet(_failing(daily, PRECIPITATION), path))
    return tables.read_parquet(spark, path)


@checked_by(ORACLES["json_overwrite"])
def failed_version(spark, sf_dir):
    """The last version of JSON lines after a further one that failed half-way."""
    path = scratch_path(spark, "refined")
    gappy = inputs.with_gaps(inputs.daily_series(spark, sf_dir)).select(TIME, TEMPERATURE)
    versions.publish(gappy.limit(3), path, "json")
    versions.publish(gappy, path, "json")
    _attempt(lambda: versions.publish(_failing(gappy, TEMPERATURE), path, "json"))
    return versions.read(spark, path)


#: Two deliveries that overlap in two years of shipping dates; together they are the whole table.
DELIVERIES = ("l_shipdate < date'1999-01-01'", "l_shipdate >= date'1997-01-01'")
_LINE_KEY = ["l_orderkey", "l_linenumber"]
_LINE_SCHEMA = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_suppkey", T.LongType()),
        T.StructField("l_quantity", T.DoubleType(), False),
        T.StructField("l_extendedprice", T.DecimalType(7, 2)),
        T.StructField("l_shipdate", T.DateType()),
    ]
)


def _deliveries(spark, sf_dir, on_conflict):
    """Insert both deliveries into a new table: (its path, what each insert did)."""
    lines = inputs.table(spark, sf_dir, "lineitem").select(
        *_LINE_KEY, "l_suppkey", F.when((F.col("l_linenumber") != 7) | (F.col("l_discount") > 0.01), F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice", F.col("l_shipdate").cast("date").alias("l_shipdate"),
    )
    parents = inputs.table(spark, sf_dir, "supplier").where("s_acctbal >= 0")
    rules = merge.Rules(_LINE_SCHEMA, _LINE_KEY, references=[merge.Reference(["l_suppkey"], parents, ["s_suppkey"])])
    path = scratch_path(spark, "table")
    return path, [merge.insert(spark, lines.where(part), path, rules, on_conflict, ["l_shipdate"]) for part in DELIVERIES]


def _deliveries_sql(newest: bool) -> str:
    """CTEs: l, rows with the rule each breaks by itself; d1 and d2, the deliveries with ``place`` 1 for the row of a key that counts."""
    way = "DESC" if newest else "ASC"
    place = f"row_number() OVER (PARTITION BY l_orderkey, l_linenumber, rule IS NULL ORDER BY l_shipdate {way}, l_suppkey {way}, l_quantity {way}, l_extendedprice {way})"
    return f"""
    r AS (SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_linenumber <> 7 OR l_discount > 0.01 THEN l_quantity END AS l_quantity,
                 l_extendedprice, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem),
    l AS (SELECT *, CASE WHEN l_quantity IS NULL THEN 'not null (l_quantity)' WHEN abs(l_extendedprice) >= 99999.995 THEN 'type (l_extendedprice)'
                         WHEN l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) THEN 'foreign key (l_suppkey)' END AS rule FROM r),
    d1 AS (SELECT *, {place} AS place FROM l WHERE l_shipdate < DATE '1999-01-01'),
    d2 AS (SELECT *, {place} AS place FROM l WHERE l_shipdate >= DATE '1997-01-01'),
    s1 AS (SELECT * FROM d1 WHERE rule IS NULL AND place = 1),
    s2 AS (SELECT *, EXISTS (SELECT 1 FROM s1 WHERE s1.l_orderkey = d2.l_orderkey AND s1.l_linenumber = d2.l_linenumber) AS known
           FROM d2 WHERE rule IS NULL AND place = 1)"""


_LINE_COLUMNS = "l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_shipdate"


@checked_by(f"WITH {_deliveries_sql(False)} SELECT {_LINE_COLUMNS} FROM s1 UNION ALL SELECT {_LINE_COLUMNS} FROM s2 WHERE NOT known")
def merge_reject(spark, sf_dir):
    """The table after two overlapping deliveries, rows with a stored key rejected."""
    path, _ = _deliveries(spark, sf_dir, merge.REJECT)
    return versions.read(spark, path).withColumn("l_extendedprice", F.col("l_extendedprice").cast("double"))


@checked_by(
    f"""WITH {_deliveries_sql(False)}, u AS (
      SELECT 1 AS delivery, *, false AS known FROM d1
      UNION ALL SELECT 2, d2.*, place = 1 AND rule IS NULL AND EXISTS (SELECT 1 FROM s1 WHERE s1.l_orderkey = d2.l_orderkey AND s1.l_linenumber = d2.l_linenumber) FROM d2)
    SELECT delivery, {_LINE_COLUMNS}, coalesce(rule, 'unique (l_orderkey, l_linenumber)') AS rule FROM u WHERE rule IS NOT NULL OR place > 1 OR known"""
)
def merge_rejects(spark, sf_dir):
    """The rejected rows of both deliveries with the rule that each breaks first."""
    _, done = _deliveries(spark, sf_dir, merge.REJECT)
    first, second = [d.rejects.withColumn("delivery", F.lit(i)) for i, d in enumerate(done, 1)]
    return first.unionByName(second)


@checked_by(
    f"""WITH {_deliveries_sql(True)} SELECT {_LINE_COLUMNS} FROM s2
    UNION ALL SELECT {_LINE_COLUMNS} FROM s1 WHERE NOT EXISTS (SELECT 1 FROM s2 WHERE s1.l_orderkey = s2.l_orderkey AND s1.l_linenumber = s2.l_linenumber)"""
)
def merge_replace(spark, sf_dir):
    """The table after two overlapping deliveries, stored rows replaced by later ones of their key."""
    path, _ = _deliveries(spark, sf_dir, merge.REPLACE)
    return versions.read(spark, path).withColumn("l_extendedprice", F.col("l_extendedprice").cast("double"))


@checked_by(
    f"""WITH {_deliveries_sql(False)}
    SELECT 1 AS delivery, CAST((SELECT count(*) FROM s1) AS BIGINT) AS inserted, CAST(count(*) FILTER (WHERE rule IS NULL AND place > 1) AS BIGINT) AS kept,
           CAST(count(rule) AS BIGINT) AS rejected FROM d1
    UNION ALL SELECT 2, (SELECT count(*) FROM s2 WHERE NOT known), (SELECT count(*) FROM s2 WHERE known) + count(*) FILTER (WHERE rule IS NULL AND place > 1), count(rule) FROM d2"""
)
def merge_keep(spark, sf_dir):
    """What two overlapping deliveries do where the stored row of a key is kept."""
    _, done = _deliveries(spark, sf_dir, merge.KEEP)
    return spark.createDataFrame([(i, d.inserted, d.kept, d.rejected) for i, d in enumerate(done, 1)], "delivery int, inserted long, kept long, rejected long")


@checked_by(
    """WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events GROUP BY 1, 2), n AS (SELECT count(*) FILTER (WHERE day < DATE '2024-01-16') AS n FROM e)
    SELECT day >= DATE '2024-01-16' AS later, CAST(count(*) AS BIGINT) AS "rows",
           CAST(CASE WHEN later THEN any_value(n) + 1 ELSE 1 END AS BIGINT) AS first_id,
           CAST(CASE WHEN later THEN any_value(n) + count(*) ELSE count(*) END AS BIGINT) AS last_id, CAST(count(*) AS BIGINT) AS ids
    FROM e, n GROUP BY 1"""
)
def serial_across_loads(spark, sf_dir):
    """Generated keys of the daily table over two loads: the second goes on where the first ended."""
    days = (
        inputs.table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("location_id"), F.col("ts").cast("date").alias("observation_date"))
        .agg(F.max("value").alias(TEMPERATURE), F.min("value").alias(PRECIPITATION))
        .withColumns({"temperature_unit": F.lit("C"), "precipitation_unit": F.lit("mm")})
    )
    path = scratch_path(spark, "table")
    rules = merge.Rules(DAILY_WEATHER, ["weather_id"], [["location_id", "observation_date"]], serial="weather_id")
    later = F.col("observation_date") >= "2024-01-16"
    for part in (~later, later):
        merge.insert(spark, days.where(part), path, rules)
    key = F.col("weather_id")
    return versions.read(spark, path).groupBy(later.alias("later")).agg(
        F.count("*").alias("rows"), F.min(key).alias("first_id"), F.max(key).alias("last_id"), F.count_distinct(key).alias("ids")
    )


@checked_by(ORACLES["dq_cascade"])
def cascade_stored(spark, sf_dir):
    """Stored orders after stored customers are deleted with what refers to them."""
    customers, orders = scratch_path(spark, "customers"), scratch_path(spark, "orders")
    rows = inputs.table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    versions.publish(rows, customers)
    versions.publish(inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), orders)
    versions.delete_cascading(spark, customers, orders, rows.where("c_acctbal < 0"), ["o_custkey"])
    return versions.read(spark, orders)


# --- jobs --------------------------------------------------------------------------------------


def _land(spark, sf_dir):
    documents = inputs.as_documents(inputs.event_series(spark, sf_dir, "user_id"), "user_id")
    return inputs.land_lines(documents), inputs.land_csv(inputs.stations(spark, sf_dir))


_ETL_OPTIONS = {"document_schema": inputs.USER_DOCUMENT, "stations_schema": inputs.STATION, "multi_line": False}


@checked_by(ORACLES["station_join"])
def etl_trusted(spark, sf_dir):
    documents, stations = _land(spark, sf_dir)
    trusted = scratch_path(spark, "trusted")
    jobs.etl(spark, documents, stations, trusted, ["user_id"], **_ETL_OPTIONS)
    return tables.read_parquet(spark, trusted)


@checked_by(ORACLES["predict_next_day_series"])
def analyse_refined(spark, sf_dir):
    trusted, refined = scratch_path(spark, "trusted"), scratch_path(spark, "refined")
    sinks.write_parquet(inputs.event_series(spark, sf_dir, "user_id"), trusted)
    jobs.analyse(spark, trusted, refined, ["user_id"])
    names = [*sql.FEATURES, "actual_next_day_precipitation", PREDICTED]
    schema = f"user_id long, {TIME} date, " + ", ".join(f"{c} double" for c in names)
    return spark.read.schema(schema).json(refined).withColumn(PREDICTED, F.round(PREDICTED, 6))


@checked_by(
    f"""WITH {sql.feature_frame(sql.event_series("user_id"), BY_USER, "e")}
    SELECT 'etl' AS stage, 'COMPLETED' AS status, CAST(count(*) AS BIGINT) AS "rows" FROM e LEFT JOIN customer ON user_id = c_custkey
    UNION ALL SELECT 'analyse', 'COMPLETED', CAST(count(*) AS BIGINT) FROM f"""
)
def run_log(spark, sf_dir):
    documents, stations = _land(spark, sf_dir)
    trusted, refined = scratch_path(spark, "trusted"), scratch_path(spark, "refined")
    log = jobs.raw_to_refined(spark, documents, stations, trusted, refined, ["user_id"], **_ETL_OPTIONS)
    return log.select("stage", "status", "rows")


@checked_by(ORACLES["predict_next_day_series"])
def analyse_many_stations(spark, sf_dir):
    """ETL with two or three stations a location, then the analysis: stations change nothing in it."""
    documents, _ = _land(spark, sf_dir)
    stations = inputs.land_csv(inputs.station_copies(spark, sf_dir))
    trusted, refined = scratch_path(spark, "trusted"), scratch_path(spark, "refined")
    jobs.raw_to_refined(spark, documents, stations, trusted, refined, ["user_id"], **_ETL_OPTIONS)
    names = [*sql.FEATURES, "actual_next_day_precipitation", PREDICTED]
    schema = f"user_id long, {TIME} date, " + ", ".join(f"{c} double" for c in names)
    return spark.read.schema(schema).json(refined).withColumn(PREDICTED, F.round(PREDICTED, 6))


@checked_by(
    f"""WITH {sql.event_series("user_id")}
    SELECT 'COMPLETED' AS status, CAST(count(*) FILTER (WHERE day(time) = 13) AS BIGINT) AS undated,
           CAST(count(*) FILTER (WHERE day(time) = 17) AS BIGINT) AS incomplete
    FROM e"""
)
def analyse_left_out(spark, sf_dir):
    """Rows that the analysis leaves out, as its log counts them: no valid date on every 13th, no measure on every 17th."""
    trusted, refined = scratch_path(spark, "trusted"), scratch_path(spark, "refined")
    series = inputs.event_series(spark, sf_dir, "user_id")
    day = F.dayofmonth(TIME)
    spoilt = series.withColumns(
        {
            TIME: F.when(day == 13, F.lit("no date")).otherwise(F.col(TIME).cast("string")),
            PRECIPITATION: F.when(day == 17, F.lit(float("nan"))).otherwise(F.col(PRECIPITATION)),
        }
    )
    sinks.write_parquet(spoilt, trusted)
    log = jobs.run([("analyse", lambda: jobs.analyse(spark, trusted, refined, ["user_id"]))], spark)
    return log.select("status", "undated", "incomplete")


_PRIORITY = """
p AS (
  SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS time, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) / 1e6 AS amount,
         max(o_totalprice) / 1e4 AS temperature_2m_max
  FROM orders GROUP BY 1, 2
), q AS (
  SELECT o_orderpriority, time, CASE WHEN strftime(time, '%Y-%m') = '1996-06' THEN amount + 1 ELSE amount END AS precipitation_sum, temperature_2m_max FROM p
)"""


def priority_days(spark, sf_dir):
    """Five daily series over the whole calendar."""
    return (
        inputs.table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority", F.col("o_orderdate").cast("date").alias(TIME))
        .agg((exact_sum("o_totalprice") / 1e6).alias(PRECIPITATION), (F.max("o_totalprice") / 1e4).alias(TEMPERATURE))
    )


@checked_by(
    f"WITH {sql.feature_frame(_PRIORITY, 'PARTITION BY o_orderpriority ORDER BY time', 'q')} "
    f"SELECT o_orderpriority, time, precipitation_sum, temperature_2m_max, {TARGET}, {', '.join(sql.FEATURES[1:])} FROM f"
)
def increment_features(spark, sf_dir):
    """Features after a first load, the days since, and a month that is delivered again with other values."""
    days = materialise(priority_days(spark, sf_dir), "days")
    trusted, features = scratch_path(spark, "trusted"), scratch_path(spark, "features")
    again = days.where(F.date_format(TIME, "yyyy-MM") == "1996-06").withColumn(PRECIPITATION, F.col(PRECIPITATION) + 1)
    for part in (days.where(F.col(TIME) < "1998-01-01"), days.where(F.col(TIME) >= "1998-01-01"), again):
        increments.add_days(spark, part, trusted, features, ["o_orderpriority"])
    return spark.read.parquet(features).drop(increments.MONTH)


@checked_by(ORACLES["lag_features_series"])
def lag_features_bucketed(spark, sf_dir):
    """Lags over a table bucketed by series: the window needs no shuffle."""
    path = scratch_path(spark, "bucketed")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    users = sinks.write_bucketed(inputs.event_series(spark, sf_dir, "user_id"), name, ["user_id"], [TIME], 8, path)
    return temporal.lag_features(users, ["user_id"])


@checked_by(
    f"""WITH {sql.feature_frame(sql.event_series("user_id"), BY_USER, "e")},
    etl AS (SELECT CAST(count(*) AS BIGINT) AS n FROM e LEFT JOIN customer ON user_id = c_custkey), fit AS (SELECT CAST(count(*) AS BIGINT) AS n FROM f)
    SELECT 1 AS attempt, 'etl' AS stage, 'COMPLETED' AS status, n AS "rows", false AS resumed FROM etl
    UNION ALL SELECT 1, 'analyse', 'FAILED', NULL, false
    UNION ALL SELECT 2, 'etl', 'COMPLETED', n, true FROM etl
    UNION ALL SELECT 2, 'analyse', 'COMPLETED', n, false FROM fit"""
)
def run_resumed(spark, sf_dir):
    """A run that fails in its second stage, and one after it that starts there."""
    documents, stations = _land(spark, sf_dir)
    trusted, refined, log = (scratch_path(spark, name) for name in ("trusted", "refined", "log"))
    mark = jobs.fingerprint(spark, [documents, stations])

    def stages(analyse):
        return [("etl", lambda: jobs.etl(spark, documents, stations, trusted, ["user_id"], **_ETL_OPTIONS)), ("analyse", analyse)]

    attempts = [
        jobs.run(stages(lambda: jobs.analyse(spark, f"{trusted}-mistyped", refined, ["user_id"])), spark, log, mark),
        jobs.run(stages(lambda: jobs.analyse(spark, trusted, refined, ["user_id"])), spark, log, mark),
    ]
    resumed = F.coalesce(F.col("message") == jobs.RESUMED, F.lit(False))
    first, second = [a.select(F.lit(i).alias("attempt"), "stage", "status", "rows", resumed.alias("resumed")) for i, a in enumerate(attempts, 1)]
    return first.unionByName(second)


@checked_by(
    """WITH e AS (SELECT DISTINCT user_id, strftime(ts, '%Y-%m') AS period FROM events)
    SELECT 'user_id' AS path, 'retyped' AS change, 'bigint' AS declared, 'STRING' AS found, CAST(count(*) AS BIGINT) AS documents FROM e WHERE user_id % 5 = 0
    UNION ALL SELECT 'period', 'lost', 'string', NULL, CAST(count(*) AS BIGINT) FROM e WHERE user_id % 7 = 0
    UNION ALL SELECT 'daily.humidity', 'added', NULL, 'array<bigint>', NULL WHERE EXISTS (SELECT 1 FROM e WHERE user_id % 3 = 0)
    UNION ALL SELECT 'source', 'added', NULL, 'string', NULL WHERE EXISTS (SELECT 1 FROM e WHERE user_id % 3 = 0)"""
)
def document_drift(spark, sf_dir):
    """Documents of three generations against the declared schema: one field text, one gone, two new."""
    documents = inputs.as_documents(inputs.event_series(spark, sf_dir, "user_id"), "user_id")
    user, new = F.col("user_id"), F.col("user_id") % 3 == 0
    daily = F.struct("daily.*", F.when(new, F.transform(f"daily.{TEMPERATURE}", lambda t: F.lit(1))).alias("humidity"))
    rest = [F.when(user % 7 != 0, F.col("period")).alias("period"), daily.alias("daily"), F.when(new, F.lit("b")).alias("source")]
    text = F.when(user % 5 == 0, F.to_json(F.struct(user.cast("string").alias("user_id"), *rest))).otherwise(F.to_json(F.struct(user, *rest)))
    path = scratch_path(spark, "documents")
    documents.select(text.alias("value")).write.text(path)
    return drift.drift(spark.read.text(path), inputs.USER_DOCUMENT)
