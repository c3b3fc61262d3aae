"""The jobs: raw to trusted, trusted to refined, a relational extract, and a gated run of both."""

from __future__ import annotations

import hashlib
import itertools
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.functions.columns import is_complete
from pluvia.operators import leastsquares, model
from pluvia.operators.joins import attach_stations
from pluvia.operators.reshape import drop_incomplete, feature_columns, parse_date, prefix_columns, unpivot_daily, with_label
from pluvia.operators.stats import describe_dates, describe_numeric, is_empty, preview, schema_report
from pluvia.operators.temporal import drop_boundary_rows, longest_series, series_features
from pluvia.schemas import PRECIPITATION, TEMPERATURE, TIME
from pluvia.schemas import document_schema as default_schema
from pluvia.session import materialise, scratch_scope
from pluvia.sources import folders, versions
from pluvia.sources.documents import read_documents
from pluvia.sources.sinks import write_csv, write_json, write_parquet, write_parquet_counted
from pluvia.sources.tables import read_csv, read_jdbc, read_parquet

COMPLETED = "COMPLETED"
SKIPPED_EMPTY = "SKIPPED_EMPTY"
FAILED = "FAILED"
NOT_RUN = "NOT_RUN"

CORRUPT = "_corrupt_record"

LOG_SCHEMA = T.StructType(
    [
        T.StructField("stage", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("rows", T.LongType()),
        T.StructField("undated", T.LongType()),
        T.StructField("incomplete", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("fan_out", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("message", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Outcome:
    """What a job did: its status and the rows it wrote.

    ``undated`` rows have no valid date: the ETL keeps them, the analysis leaves them out. ``incomplete`` rows have a
    date but lack a measure, and are left out by the analysis. ``rejected`` documents could not be
    parsed and were set aside. ``fan_out`` is the largest number of stations of one location.
    """

    status: str
    rows: int = 0
    undated: int = 0
    incomplete: int = 0
    rejected: int = 0
    fan_out: int | None = None


def extract(spark: SparkSession, url: str, table: str, out_path: str, **kwargs) -> Outcome:
    """Relational table to CSV in the raw zone. The rows go from executor to file."""
    rows = read_jdbc(spark, url, table, **kwargs)
    if is_empty(rows):
        return Outcome(SKIPPED_EMPTY)
    return Outcome(COMPLETED, write_csv(rows, out_path))


def etl(
    spark: SparkSession,
    documents_path: str,
    stations_path: str,
    trusted_path: str,
    keys: Sequence[str] = ("latitude", "longitude"),
    *,
    document_schema: T.StructType | None = None,
    stations_schema: T.StructType | None = None,
    multi_line: bool = True,
    mode: str = "FAILFAST",
    versioned: bool = False,
) -> Outcome:
    """Raw documents and stations to the trusted daily series. Old rows stay until the new ones are complete; with ``versioned`` they
    stay readable after that as well, and the trusted zone is read by ``versions.read``.

    ``keys`` are the document columns that name a location; the stations file has them too. A day
    that is no valid date is kept as a row without one, and counted. Without ``keys`` there is one series and
    nothing to join on: the weather rows are written as they are, and the stations beside them in
    ``<trusted_path>-stations``, a table of their own. With ``mode="PERMISSIVE"`` a document that cannot be
    parsed is counted and written to ``<trusted_path>-rejected`` instead of stopping the job.
    """
    schema, rejected = document_schema or default_schema(), 0
    if mode == "PERMISSIVE":
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    documents = read_documents(spark, documents_path, schema, multi_line=multi_line, mode=mode)
    if mode == "PERMISSIVE":
        rejected = write_json(documents.where(F.col(CORRUPT).isNotNull()), f"{trusted_path.rstrip('/')}-rejected")
        documents = documents.where(F.col(CORRUPT).isNull())
    weather = parse_date(unpivot_daily(documents, keys))
    if is_empty(weather):
        return Outcome(SKIPPED_EMPTY, rejected=rejected)
    stations, fan_out = read_csv(spark, stations_path, stations_schema), None
    if keys:
        fan_out = stations.groupBy(*keys).count().agg(F.coalesce(F.max("count"), F.lit(0)).alias("n")).first()["n"]
        weather = attach_stations(weather, stations, keys, costly_rows=True)
    else:
        write_parquet(prefix_columns(stations), f"{trusted_path.rstrip('/')}-stations")
    counts = {"undated": F.count_if(F.col(TIME).isNull())}
    written = versions.publish(weather, trusted_path, counts=counts).meta if versioned else write_parquet_counted(weather, trusted_path, **counts)
    return Outcome(COMPLETED, written["rows"], written["undated"], rejected=rejected, fan_out=fan_out)


def analyse(
    spark: SparkSession,
    trusted_path: str,
    refined_path: str,
    series: Sequence[str] = ("latitude", "longitude"),
    *,
    lags: int = 3,
    report: Callable[[str, DataFrame], None] = lambda title, df: None,
    versioned: bool = False,
) -> Outcome:
    """Trusted daily series to next-day predictions. A versioned trusted zone is read at its last version.

    ``series`` names one series. Rows that differ in their station columns only are one row here; after that
    (series, time) must be unique, and the job stops if it is not. Rows without a valid date or a
    measure are left out and counted.
    ``report`` is called with the schema, the first rows, the statistics and the coefficients, as
    frames that cost nothing unless it runs them.
    """
    columns = [*series, TIME, PRECIPITATION, TEMPERATURE]
    measures = [TIME, PRECIPITATION, TEMPERATURE]
    dated = parse_date(trusted(spark, trusted_path, columns))
    # Counts and the gate in one pass, over the measures only.
    complete, undated = is_complete(dated, measures), F.col(TIME).isNull()
    seen = dated.agg(
        *[F.count_if(c).alias(n) for n, c in (("complete", complete), ("undated", undated), ("incomplete", ~complete & ~undated))]
    ).first()
    left_out = {"undated": seen["undated"], "incomplete": seen["incomplete"]}
    if not seen["complete"]:
        return Outcome(SKIPPED_EMPTY, **left_out)
    # Stations repeat the rows of their location; copies are combined before the shuffle.
    daily = drop_incomplete(dated, measures).distinct()

    # Counted before the null drop: an upper bound, and only the key columns are read for it.
    longest = longest_series(trusted(spark, trusted_path, series), series) if series else None
    lagged = series_features(daily, series, lags=lags, repeats="_repeated", longest=longest)
    marked = materialise(lagged, "features")
    if not is_empty(marked.where("_repeated")):
        raise ValueError(f"({', '.join([*series, TIME])}) is not unique in {trusted_path}: lags are not defined")
    frame = drop_boundary_rows(marked.drop("_repeated"), lags=lags)
    if is_empty(frame):
        return Outcome(SKIPPED_EMPTY, **left_out)

    report("schema", schema_report(frame))
    report("first rows", preview(frame, [*series, TIME]))
    report("statistics", describe_numeric(frame, [c for c in frame.columns if c not in {*series, TIME}]))
    report("dates", describe_dates(frame, [TIME]))
    predictions, coefficients = predict(frame, series)
    report("coefficients", coefficients)
    rows = versions.publish(predictions, refined_path, "json").meta["rows"] if versioned else write_json(predictions, refined_path)
    return Outcome(COMPLETED, rows, **left_out)


def trusted(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Columns of the trusted zone, whether plain or versioned."""
    of = versions.version(spark, path)
    return read_parquet(spark, path, columns) if of is None else versions.read(spark, path, of.number).select(*columns)


def predict(frame: DataFrame, series: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Fit on a feature frame and score its own rows: (predictions, coefficients).

    Where inputs depend on each other, the model is the answer of least norm by ``leastsquares``.
    """
    features = feature_columns(frame, keys=series)
    keys = [*series, TIME]
    training = model.assemble(with_label(frame, features=features, keys=keys), features)
    fitted = model.fit(training)
    if not model.is_direct(fitted):
        exact = leastsquares.fit(training, features)
        terms = [*zip(exact.features, exact.coefficients, strict=True), ("intercept", exact.intercept)]
        scored = leastsquares.score(training, exact, "prediction")
        return model.refined(scored, features, keys), frame.sparkSession.createDataFrame(terms, "term string, coefficient double")
    scored = model.score(fitted, training)
    return model.refined(scored, features, keys), model.coefficients(fitted, frame, features)


RESUMED = "resumed: completed in an earlier run over the same inputs"


def fingerprint(spark: SparkSession, paths: Sequence[str], *options: object) -> str:
    """A mark of the files below ``paths`` (names, sizes, times of change; no content is read) and of ``options``."""
    marks = [str(options)]
    for path in paths:
        if not folders.exists(spark, path):
            marks.append("absent")
            continue
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        whole = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).cast("string")
        found = files.agg(F.count("*").alias("n"), F.sum("length").alias("size"), whole.alias("h")).first()
        marks.append(f"{found['n']}:{found['size']}:{found['h']}")
    return hashlib.sha256("|".join(marks).encode()).hexdigest()


def run(
    stages: Sequence[tuple[str, Callable[[], Outcome]]], spark: SparkSession, log_path: str | None = None, mark: str | None = None
) -> DataFrame:
    """Run stages in order, each only if the one before completed; one log row each. What a stage wrote to the scratch folder goes
    with it, so frames that ``report`` gets are to be used within the stage.

    With ``log_path`` the log is stored there after every stage, under ``mark``, a fingerprint of the inputs. A run that finds
    a log with its own mark does not repeat the stages that completed: it takes their rows from the log and starts at the first other.
    """
    log, going = _completed(spark, log_path, mark), True
    done = len(log)
    for name, stage in stages[done:]:
        if not going:
            log.append((name, NOT_RUN, *[None] * 7))
            continue
        began = time.monotonic()
        try:
            with scratch_scope(spark):
                outcome = stage()
            counts = (outcome.rows, outcome.undated, outcome.incomplete, outcome.rejected, outcome.fan_out)
            log.append((name, outcome.status, *counts, time.monotonic() - began, None))
            going = outcome.status == COMPLETED
        except Exception as error:  # a failed stage is a log row, whatever the cause
            log.append((name, FAILED, *[None] * 5, time.monotonic() - began, str(error).split("\n")[0]))
            going = False
        if log_path:
            versions.publish(spark.createDataFrame(log, LOG_SCHEMA).coalesce(1), log_path, "json", mark=mark, stages=[r[0] for r in log])
    return spark.createDataFrame(log, LOG_SCHEMA)


def _completed(spark: SparkSession, log_path: str | None, mark: str | None) -> list[tuple]:
    """Rows of the stages that need not run again."""
    last = versions.version(spark, log_path) if log_path else None
    if last is None or last.meta.get("mark") != mark:
        return []
    rows = {r["stage"]: r for r in versions.read(spark, log_path, last.number).collect()}
    completed = itertools.takewhile(lambda name: rows[name]["status"] == COMPLETED, last.meta["stages"])
    return [tuple(RESUMED if c == "message" else rows[name][c] for c in LOG_SCHEMA.names) for name in completed]


def raw_to_refined(
    spark: SparkSession,
    documents_path: str,
    stations_path: str,
    trusted_path: str,
    refined_path: str,
    keys: Sequence[str] = ("latitude", "longitude"),
    *,
    lags: int = 3,
    report: Callable[[str, DataFrame], None] = lambda title, df: None,
    ingest: Callable[[], Outcome] | None = None,
    versioned: bool = False,
    log_path: str | None = None,
    **etl_options,
) -> DataFrame:
    """ETL, then analysis; the run log as a DataFrame.

    ``ingest``, if given, is a first stage (an ``extract``, say) on which the others are gated. With ``log_path`` the log is kept
    there, and a run after one that failed starts at the stage that failed, unless the raw files or the options have changed.
    """
    inputs = [documents_path, *([] if ingest else [stations_path])]  # what an extract writes is no input
    mark = fingerprint(spark, inputs, trusted_path, refined_path, list(keys), lags, versioned, sorted(map(str, etl_options.items()))) if log_path else None
    return run(
        [
            *([("extract", ingest)] if ingest else []),
            ("etl", lambda: etl(spark, documents_path, stations_path, trusted_path, keys, versioned=versioned, **etl_options)),
            ("analyse", lambda: analyse(spark, trusted_path, refined_path, keys, lags=lags, report=report, versioned=versioned)),
        ],
        spark,
        log_path,
        mark,
    )
