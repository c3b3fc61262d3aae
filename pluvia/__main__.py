"""Command line for spark-submit: ``python -m pluvia {etl,analyse,run,add} ...``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pluvia.plans import increments, jobs
from pluvia.schemas import document_schema
from pluvia.session import build_session


def show(title: str, df: DataFrame) -> None:
    """Print every row of a report. Reports have one row for each column or stage, so they are small."""
    print(title)
    print("\t".join(df.columns))
    for row in df.collect():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="pluvia")
    commands = parser.add_subparsers(dest="command", required=True)

    etl = commands.add_parser("etl", help="raw documents and stations to the trusted zone")
    analyse = commands.add_parser("analyse", help="trusted zone to predictions")
    run = commands.add_parser("run", help="both, each gated on the one before")
    add = commands.add_parser("add", help="later documents to a trusted zone by month and its features")
    for command in (etl, run, add):
        command.add_argument("documents")
        if command is not add:
            command.add_argument("stations")
        command.add_argument("--json-lines", action="store_true", help="one document per line instead of per file")
        command.add_argument("--document-schema", type=T.StructType.fromDDL, help="fields of a document before daily, as DDL")
        if command is not add:
            command.add_argument("--stations-schema", type=T.StructType.fromDDL, help="columns of the stations file, as DDL")
            command.add_argument("--mode", choices=["FAILFAST", "PERMISSIVE"], default="FAILFAST", help="what a broken document does")
    for command in (etl, analyse, run, add):
        command.add_argument("trusted")
        if command is not add:
            command.add_argument("--versions", action="store_true", help="write each zone as a new version of itself")
        command.add_argument("--series", default="latitude,longitude", help="columns that name a series")
    add.add_argument("features")
    for command in (analyse, run):
        command.add_argument("refined")
    for command in (analyse, run, add):
        command.add_argument("--lags", type=int, default=3)

    run.add_argument("--log", help="folder of the run log; a run after a failure goes on where it failed")
    run.add_argument("--extract", nargs=2, metavar=("URL", "TABLE"), help="first write this JDBC table to the stations folder")

    args = parser.parse_args(argv)
    spark = build_session()
    series = [name for name in args.series.split(",") if name]
    schema = document_schema(args.document_schema) if getattr(args, "document_schema", None) else None
    if args.command == "add":
        done = increments.add_documents(
            spark, args.documents, args.trusted, args.features, series, lags=args.lags, document_schema=schema, multi_line=not args.json_lines
        )
        print(f"changed: {', '.join(done.changed)}\nfeatures made anew: {', '.join(done.remade)}\nrows without a date: {done.undated}")
        return 0
    options = {}
    if args.command != "analyse":
        options = {
            "document_schema": schema,
            "stations_schema": args.stations_schema,
            "multi_line": not args.json_lines,
            "mode": args.mode,
        }
    if args.command == "analyse":
        log = jobs.run([("analyse", lambda: jobs.analyse(spark, args.trusted, args.refined, series, lags=args.lags, report=show, versioned=args.versions))], spark)
    elif args.command == "etl":
        log = jobs.run(
            [("etl", lambda: jobs.etl(spark, args.documents, args.stations, args.trusted, series, versioned=args.versions, **options))],
            spark,
        )
    else:
        log = jobs.raw_to_refined(
            spark, args.documents, args.stations, args.trusted, args.refined, series,
            lags=args.lags, report=show, ingest=args.extract and (lambda: jobs.extract(spark, *args.extract, args.stations)), versioned=args.versions, log_path=args.log, **options,
        )
    show("run", log)
    return 0 if log.where(log.status == jobs.FAILED).isEmpty() else 1


if __name__ == "__main__":
    sys.exit(main())
