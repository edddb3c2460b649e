"""The batch jobs for spark-submit: ``python -m probity.jobs run|check|report ...``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from probity.model import AUDIT_SCHEMA, REGISTER_SCHEMA, RETURNS_SCHEMA
from probity.plans.filings import REGISTER, RETURNS, run_all_checks
from probity.plans.pipeline import AUDIT_LOG, run_pipeline
from probity.plans.report import report_tables
from probity.session import builder, remove_folder
from probity.sources import (
    INPUT_POSITION,
    Catalogue,
    read_csv,
    read_parquet,
    read_summary,
    write_document,
    write_table,
)


def _returns(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.format == "csv":
        return read_csv(spark, args.returns, RETURNS_SCHEMA, position=True)
    return read_parquet(spark, args.returns, RETURNS_SCHEMA)


def _other(
    spark: SparkSession, args: argparse.Namespace, path: str, schema: T.StructType
) -> DataFrame:
    return (read_csv if args.format == "csv" else read_parquet)(spark, path, schema)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    """Check, clean, record lineage and save the summary.

    Parquet input is used where it is. CSV input is parsed once and saved as
    parquet below the output folder, each row with its position in the files.
    Steps are stored in the catalogue's folder ``steps``; a run that was broken off
    goes on if it is started with its run id and run time again.
    """
    paths = {REGISTER: args.register, RETURNS: args.returns}
    audit_log = None
    if args.audit_log:
        paths[AUDIT_LOG] = args.audit_log
        audit_log = _other(spark, args, args.audit_log, AUDIT_SCHEMA)
    run_pipeline(
        spark,
        _returns(spark, args),
        _other(spark, args, args.register, REGISTER_SCHEMA),
        args.out,
        Catalogue(spark, args.catalogue or f"{args.out}/catalogue"),
        args.as_of,
        audit_log,
        run_ts=args.run_ts or datetime.now(),
        run_id=args.run_id,
        raw_paths=paths if args.format == "parquet" else None,
        clean_fmt=args.format,
    )


def check(spark: SparkSession, args: argparse.Namespace) -> None:
    """Save the result document of the checks alone.

    CSV input is parsed once, into a folder beside the output that goes at the end.
    """
    tables = {
        "returns": _returns(spark, args).drop(INPUT_POSITION),
        "register": _other(spark, args, args.register, REGISTER_SCHEMA),
    }
    if args.format == "csv":
        staged = f"{args.out}_staged"
        for name, df in tables.items():
            write_table(df, f"{staged}/{name}")
            tables[name] = spark.read.schema(df.schema).parquet(f"{staged}/{name}")
    result = run_all_checks(tables["returns"], tables["register"], args.as_of)
    write_document(result, args.out)
    if args.format == "csv":
        remove_folder(spark, staged)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    """Save the report tables of a saved run summary, one folder each."""
    for name, df in report_tables(read_summary(spark, args.summary), args.as_of).items():
        write_table(df.coalesce(1), f"{args.out}/{name}", args.format)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="probity.jobs")
    jobs = top.add_subparsers(required=True)
    for job in (run, check, report):
        sub = jobs.add_parser(job.__name__, help=job.__doc__)
        sub.set_defaults(job=job)
        sub.add_argument("--out", required=True)
        sub.add_argument("--format", choices=["csv", "parquet"], default="parquet")
        sub.add_argument("--as-of", type=date.fromisoformat, default=date.today())
        if job is report:
            sub.add_argument("--summary", required=True)
            continue
        sub.add_argument("--returns", required=True)
        sub.add_argument("--register", required=True)
        if job is run:
            sub.add_argument("--audit-log")
            sub.add_argument("--catalogue")
            sub.add_argument("--run-id")
            sub.add_argument("--run-ts", type=datetime.fromisoformat)
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.job(spark or builder("probity").getOrCreate(), args)


if __name__ == "__main__":
    main()
