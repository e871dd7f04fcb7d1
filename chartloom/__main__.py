"""The jobs from the command line: ``python -m chartloom JOB …`` or with ``spark-submit``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from chartloom.plans import inspection, reports
from chartloom.plans.constraints import violations
from chartloom.plans.fetched import land_chain
from chartloom.plans.load import load_tables
from chartloom.plans.staging import stage_bundles, stage_governed
from chartloom.schemas import TABLES
from chartloom.session import build_session, input_bytes, sized, work_area
from chartloom.sinks.files import log_rejects
from chartloom.sinks.tables import Tables
from chartloom.sources.bundles import read_bundles, read_landed, read_pages
from chartloom.sources.staging_csv import read_staging


def inspect(spark: SparkSession, args: argparse.Namespace) -> None:
    found = read_bundles(spark, args.raw, names=args.names, multi_line=not args.lines)
    inspection.inspect_patients(found).show(args.rows, truncate=False)
    inspection.inspect_observations(found).show(args.rows, truncate=False)


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    pages = read_pages(spark, args.raw, names=args.names)
    land_chain(pages, args.out, args.total, args.types).show(args.rows, truncate=False)


def stage(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.landed:
        staged = stage_bundles(read_landed(spark, args.raw))
    else:
        staged = stage_governed(spark, args.raw, names=args.names, multi_line=not args.lines)
    places = [f"{args.out}/{name}" for name in ("patients", "observations", "rejects")]
    if not staged.export(*places, in_order=True):
        print("no input found, nothing written:", args.raw)
        return
    print("valid patients:", staged.patients.count())
    print("valid observations:", staged.observations.count())
    print("rejects:", staged.rejects.count())


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = Tables(spark, args.tables)
    people = read_staging(spark, f"{args.staged}/patients")
    readings = read_staging(spark, f"{args.staged}/observations")
    result = load_tables(
        tables, people, readings, on_no_match=args.on_no_match, null_code=args.null_code
    )
    for name in TABLES:
        print(f"{name}:", tables.read(name).count())
    log_rejects(result.orphans, f"{args.tables}/rejects")
    print("orphans:", result.orphans.count(), "reassigned:", result.reassigned)


def _give(args: argparse.Namespace, name: str, df: DataFrame) -> None:
    """Show the first rows, and write all of them if there is a folder for that."""
    print(name)
    if args.out:
        path = f"{args.out}/{name}"
        df.write.mode("overwrite").parquet(path)
        df = df.sparkSession.read.schema(df.schema).parquet(path)
    df.show(args.rows, truncate=False)
    if not args.out and (total := df.count()) > args.rows:
        print(f"shown {args.rows} of {total} rows; --out FOLDER writes all")


def check(spark: SparkSession, args: argparse.Namespace) -> None:
    _give(args, "violations", violations(Tables(spark, args.tables)))


def _parts(spark: SparkSession, root: str) -> list:
    tables = Tables(spark, root)
    return [tables.read(n) for n in ("fhir_patients", "fhir_observations", "terminology_lookup")]


def audit(spark: SparkSession, args: argparse.Namespace) -> None:
    for name, df in reports.audit(*_parts(spark, args.tables)).items():
        _give(args, name, df)


def dashboard(spark: SparkSession, args: argparse.Namespace) -> None:
    for name, df in reports.dashboard(*_parts(spark, args.tables)).items():
        _give(args, name, df)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="chartloom", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(run, *places: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(run.__name__)
        for place in places:
            sub.add_argument(place)
        sub.add_argument("--rows", type=int, default=20, help="rows to show")
        sub.set_defaults(run=run)
        return sub

    for run, places in ((inspect, ["raw"]), (land, ["raw", "out"]), (stage, ["raw", "out"])):
        sub = job(run, *places)
        sub.add_argument("--names", help="pattern for file names in the folder")
        sub.add_argument("--lines", action="store_true", help="every line is a bundle")
        if run is land:
            sub.add_argument("--total", type=int, help="records per type; all by default")
            sub.add_argument("--types", nargs="+", help="resource types; all by default")
        if run is stage:
            sub.add_argument("--landed", action="store_true", help="raw is a landed table")
    loading = job(load, "staged", "tables")
    loading.add_argument("--on-no-match", choices=["drop", "reassign"], default="drop")
    loading.add_argument("--null-code", help="text for missing codes")
    for run in (check, audit, dashboard):
        job(run, "tables").add_argument("--out", help="folder that gets all rows")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"chartloom-{args.job}")
    places = [getattr(args, place, None) for place in ("raw", "staged", "tables")]
    for key, value in sized(input_bytes(spark, *filter(None, places))).items():
        spark.conf.set(key, value)
    with work_area(spark):
        args.run(spark, args)


if __name__ == "__main__":
    main()
