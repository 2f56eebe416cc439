"""Arguments the mains share."""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from tidemark.schemas import BRONZE, TableSpec
from tidemark.tables import MergeTable, ParquetTable, open_table, paths
from tidemark.tables.bootstrap import location, sync_partitions
from tidemark.tables.notes import DayNotes


def parser(description: str | None) -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=description)
    p.add_argument("--root", default="", help="directory of the tables (parquet form)")
    p.add_argument("--catalog", default="", help="catalog of the tables")
    p.add_argument("--format", default="parquet", help="parquet, or a format with MERGE")
    return p


def table(spark: SparkSession, args: argparse.Namespace, spec: TableSpec) -> ParquetTable | MergeTable:
    if args.format == "parquet":
        if not args.root:
            raise SystemExit("--root is required for parquet tables")
        return open_table(spark, location(spec, args.root), spec)
    prefix = f"{args.catalog}." if args.catalog else ""
    return open_table(spark, prefix + spec.full_name, spec, args.format)


def show(spark: SparkSession, args: argparse.Namespace, *specs: TableSpec) -> None:
    """Let readers by name see what was written by path, where the table was bootstrapped."""
    if args.format != "parquet":
        return
    for spec in specs:
        name = f"{args.catalog}.{spec.full_name}" if args.catalog else spec.full_name
        if paths.exists(spark, location(spec, args.root)) and spark.catalog.tableExists(name):
            sync_partitions(spark, spec, args.catalog)


def bronze_table(args: argparse.Namespace) -> str:
    """Directory of bronze under ``--root``, else its catalog name."""
    if args.root:
        return location(BRONZE, args.root)
    if not args.catalog:
        raise SystemExit("--root or --catalog is required")
    return f"{args.catalog}.{BRONZE.full_name}"


def day_notes(spark: SparkSession, args: argparse.Namespace) -> DayNotes | None:
    """The days that silver changed and gold has not seen, where tables lie under ``--root``."""
    return DayNotes(spark, f"{args.root.rstrip('/')}/gold/_late_days") if args.root else None


def today_utc() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date()


def report(job: str, **fields: object) -> None:
    """One JSON line on standard output."""
    print(json.dumps({"job": job, **fields}, default=str), flush=True)
