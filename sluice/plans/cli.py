"""Command line: ``spark-submit cli.py ingest …`` and ``spark-submit cli.py month 01``."""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession

if __name__ == "__main__":  # started as a file: the package is two folders up
    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from sluice.plans.jobs import IngestConfig, ingest, month_job, show_progress
from sluice.sinks.jdbc import Connection


def month_of(text: str) -> tuple[int, int]:
    year, month = text.split("-")
    return int(year), int(month)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sluice")
    jobs = top.add_subparsers(dest="job", required=True)
    defaults = IngestConfig()

    load = jobs.add_parser("ingest", help="load a month of trips into a table")
    load.add_argument("--source", default=defaults.source, help="path with {year} and {month:02d}")
    load.add_argument("--year", type=int, default=defaults.year)
    load.add_argument("--month", type=int, default=defaults.month)
    load.add_argument("--target-table", default=defaults.target_table)
    load.add_argument("--target-dir", help="folder for the files of a Spark table")
    load.add_argument("--chunk-size", type=int, default=defaults.chunk_size)
    load.add_argument("--last", type=month_of, help="last month of a range, as YYYY-MM")
    load.add_argument("--headers", choices=["each", "first"], default=defaults.headers)
    load.add_argument("--multi-line", choices=["yes", "no"], default="yes", help="no: quoted cells hold no newline")
    load.add_argument("--bad-timestamp", choices=["raise", "text"], default=defaults.bad_timestamp)
    load.add_argument("--writers", type=int, help="tasks that write the rows")
    load.add_argument("--pg-user", help="load into PostgreSQL as this user")
    load.add_argument("--pg-password", help="default: the variable PGPASSWORD")
    load.add_argument("--pg-host", default=Connection.host)
    load.add_argument("--pg-port", type=int, default=Connection.port)
    load.add_argument("--pg-db", default=Connection.database)

    month = jobs.add_parser("month", help="write the month frame as Parquet")
    month.add_argument("month")
    month.add_argument("--folder", default=".")
    return top


def config(args: argparse.Namespace) -> IngestConfig:
    connection = None
    if args.pg_user is not None:
        password = args.pg_password or os.environ.get("PGPASSWORD")
        if password is None:
            raise SystemExit("give --pg-password or set PGPASSWORD")
        connection = Connection(args.pg_user, password, args.pg_host, args.pg_port, args.pg_db)
    return IngestConfig(
        source=args.source,
        year=args.year,
        month=args.month,
        target_table=args.target_table,
        target_dir=args.target_dir,
        chunk_size=args.chunk_size,
        connection=connection,
        last=args.last,
        headers=args.headers,
        multi_line=args.multi_line == "yes",
        bad_timestamp=args.bad_timestamp,
        writers=args.writers,
    )


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"sluice-{args.job}").getOrCreate()
    if args.job == "ingest":
        show_progress(ingest(spark, config(args), tell=lambda done, of: print(f"{done} of {of} tasks", file=sys.stderr)))
    else:
        print(month_job(spark, args.month, args.folder))


if __name__ == "__main__":
    main()
