"""Delimited files and folders written by Spark from tables: the inputs the readers are run on.

They go to the shared folder the session names, are written by parallel
tasks, and are kept for the rest of the application.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import session

TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ROWS_PER_FILE = 5_000_000  # bounds the work of the one task that reads a gzip file

_kept: dict[tuple[str, str, str], str] = {}


def kept(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """The folder of one extract, written on first use in this application."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _kept:
        folder = session.fresh_dir(spark, label)
        write(folder)
        _kept[key] = folder
    return _kept[key]


def write_csv(df: DataFrame, folder: str, *, gzip: bool = False, partition: str | None = None) -> None:
    writer = df.write.options(
        header=True,
        escape='"',
        timestampNTZFormat=TIMESTAMP,
        compression="gzip" if gzip else "none",
        maxRecordsPerFile=ROWS_PER_FILE,
    )
    (writer.partitionBy(partition) if partition else writer).csv(folder)


def write_sorted(df: DataFrame, folder: str, by: str, *, gzip: bool = False) -> None:
    """Part files in the order of a key: ranges of it, each range sorted."""
    write_csv(df.orderBy(by), folder, gzip=gzip)


def write_months(df: DataFrame, folder: str, date: str, by: str) -> None:
    """One folder ``ym=YYYY-MM`` of gzip parts per month, in the order of a key within the month.

    Rows are spread by month and key, so a month that holds most rows is
    still written by many tasks.
    """
    ym = F.date_format(date, "yyyy-MM")
    spread = df.withColumn("ym", ym).repartitionByRange("ym", by).sortWithinPartitions("ym", by)
    write_csv(spread, folder, gzip=True, partition="ym")


def write_lines(df: DataFrame, folder: str, columns: Sequence[str], line: str) -> None:
    """Ready-made lines (column ``line``) below a header, with no quoting of our own."""
    named = df.select(F.col(line).alias(",".join(columns)))
    named.write.options(header=True, quote="", sep="\x01", maxRecordsPerFile=ROWS_PER_FILE).csv(folder)


def write_named_files(df: DataFrame, folder: str, name: str, content: str) -> None:
    """One file per row. Tasks write side by side; writing a name again changes nothing."""

    def write(rows):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        for row in rows:
            with store.open_output_stream(f"{base}/{row[0]}") as out:
                out.write(row[1].encode("utf-8"))

    df.select(name, content).foreachPartition(write)
