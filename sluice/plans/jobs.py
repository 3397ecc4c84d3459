"""The two batch jobs: load months of delimited files, and stamp rows with a month."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from threading import Event, Thread

from pyspark.sql import DataFrame, SparkSession

from sluice.functions.contract import TRIPS, Contract
from sluice.operators import rowindex
from sluice.sinks import jdbc, parquet, tables
from sluice.sources import literals
from sluice.sources.months import TRIPS_FILE, Month, month_paths, read_months


@dataclass(frozen=True)
class IngestConfig:
    """One load: which months, into which table, audited in chunks of which size.

    ``source`` is a path template with ``{year}`` and ``{month:02d}``; a month
    may be a file or a folder of part files. With ``connection`` the target is
    a database table, otherwise a Spark table stored below ``target_dir``
    (default: the session's warehouse). ``writers`` spreads records over that many
    tasks before they are typed, for a month that is one large gzip file.
    """

    source: str = TRIPS_FILE
    year: int = 2021
    month: int = 1
    last: Month | None = None
    target_table: str = "yellow_taxi_data"  # fixed value: the table of the trips
    chunk_size: int = 100_000
    contract: Contract = TRIPS
    target_dir: str | None = None
    connection: jdbc.Connection | None = None
    headers: str = "each"
    multi_line: bool | None = None
    bad_timestamp: str = "raise"
    writers: int | None = None


@dataclass(frozen=True)
class IngestReport:
    rows: int
    table: DataFrame
    chunks: DataFrame


def read_source(spark: SparkSession, cfg: IngestConfig) -> DataFrame:
    """Typed rows with ``index`` in front; several months also carry ``year`` and ``month``."""
    first, options = (cfg.year, cfg.month), {
        "headers": cfg.headers,
        "multi_line": cfg.multi_line,
        "bad_timestamp": cfg.bad_timestamp,
        "writers": cfg.writers,
    }
    if cfg.last is not None:
        return read_months(spark, cfg.source, first, cfg.last, contract=cfg.contract, **options)
    return rowindex.read_indexed(spark, month_paths(cfg.source, first), cfg.contract, {}, **options)


@contextmanager
def watched(spark: SparkSession, tell: Callable[[int, int], None] | None, every: float = 1.0) -> Iterator[None]:
    """While the block runs, tell how many tasks of the running stages are done and how many there are."""
    if tell is None:
        yield
        return
    tracker, over = spark.sparkContext.statusTracker(), Event()

    def look() -> None:
        while not over.wait(every):
            stages = [s for s in map(tracker.getStageInfo, tracker.getActiveStageIds()) if s is not None]
            if stages:
                tell(sum(s.numCompletedTasks for s in stages), sum(s.numTasks for s in stages))

    watcher = Thread(target=look, daemon=True)
    watcher.start()
    try:
        yield
    finally:
        over.set()
        watcher.join()


def ingest(spark: SparkSession, cfg: IngestConfig, tell: Callable[[int, int], None] | None = None, every: float = 1.0) -> IngestReport:
    """Replace the target with the rows of the asked months and count them per chunk.

    The counts come from the loaded table, not from what was sent. ``tell`` is
    called ``every`` so many seconds of the load with the tasks done and their number.
    """
    with watched(spark, tell, every):
        return load_and_count(spark, cfg)


def load_and_count(spark: SparkSession, cfg: IngestConfig) -> IngestReport:
    df = read_source(spark, cfg)
    if cfg.connection is not None:
        rows = jdbc.write_jdbc(df, cfg.connection, cfg.target_table, replace=True)
        table = jdbc.read_jdbc(spark, cfg.connection, cfg.target_table, rowindex.INDEX, rows)
        jdbc.check_loaded(0, rows, table.count())
    else:
        folder = cfg.target_dir or spark.conf.get("spark.sql.warehouse.dir")
        rows = tables.replace_table(df, cfg.target_table, folder).rows
        table = spark.table(cfg.target_table)
    by = ["year", "month"] if cfg.last is not None else []
    return IngestReport(rows, table, rowindex.chunk_counts(table, cfg.chunk_size, by))


def month_job(spark: SparkSession, month: str, folder: str, frame: DataFrame | None = None) -> str:
    """Stamp rows with a month number and write them to a Parquet path named by it.

    The column holds the number, the path the text as given: ``01`` writes
    ``month=1`` into ``output_month_01.parquet``.
    """
    if frame is None:
        # The two rows that are stamped by default.
        frame = literals.literal_frame(spark, {"day": [1, 2], "num_passengers": [3, 4]})
    return parquet.write_month_parquet(literals.with_constant(frame, "month", int(month)), folder, month)


def show_progress(report: IngestReport) -> None:
    """Print the rows of each chunk, in chunk order, a bounded batch at a time."""
    # The words that are printed.
    print("Table created")
    for row in report.chunks.orderBy(*report.chunks.columns[:-1]).toLocalIterator():
        print("Inserted:", row.inserted)
