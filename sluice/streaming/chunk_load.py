"""The chunked load fed by files as they arrive, restartable without loss or repeats."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice import session
from sluice.functions.contract import Contract
from sluice.operators import rowindex
from sluice.sinks.folders import replace_folder
from sluice.sources import delimited
from sluice.sources.delimited import PATH

BATCH = "batch_id"
SOURCE = "source_file"
MILLISECONDS = "milliseconds"


@dataclass(frozen=True)
class StreamLoad:
    """A load from ``source`` (searched with its subfolders) into a Parquet folder.

    ``target`` gets the rows with ``index`` within their file, ``audit`` the
    rows inserted per file and chunk, and how long the batch took to load. Both
    are partitioned by ``batch_id``.
    All files must have the header of the first one; a task that meets another
    header fails.
    """

    source: str
    contract: Contract
    target: str
    audit: str
    checkpoint: str
    chunk_size: int = 100_000
    max_files: int = 1
    multi_line: bool = True


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch so that repeating it changes nothing.

    Batch 0 belongs to a fresh checkpoint and replaces whatever the folder held,
    once its rows are complete beside it: a bad cell or a lost driver leaves the
    old rows or the new ones. A later batch replaces only its own partition.
    """
    rows = df.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
    if batch_id == 0:
        replace_folder(rows, path, BATCH)
    else:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)


def read_batch(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """The rows one batch wrote, listing that batch's folder only; None if it wrote none."""
    try:
        return spark.read.option("basePath", path).parquet(f"{path}/{BATCH}={batch_id}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def first_file(spark: SparkSession, source: str) -> str:
    """The first file of a source by name, found by tasks; no file is opened and no list comes back."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    name = files.agg(F.min("path")).first()[0]
    if name is None:
        raise ValueError(f"no files below {source}")
    return delimited.decoded(name)


def start(spark: SparkSession, load: StreamLoad) -> StreamingQuery:
    """Load all files present and not yet loaded under this checkpoint, then stop."""
    session.ship(spark)
    header = tuple(delimited.read_header(spark, first_file(spark, load.source)))
    load.contract.require(header)
    session.prefer_compiled_methods(spark)
    raw = (
        spark.readStream.schema(delimited.raw_schema(header))
        .options(**delimited.csv_options(load.multi_line, verify_header=True))
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", load.max_files)
        .csv(load.source)
    )
    located = delimited.with_origin(raw, load.multi_line)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        begun = time.monotonic()
        raw = rowindex.number_rows([batch])[0]
        rows = delimited.conform(delimited.Part(raw, header, header), load.contract, (), [rowindex.INDEX], [PATH])
        rows = rows.withColumnRenamed(PATH, SOURCE)
        write_batch(rows, load.target, batch_id)
        written = read_batch(batch.sparkSession, load.target, batch_id)
        counts = rowindex.chunk_counts(rows.limit(0) if written is None else written, load.chunk_size, [SOURCE])
        took = F.lit(round((time.monotonic() - begun) * 1000)).cast("bigint")
        write_batch(counts.withColumn(MILLISECONDS, took), load.audit, batch_id)

    return (
        located.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", load.checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def progress(spark: SparkSession, load: StreamLoad) -> DataFrame:
    """Rows loaded per batch and the time that took, of all batches: from the audit, so also after the query has ended."""
    audit = spark.read.parquet(load.audit).groupBy(F.col(BATCH).cast("bigint").alias(BATCH))
    return audit.agg(F.sum("inserted").alias("inserted"), F.max(MILLISECONDS).alias(MILLISECONDS))
