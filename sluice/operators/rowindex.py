"""Contiguous 0-based row index in file order, and load chunks made from it."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice import session
from sluice.functions.contract import Contract
from sluice.operators.ordering import kept, running_total
from sluice.sources.delimited import (
    LENGTH,
    ORIGIN,
    PATH,
    ROW,
    START,
    conform,
    numbered,
    read_parts,
    settled,
    union_by_name,
)

INDEX = "index"
CHUNK = "chunk_id"
ROWS, FIRST, LAST, BEFORE, KEY = "__rows", "__first", "__last", "__before", "__split"
ROWS_PER_TASK = 1 << 33  # monotonically_increasing_id counts each task from a multiple of this
SPLIT_BYTES = 128  # one row of the broadcast split table, with hash overhead
BROADCAST_LIMIT = 128 * 1024 * 1024
FEW_TASKS = 256  # a task reads some 30 files at most, so so many read less than 10 000 splits


def count_splits(raws: Sequence[DataFrame], scope: Mapping[str, Column]) -> DataFrame:
    """One row per file split: its number of rows, and its first and last row number.

    The counting pass needs no cell of the file.
    """
    session.pin_split_plan(raws[0].sparkSession)
    return (
        union_by_name([raw.select(*ORIGIN) for raw in raws])
        .groupBy(PATH, START, LENGTH)
        .agg(F.count(F.lit(1)).alias(ROWS), F.min(ROW).alias(FIRST), F.max(ROW).alias(LAST))
        .withColumns(dict(scope))
    )


def one_split(df: DataFrame) -> bool:
    """Whether a single task reads the whole source, as for one month in one gzip file."""
    return df.rdd.getNumPartitions() == 1 and len(df.inputFiles()) == 1


def few_offsets(splits: DataFrame, within: Sequence[str]) -> DataFrame:
    """The splits with the rows of all earlier splits of the same index, added up here: some thousand splits at most."""
    totals: dict[tuple, int] = defaultdict(int)
    rows = []
    for row in sorted(splits.collect(), key=lambda r: (r[PATH], r[START])):
        group = tuple(row[c] for c in within)
        rows.append((*row, totals[group]))
        totals[group] += row[ROWS]
    return splits.sparkSession.createDataFrame(rows, T.StructType([*splits.schema.fields, T.StructField(BEFORE, T.LongType())]))


def many_offsets(splits: DataFrame, within: Sequence[str]) -> DataFrame:
    """The same in Spark, on two levels; the counts are written to the shared folder first."""
    return running_total(kept(splits, "splits"), ROWS, [PATH, START], within, BEFORE)


def number_rows(
    raws: Sequence[DataFrame],
    scope: Mapping[str, Column] | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> list[DataFrame]:
    """Give frames of text cells an ``index`` column, and the columns of the scope.

    No row moves: split offsets are joined back by broadcast while they fit
    ``broadcast_limit`` bytes, by a shuffle join beyond that. A source that is
    split differently by the two passes fails instead of getting a wrong index.
    A source that is one file in one split is not counted first.
    """
    changed = F.raise_error(F.concat(F.lit("the file splits changed between two passes over "), F.col(PATH)))
    raws = [numbered(raw) for raw in raws]
    if not scope and len(raws) == 1 and one_split(raws[0]):  # the task's row numbers are the index
        index = F.when(F.col(ROW) < ROWS_PER_TASK, F.col(ROW)).otherwise(changed)
        return [raws[0].withColumn(INDEX, index)]

    added = {} if scope is None else dict(scope)
    within = {PATH: F.col(PATH)} if scope is None else added
    counted = count_splits(raws, within)
    few = sum(raw.rdd.getNumPartitions() for raw in raws) <= FEW_TASKS
    before = few_offsets(counted, list(within)) if few else many_offsets(counted, list(within))
    key = F.xxhash64(PATH, START, LENGTH)
    size = before.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(key).alias("hashes"),
        F.count_if(F.col(LAST) - F.col(FIRST) + 1 != F.col(ROWS)).alias("repeated"),
    ).first()
    if size.repeated:
        raise ValueError("a file is given more than once")
    # While no two splits share a hash, the hash alone is an exact key and keeps the table small.
    on = {KEY: key} if size.n == size.hashes else {f"{KEY}_{c}": F.col(c) for c in (PATH, START, LENGTH)}
    offsets = before.select(*[column.alias(name) for name, column in on.items()], *added, FIRST, LAST, BEFORE)
    fits = size.n * SPLIT_BYTES <= broadcast_limit
    match = reduce(lambda a, b: a & b, [column == F.col(name) for name, column in on.items()])
    index = F.when(F.col(ROW).between(F.col(FIRST), F.col(LAST)), F.col(BEFORE) + F.col(ROW) - F.col(FIRST))
    return [
        raw.join(F.broadcast(offsets) if fits else offsets.hint("merge"), match, "left")
        .withColumn(INDEX, F.coalesce(index, changed))
        for raw in raws
    ]


def read_indexed(
    spark: SparkSession,
    paths: str | Sequence[str],
    contract: Contract,
    scope: Mapping[str, Column] | None = None,
    *,
    headers: str = "each",
    multi_line: bool | None = None,
    bad_timestamp: str = "raise",
    with_path: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT,
    writers: int | None = None,
) -> DataFrame:
    """Typed rows of delimited files with ``index`` in front: 0..n-1 in file order.

    By default every file has its own index. ``scope`` names columns computed
    from the file path (``PATH``); files that agree on them share one index, in
    path order, and the columns are put in front as well. An empty scope
    numbers the whole source. ``writers`` spreads the rows over that many tasks,
    in ranges of the index, before their cells are typed: for sources that few
    tasks read. Other options are those of ``read_delimited``.
    """
    # Loads select all columns, so widths are checked there; the counting pass need not read any cell.
    parts = read_parts(spark, paths, contract, headers=headers, multi_line=multi_line, whole_records=False)
    contract, as_text = settled(parts, contract, bad_timestamp)
    front = [*(scope or {}), INDEX]
    for part in parts:
        taken = sorted(set(front) & set(part.header))
        if taken:
            raise ValueError(f"the file already has columns named {taken}")
    raws = number_rows([p.raw for p in parts], scope, broadcast_limit)
    if writers is not None:
        raws = [raw.repartitionByRange(writers, *(scope or {}), INDEX) for raw in raws]
    numbered_parts = zip(parts, raws)
    after = [PATH] if with_path else []
    return union_by_name([conform(replace(p, raw=raw), contract, as_text, front, after) for p, raw in numbered_parts])


def with_chunk_id(df: DataFrame, chunk_size: int) -> DataFrame:
    """The load chunk of each row: every chunk is full but the last of its index."""
    if chunk_size < 1:
        raise ValueError("chunk_size must be positive")
    return df.withColumn(CHUNK, F.expr(f"`{INDEX}` div {chunk_size}"))


def chunk_counts(df: DataFrame, chunk_size: int, by: Sequence[str] = ()) -> DataFrame:
    """Rows per chunk; ``by`` holds the columns one index runs within."""
    return with_chunk_id(df, chunk_size).groupBy(*by, CHUNK).agg(F.count(F.lit(1)).alias("inserted"))


def head(df: DataFrame, n: int = 5) -> DataFrame:
    """The first n rows of each index. On a stored table this is a pushed-down range filter."""
    return df.where(F.col(INDEX) < n)
