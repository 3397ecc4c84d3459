"""Positions of rows in a sorted order, and running totals, without one task that sees all rows.

Both work on two levels: rows are dealt to ranges of the order, each range is
counted on its own, and what comes before a range is found from one small row
per range (and group). A key that holds most rows is spread over ranges as far as
the order tells its rows apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice import session

RANGE, ROW, FIRST, SIZE, BEFORE, GROUP = "__in_range", "__in_row", "__in_first", "__in_size", "__in_before", "__in_group"
ROWS_PER_TASK = 33  # bits below the number of the task in monotonically_increasing_id


def kept(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder: what a range holds must not change between two looks at it."""
    path = session.fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column(name: str | Column) -> Column:
    return F.col("`" + name.replace("`", "``") + "`") if isinstance(name, str) else name


def group_columns(within: Sequence[str]) -> dict[str, Column]:
    return {f"{GROUP}_{i}": column(c) for i, c in enumerate(within)}


def in_order(df: DataFrame, by: Sequence[str | Column], within: Sequence[str] = (), position: str = "position", total: str = "total") -> DataFrame:
    """`df` with the 0-based position of each row in the order `by`, and the number of rows.

    With `within`, positions and numbers are those within each group of equal
    values (null is one), and the rows are dealt by group first. Rows that `by`
    does not tell apart come in some order, the same for every later look.
    """
    groups = group_columns(within)
    order = [*groups.values(), *[column(c) for c in by]]
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = kept(dealt.withColumn(ROW, F.monotonically_increasing_id()), "ordered")
    sizes = (
        rows.groupBy(*[c.alias(name) for name, c in groups.items()], F.shiftright(ROW, ROWS_PER_TASK).alias(RANGE))
        .agg(F.count(F.lit(1)).alias(SIZE), F.min(ROW).alias(FIRST))
    )
    one = Window.partitionBy(*groups)
    earlier = one.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = kept(
        sizes.withColumn(BEFORE, F.coalesce(F.sum(SIZE).over(earlier), F.lit(0))).withColumn(total, F.sum(SIZE).over(one)), "offsets"
    ).drop(SIZE)
    same = [F.shiftright(ROW, ROWS_PER_TASK) == F.col(RANGE), *[c.eqNullSafe(F.col(name)) for name, c in groups.items()]]
    return (
        rows.join(offsets, reduce(lambda a, b: a & b, same))
        .withColumn(position, F.col(BEFORE) + F.col(ROW) - F.col(FIRST))
        .drop(ROW, RANGE, FIRST, BEFORE, *groups)
    )


def running_total(df: DataFrame, value: str, by: Sequence[str | Column], within: Sequence[str] = (), total: str = "before") -> DataFrame:
    """`df` with the sum of a column over all earlier rows in the order `by`, 0 for the first.

    With `within`, over the earlier rows of the same group. Rows are summed up
    range by range, then the sums of earlier ranges are added.
    """
    groups = group_columns(within)
    order = [*groups.values(), *[column(c) for c in by]]
    rows = kept(df.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id()), "ranges")
    names = [F.col(name) for name in groups]
    sizes = rows.groupBy(*[c.alias(name) for name, c in groups.items()], RANGE).agg(F.sum(value).alias(SIZE))
    earlier = Window.partitionBy(*names).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*names, F.col(RANGE).alias(ROW), F.coalesce(F.sum(SIZE).over(earlier), F.lit(0)).alias(BEFORE))
    inside = Window.partitionBy(RANGE, *groups.values()).orderBy(*[column(c) for c in by]).rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(RANGE) == F.col(ROW), *[c.eqNullSafe(F.col(name)) for name, c in groups.items()]]
    return (
        rows.withColumn(SIZE, F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(offsets, reduce(lambda a, b: a & b, same))
        .withColumn(total, F.col(BEFORE) + F.col(SIZE))
        .drop(RANGE, ROW, SIZE, BEFORE, *groups)
    )
