"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import session
from sluice.session import ship as ship  # for the operators


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared folder and read it back: lineage ends here, lost executors cost nothing."""
    spark = df.sparkSession
    path = session.fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


HOT = 1024  # keys that hold this part of all rows are broadcast: there are no more than this many


def joined_back(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """`rows` with the columns of the group that each belongs to; `size` is a column of rows a group, `total` all rows.

    Groups with 1/1024 of all rows or more, at most 1024 of them, are broadcast,
    so the rows of a hot group stay where they are; the others are joined by shuffle.
    """
    is_hot = F.col(size) * HOT >= total
    hot, cold = groups.where(is_hot).drop(size), groups.where(~is_hot).drop(size)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(rest.join(cold, key))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of `df` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def making_room(df: DataFrame, *names: str) -> DataFrame:
    """`df` with `_` behind the names of its own columns that clash, in whatever case, with columns to be added."""
    wanted = {n.lower() for n in names}
    taken, renamed = {c.lower() for c in df.columns} | wanted, {}
    for column in df.columns:
        if column.lower() in wanted:
            name = column + "_"
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
            renamed[column] = name
    return df.withColumnsRenamed(renamed) if renamed else df


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """The rows for which a condition on computed columns holds.

    A plain filter is moved below the projections that compute those columns,
    with their expressions put in for each mention: long ones are then worked
    out many times over. The row number here is not deterministic, so the filter
    stays above it.
    """
    (row,) = unused(df, "row")
    return df.withColumn(row, F.monotonically_increasing_id()).where(condition & (F.col(row) >= 0)).drop(row)
