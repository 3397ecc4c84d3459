"""Frames from values in code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_frame(spark: SparkSession, columns: Mapping[str, Sequence[int]]) -> DataFrame:
    """Whole-number columns of equal length, as 64-bit integers."""
    schema = ", ".join(f"`{name}` bigint" for name in columns)
    return spark.createDataFrame(list(zip(*columns.values(), strict=True)), schema)


def with_constant(df: DataFrame, name: str, value: int) -> DataFrame:
    return df.withColumn(name, F.lit(value).cast("bigint"))
