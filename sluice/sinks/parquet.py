"""Parquet output named by month."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sluice.sinks.folders import replace_folder


def write_month_parquet(df: DataFrame, folder: str, month: str) -> str:
    """Write ``output_month_{month}.parquet``, with the month exactly as given.

    A job that fails leaves an earlier month's file as it was, and so does a
    driver that is lost, see ``sinks/folders.py``.
    """
    path = f"{folder.rstrip('/')}/output_month_{month}.parquet"
    replace_folder(df, path)
    return path
