"""Column profiles and schema reports."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from decimal import ROUND_HALF_DOWN, ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.quantiles import PROBABILITIES, Summary, summarize

EPOCH = datetime(1970, 1, 1)

NUMERIC_PROFILE = "column_name string, n bigint, mean double, std double, min double, p25 double, p50 double, p75 double, max double"
TIMESTAMP_PROFILE = (
    "column_name string, n bigint, mean timestamp_ntz, min timestamp_ntz, p25 timestamp_ntz, "
    "p50 timestamp_ntz, p75 timestamp_ntz, max timestamp_ntz"
)


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone, whatever the session's zone."""
    days = F.unix_date(ts.cast("date")).cast("bigint")
    seconds = days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


def _from_micros(value: float | int | Decimal | None) -> datetime | None:
    """To the nearest microsecond; a tie goes up for a quantile (float) and down for a mean (Decimal)."""
    if value is None:
        return None
    ties = ROUND_HALF_DOWN if isinstance(value, Decimal) else ROUND_HALF_UP
    return EPOCH + timedelta(microseconds=int(Decimal(value).to_integral_value(ties)))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def timestamp_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]


@dataclass(frozen=True)
class Profile:
    """One row per column: of numbers, and of timestamps."""

    numbers: DataFrame
    timestamps: DataFrame


def describe(df: DataFrame, columns: Sequence[str] | None = None, *, approx: bool = False) -> Profile:
    """Count, mean, extremes and quartiles of all numeric and timestamp columns, in the scans that one column needs.

    Numbers also have the sample deviation. Nulls and NaN are left out.
    Quartiles interpolate linearly and are exact; ``approx=True`` settles for
    ``percentile_approx`` in a single pass.
    """
    wanted = [f.name for f in df.schema] if columns is None else list(columns)
    times = [n for n in timestamp_columns(df) if n in wanted]
    names = [n for n in (numeric_columns(df) if columns is None else wanted) if n not in times]
    values = {}
    for name in names:
        kind = df.schema[name].dataType
        if isinstance(kind, T.IntegralType):
            values[name] = _named(name).cast("bigint")
        else:
            number = _named(name).cast("double")
            values[name] = F.when(~F.isnan(number), number)
    found = summarize(df, values | {n: micros(_named(n)) for n in times}, PROBABILITIES, approx=approx, exact_mean=times)

    def number_row(name: str, s: Summary) -> tuple:
        return (name, s.n, s.mean, s.std, _float(s.min), *map(_float, s.quantiles), _float(s.max))

    def time_row(name: str, s: Summary) -> tuple:
        return (name, s.n, _from_micros(s.mean), *map(_from_micros, (s.min, *s.quantiles, s.max)))

    spark = df.sparkSession
    return Profile(
        spark.createDataFrame([number_row(n, found[n]) for n in names], NUMERIC_PROFILE),
        spark.createDataFrame([time_row(n, found[n]) for n in times], TIMESTAMP_PROFILE),
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, *, approx: bool = False) -> DataFrame:
    """The numeric part of `describe`, of these columns only."""
    return describe(df, numeric_columns(df) if columns is None else columns, approx=approx).numbers


def describe_timestamp(df: DataFrame, columns: Sequence[str] | None = None, *, approx: bool = False) -> DataFrame:
    """The timestamp part of `describe`, of these columns only."""
    return describe(df, timestamp_columns(df) if columns is None else columns, approx=approx).timestamps


def _float(value: float | int | None) -> float | None:
    return None if value is None else float(value)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def column_types(df: DataFrame) -> DataFrame:
    """One row per column: its name and Spark type."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "column_name string, column_type string")


# The database type each Spark type is declared as.
DATABASE_TYPES = {
    "tinyint": "SMALLINT",
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "REAL",
    "double": "FLOAT(53)",
    "string": "TEXT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP WITHOUT TIME ZONE",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}

# Reserved words of PostgreSQL, quoted when used as names.
RESERVED = frozenset(
    """
    all analyse analyze and any array as asc asymmetric authorization between binary both case
    cast check collate column constraint create cross current_catalog current_date current_role
    current_schema current_time current_timestamp current_user default deferrable desc distinct
    do else end except false fetch for foreign freeze from full grant group having ilike in
    initially inner intersect into is isnull join lateral leading left like limit localtime
    localtimestamp natural not notnull null offset on only or order outer overlaps placing
    primary references returning right select session_user similar some symmetric table then
    to trailing true union unique user using variadic verbose when where window with
    """.split()
)


def _identifier(name: str) -> str:
    if re.fullmatch(r"[a-z_][a-z0-9_$]*", name) and name not in RESERVED:
        return name
    return '"' + name.replace('"', '""') + '"'


def table_ddl(df: DataFrame, table: str) -> str:
    """``CREATE TABLE`` text for a frame in PostgreSQL types, one column per line."""
    unknown = [f.name for f in df.schema if f.dataType.simpleString() not in DATABASE_TYPES]
    if unknown:
        raise ValueError(f"no database type for columns {unknown}")
    columns = [f"{_identifier(f.name)} {DATABASE_TYPES[f.dataType.simpleString()]}" for f in df.schema]
    return f"\nCREATE TABLE {_identifier(table)} (\n\t" + ", \n\t".join(columns) + "\n)\n\n"
