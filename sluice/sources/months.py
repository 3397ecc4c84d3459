"""Monthly files addressed by a path template such as ``trips_{year}-{month:02d}.csv.gz``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.contract import Contract
from sluice.operators import rowindex
from sluice.sources.delimited import PATH

Month = tuple[int, int]

# Fixed value: file name of one month of trips.
TRIPS_FILE = "yellow_tripdata_{year}-{month:02d}.csv.gz"


def months_between(first: Month, last: Month) -> list[Month]:
    start, stop = (year * 12 + month - 1 for year, month in (first, last))
    return [(m // 12, m % 12 + 1) for m in range(start, stop + 1)]


def month_paths(template: str, first: Month, last: Month | None = None) -> list[str]:
    """One path per month; each may be a file or a folder of part files."""
    return [template.format(year=y, month=m) for y, m in months_between(first, last or first)]


def month_of_path(template: str, path: Column) -> dict[str, Column]:
    """``year`` and ``month`` as written in a path (a file URI) made from the template.

    The whole template must match, from a folder's beginning to the path's end
    or to the folder that holds the parts of a month. A repeated field must
    repeat its value; a path that does not match fails.
    """
    path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    place = re.sub(r"\A(?:[A-Za-z][A-Za-z0-9+.-]*:)?/*", "", template).removeprefix("./")
    fields = {"{year}": r"\d{4}", "{month:02d}": r"\d{2}"}
    groups: dict[str, int] = {}
    pattern = ""
    for part in re.split(r"(\{year\}|\{month:02d\})", place):
        if part not in fields:
            pattern += re.escape(part)
        elif part in groups:
            pattern += rf"\{groups[part]}"
        else:
            groups[part] = len(groups) + 1
            pattern += f"({fields[part]})"
    if set(groups) != set(fields):
        raise ValueError("the template must name {year} and {month:02d}")
    pattern = rf"(?:\A|/){pattern}(?=/|\z)"
    missing = F.raise_error(F.concat(path, F.lit(f" is not of the form {template}"))).cast("string")
    found = {f: F.when(path.rlike(pattern), F.regexp_extract(path, pattern, g)).otherwise(missing) for f, g in groups.items()}
    return {"year": found["{year}"].cast("bigint"), "month": found["{month:02d}"].cast("bigint")}


def read_months(
    spark: SparkSession,
    template: str,
    first: Month,
    last: Month | None = None,
    *,
    contract: Contract,
    headers: str = "each",
    multi_line: bool | None = None,
    bad_timestamp: str = "raise",
    writers: int | None = None,
) -> DataFrame:
    """Typed rows of a range of months, each with ``year``, ``month`` and its index in the month.

    Only the paths of the asked months are listed and read.
    """
    return rowindex.read_indexed(
        spark,
        month_paths(template, first, last),
        contract,
        month_of_path(template, F.col(PATH)),
        headers=headers,
        multi_line=multi_line,
        bad_timestamp=bad_timestamp,
        writers=writers,
    )
