"""Replace and append for Spark tables stored as Parquet."""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.sinks.folders import Folders

VERSION, ASIDE = "v-", "_aside_"


@dataclass(frozen=True)
class Loaded:
    """What a write did: rows written, where they are, where the replaced rows were."""

    rows: int
    location: str
    replaced: str | None = None


def table_location(spark: SparkSession, table: str) -> str:
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return detail.data_type


def _column_list(df: DataFrame) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)


def _write_counted(df: DataFrame, path: str) -> int:
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return counted.get["rows"]


def replace_table(df: DataFrame, table: str, folder: str) -> Loaded:
    """Make ``table`` hold exactly the rows of ``df``.

    Rows go to a new folder below ``folder`` first and the table is pointed at
    it after the write succeeded, so a failed load leaves the old table as it
    was. A table of another layout (columns, format, partitions) is set aside
    until the new one is there, and dropped then; if a driver was lost in between, the next replace (or `recover_table`)
    brings it back first. The old files stay where they were, for readers still on them; their
    place is reported, and `remove_old_versions` deletes them. Writing ``df.limit(0)`` leaves an empty table.
    """
    spark = df.sparkSession
    recover_table(spark, table)
    location = f"{folder.rstrip('/')}/{table.replace('`', '')}/{VERSION}{uuid.uuid4().hex}"
    rows = _write_counted(df, location)
    place = location.replace("'", "\\'")
    create = f"CREATE TABLE {table} ({_column_list(df)}) USING parquet LOCATION '{place}'"
    if not spark.catalog.tableExists(table):
        spark.sql(create)
        return Loaded(rows, location)
    old = table_location(spark, table)
    if _plain(spark, table) and _columns(spark.table(table)) == _columns(df):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
        spark.catalog.refreshTable(table)
        return Loaded(rows, location, old)
    aside = f"{table.rstrip('`')}{ASIDE}{uuid.uuid4().hex}" + ("`" if table.endswith("`") else "")
    spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
    try:
        spark.sql(create)
    except Exception:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE {aside}")
    return Loaded(rows, location, old)


def recover_table(spark: SparkSession, table: str) -> None:
    """Undo or end a replacement whose driver was lost while the old table was set aside."""
    database, _, name = table.replace("`", "").rpartition(".")
    inside = f"{database}." if database else ""
    pattern = re.compile(re.escape(name.lower() + ASIDE) + "[0-9a-f]{32}")
    for found in spark.catalog.listTables(database or None):
        if not found.isTemporary and pattern.fullmatch(found.name.lower()):
            if spark.catalog.tableExists(table):
                spark.sql(f"DROP TABLE {inside}`{found.name}`")
            else:
                spark.sql(f"ALTER TABLE {inside}`{found.name}` RENAME TO {table}")


def remove_old_versions(spark: SparkSession, table: str, folder: str, older_than: float = 0) -> list[str]:
    """Delete the files of replaced versions that were written at least so many seconds ago; gives their names.

    The version that the table points at stays. Run it when no reader is on an old one.
    """
    place = f"{folder.rstrip('/')}/{table.replace('`', '')}"
    folders, until = Folders(spark, place), time.time() - older_than
    now = table_location(spark, table).rstrip("/").rpartition("/")[2] if spark.catalog.tableExists(table) else None
    gone = [name for name, changed in folders.children(place) if name.startswith(VERSION) and name != now and changed <= until]
    for name in gone:
        folders.delete(f"{place}/{name}")
    return sorted(gone)


def _columns(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


def _plain(spark: SparkSession, table: str) -> bool:
    """Whether a table is a Parquet table without partitions or buckets, so that a new place is all it needs."""
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    told = {r.col_name: r.data_type for r in detail}
    return told.get("Provider", "").lower() == "parquet" and not {"# Partition Information", "Num Buckets"} & set(told)


def append_table(df: DataFrame, table: str) -> Loaded:
    """Add the rows of ``df``, matched by column name; no look for duplicates. Types must be the table's."""
    spark = df.sparkSession
    names = spark.table(table).columns
    have, given = (sorted(_columns(x)) for x in (spark.table(table), df))
    if have != given:
        raise ValueError(f"{table} has columns {have}, the rows have {given}")
    counted = Observation()
    rows = df.select(*[F.col("`" + n.replace("`", "``") + "`") for n in names])
    rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.insertInto(table)
    return Loaded(counted.get["rows"], table_location(spark, table))
