"""Parquet folders that are replaced as a whole, so that a driver lost at any step leaves the old rows or the new.

The new rows are written beside the folder first. The old folder is then renamed
out of the way, the new one renamed into its place, and the old one deleted. The
two siblings carry one identity in their names, which tells after a crash how
far the replacement was: `recover` undoes or ends it, and every read and replace
through this module recovers first. One writer at a time is assumed, as by
Spark's own writers, and a file system that renames folders in one step; on
stores without that, load tables (`sinks/tables.py`), whose pointer is the catalog's.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from sluice import session

NEW, OLD, DONE = "new", "old", "_SUCCESS"


class Folders:
    """The few calls to Spark's file system that are needed here."""

    def __init__(self, spark: SparkSession, path: str):
        self.place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.system = self.place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.system.exists(self.place(path))

    def rename(self, path: str, to: str) -> None:
        if not self.system.rename(self.place(path), self.place(to)):
            raise OSError(f"could not rename {path} to {to}")

    def delete(self, path: str) -> None:
        self.system.delete(self.place(path), True)

    def children(self, path: str) -> list[tuple[str, float]]:
        """Name and time of change (seconds) of what a folder holds."""
        if not self.exists(path):
            return []
        return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in self.system.listStatus(self.place(path))]


def parent_and_name(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent or ("/" if path.startswith("/") else "."), name


def siblings(folders: Folders, path: str) -> dict[str, dict[str, str]]:
    """What replacements have left beside a folder: by identity, the new and the old folder."""
    parent, name = parent_and_name(path)
    found: dict[str, dict[str, str]] = {}
    for child, _ in folders.children(parent):
        for kind in (NEW, OLD):
            if child.startswith(f".{name}.{kind}-"):
                found.setdefault(child.rpartition("-")[2], {})[kind] = f"{parent}/{child}"
    return found


def recover(spark: SparkSession, path: str) -> None:
    """End or undo a replacement that was cut off; without one, nothing happens.

    While the folder is there the old rows (or already the new ones) are in
    place, and what lies beside it goes. If it is missing, the crash was between
    the two renames, or before the first folder was in place: complete new rows
    move in, and old ones move back where the new ones are not complete.
    """
    folders = Folders(spark, path)
    for found in siblings(folders, path).values():
        if not folders.exists(path):
            if NEW in found and folders.exists(f"{found[NEW]}/{DONE}"):
                folders.rename(found.pop(NEW), path)
            elif OLD in found:
                folders.rename(found.pop(OLD), path)
        for left in found.values():
            folders.delete(left)


def replace_folder(df: DataFrame, path: str, *partitions: str) -> None:
    """Replace a Parquet folder by rows that are complete before the old ones go; they are written once."""
    spark = df.sparkSession
    recover(spark, path)
    folders, (parent, name), this = Folders(spark, path), parent_and_name(path), uuid.uuid4().hex
    new, old = (f"{parent}/.{name}.{kind}-{this}" for kind in (NEW, OLD))
    df.write.partitionBy(*partitions).parquet(new)
    if not folders.exists(f"{new}/{DONE}"):
        raise OSError(f"{new} has no {DONE}: without it a complete write cannot be told after a crash")
    if folders.exists(path):
        folders.rename(path, old)
    folders.rename(new, path)
    folders.delete(old)


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a replaceable folder, whatever a lost driver has left of a replacement."""
    recover(spark, path)
    return spark.read.parquet(path)


def remove_working_files(spark: SparkSession, older_than: float) -> list[str]:
    """Delete what jobs have left in the shared folder and nobody has changed for so many seconds; gives the names."""
    shared = session.shared_dir(spark).rstrip("/")
    folders, until = Folders(spark, shared), time.time() - older_than
    gone = [name for name, changed in folders.children(shared) if changed < until]
    for name in gone:
        folders.delete(f"{shared}/{name}")
    return sorted(gone)
