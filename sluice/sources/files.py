"""A folder's entries as a frame of names and contents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sluice import session

ENTRY = "name string, is_file boolean, size bigint, content binary"
SLICES = 8


class Slice(InputPartition):
    """The entries whose names fall into one of some equal shares."""

    def __init__(self, number: int, of: int):
        super().__init__(number)
        self.number, self.of = number, of

    def holds(self, name: str) -> bool:
        return zlib.crc32(name.encode("utf-8", "surrogateescape")) % self.of == self.number


class EntryReader(DataSourceReader):
    def __init__(self, folder: str, slices: int, contents: bool):
        self.folder, self.slices, self.contents = folder, slices, contents

    def partitions(self) -> list[InputPartition]:
        return [Slice(i, self.slices) for i in range(self.slices)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from pyarrow import fs

        store, base = file_system(self.folder)
        if store.get_file_info(base).type != fs.FileType.Directory:
            raise FileNotFoundError(f"{self.folder} is not a folder")
        for entry in store.get_file_info(fs.FileSelector(base, recursive=False)):
            if partition.holds(entry.base_name):
                is_file = entry.type == fs.FileType.File
                content = None
                if is_file and self.contents:
                    with store.open_input_stream(entry.path, compression=None) as data:
                        content = data.read()
                yield entry.base_name, is_file, entry.size if is_file else None, content


class Entries(DataSource):
    """Spark source `folder_entries`: every entry of a folder, hidden ones and folders too.

    Options: `path`; `slices`, the tasks that share the names by their hash;
    `contents`, false to leave the bytes of files unread. Tasks list the folder
    themselves, nothing is listed by the driver.
    """

    @classmethod
    def name(cls) -> str:
        return "folder_entries"

    def schema(self) -> str:
        return ENTRY

    def reader(self, schema) -> DataSourceReader:
        contents = self.options.get("contents", "true").lower() == "true"
        return EntryReader(self.options["path"], int(self.options.get("slices", SLICES)), contents)


def file_system(folder: str):
    """The store of a folder and its place there. `s3a` is `s3` to it, and a place without a scheme is local."""
    import os

    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), os.path.abspath(folder)
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def file_inventory(spark: SparkSession, folder: str, exclude: str | None = None, *, contents: bool = True) -> DataFrame:
    """``name``, ``is_file``, ``size`` and UTF-8 ``content`` of what lies directly in a folder.

    ``exclude`` drops one name. Folders have neither size nor content, and
    ``contents=False`` leaves files unread: their content is null. Hidden
    names are listed, empty files have an empty content. Bytes that are not UTF-8
    fail where the content is selected.
    """
    session.ship(spark)
    spark.dataSource.register(Entries)
    found = spark.read.format(Entries.name()).option("contents", contents).load(folder)
    listed = found.select("name", "is_file", "size", F.decode("content", "UTF-8").alias("content"))
    return listed if exclude is None else listed.where(F.col("name") != exclude)
