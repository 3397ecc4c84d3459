"""Load into, and read from, a PostgreSQL table over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Connection:
    """Where the database is. There is no default user or password, and neither is printed."""

    user: str = field(repr=False)
    password: str = field(repr=False)
    host: str = "localhost"
    port: int = 5432
    database: str = "ny_taxi"  # fixed value: the database that loads go to by default

    @property
    def url(self) -> str:
        return f"jdbc:postgresql://{self.host}:{self.port}/{self.database}"

    def properties(self) -> dict[str, str]:
        return {"user": self.user, "password": self.password, "driver": "org.postgresql.Driver"}


def write_jdbc(
    df: DataFrame,
    connection: Connection,
    table: str,
    *,
    replace: bool,
    writers: int = 8,
    batch_size: int = 10_000,
) -> int:
    """Replace or append to a database table with up to ``writers`` parallel connections; gives the rows sent.

    Every partition is one transaction. Replace drops and recreates the table
    first and is not atomic. A task that is lost after its commit and before it
    reports runs again and repeats its rows, so check the row count afterwards
    (``check_loaded``).
    """
    options = connection.properties() | {"batchsize": str(batch_size), "numPartitions": str(writers)}
    counted = Observation()
    sent = df.observe(counted, F.count(F.lit(1)).alias("rows"))  # counted as they are sent: the source is read once
    sent.write.jdbc(connection.url, table, mode="overwrite" if replace else "append", properties=options)
    return counted.get["rows"]


def read_jdbc(spark: SparkSession, connection: Connection, table: str, index: str | None = None, rows: int = 0, readers: int = 8) -> DataFrame:
    """The rows of a table; with ``index``, a column that runs from 0 to ``rows``, over several connections by its ranges."""
    ranges = partition_options(index, rows, readers) if index is not None and rows else {}
    return spark.read.jdbc(connection.url, table, properties=connection.properties() | {"preferTimestampNTZ": "true"}, **ranges)


def partition_options(index: str, rows: int, readers: int) -> dict[str, object]:
    return {"column": f'"{index}"', "lowerBound": 0, "upperBound": rows, "numPartitions": max(1, min(readers, rows))}


def check_loaded(before: int, sent: int, after: int) -> None:
    """Fail when a table did not grow by exactly the rows sent."""
    if after - before != sent:
        raise RuntimeError(f"sent {sent} rows but the table grew by {after - before}")
