"""Replace, append, and what survives a failure."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.plans.jobs import month_job
from sluice.sinks import jdbc, tables


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "tables")


def values(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def test_replace_twice_leaves_one_copy(spark, folder):
    df = spark.range(10).withColumn("s", F.lit("x"))
    first = tables.replace_table(df, "twice", folder)
    second = tables.replace_table(df, "twice", folder)
    assert first.rows == second.rows == 10 and spark.table("twice").count() == 10
    assert second.replaced.endswith(first.location.rsplit("/", 1)[1])


def test_failed_replace_keeps_the_old_rows(spark, folder):
    tables.replace_table(spark.range(3), "kept", folder)
    failing = spark.range(1000).select(F.when(F.col("id") == 999, F.raise_error(F.lit("bad cell"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="bad cell"):
        tables.replace_table(failing, "kept", folder)
    assert values(spark, "kept") == [(0,), (1,), (2,)]


def test_replace_with_no_rows_empties_the_table(spark, folder):
    df = spark.range(3).withColumn("s", F.lit("x"))
    tables.replace_table(df, "emptied", folder)
    assert tables.replace_table(df.limit(0), "emptied", folder).rows == 0
    assert spark.table("emptied").count() == 0 and spark.table("emptied").columns == ["id", "s"]


def test_replace_with_another_schema(spark, folder):
    tables.replace_table(spark.range(3), "changed", folder)
    tables.replace_table(spark.range(2).select(F.lit("a").alias("VendorID")), "changed", folder)
    assert values(spark, "changed") == [("a",), ("a",)]


def test_append_adds_by_name_and_keeps_duplicates(spark, folder):
    df = spark.range(2).withColumn("s", F.lit("x"))
    tables.replace_table(df, "more", folder)
    assert tables.append_table(df.select("s", "id"), "more").rows == 2
    assert values(spark, "more") == [(0, "x"), (0, "x"), (1, "x"), (1, "x")]


def test_append_of_other_columns_is_refused(spark, folder):
    tables.replace_table(spark.range(2), "strict", folder)
    with pytest.raises(ValueError, match="strict"):
        tables.append_table(spark.range(2).withColumn("extra", F.lit(1)), "strict")


def test_month_frame(spark, tmp_path):
    path = month_job(spark, "01", str(tmp_path))
    assert os.path.basename(path) == "output_month_01.parquet"
    df = spark.read.parquet(path)
    assert df.dtypes == [("day", "bigint"), ("num_passengers", "bigint"), ("month", "bigint")]
    assert sorted(tuple(r) for r in df.collect()) == [(1, 3, 1), (2, 4, 1)]
    month_job(spark, "01", str(tmp_path))
    assert spark.read.parquet(path).count() == 2


def test_month_must_be_a_number(spark, tmp_path):
    with pytest.raises(ValueError):
        month_job(spark, "January", str(tmp_path))


def test_connection_does_not_show_credentials():
    connection = jdbc.Connection("someone", "secret", "db.example", 5433, "trips")
    assert connection.url == "jdbc:postgresql://db.example:5433/trips"
    assert "secret" not in repr(connection) and "someone" not in repr(connection)
    with pytest.raises(TypeError):
        jdbc.Connection()


def test_writes_and_reads_pass_the_right_options(spark, monkeypatch):
    """No database is started here: what would be sent to Spark's JDBC source is looked at instead."""
    from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode, properties: (self._df.collect(), calls.append((url, table, mode, properties))))
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, properties, **ranges: calls.append((url, table, properties, ranges)))
    connection = jdbc.Connection("u", "p")
    assert jdbc.write_jdbc(spark.range(3), connection, "t", replace=True, writers=3) == 3
    assert jdbc.write_jdbc(spark.range(5), connection, "t", replace=False) == 5
    jdbc.read_jdbc(spark, connection, "t")
    jdbc.read_jdbc(spark, connection, "t", "index", 1000, 4)
    assert calls.pop()[3] == {"column": '"index"', "lowerBound": 0, "upperBound": 1000, "numPartitions": 4}
    url = "jdbc:postgresql://localhost:5432/ny_taxi"
    assert [c[:2] for c in calls] == [(url, "t")] * 3
    assert [c[2] for c in calls[:2]] == ["overwrite", "append"]
    assert calls[0][3]["numPartitions"] == "3" and calls[0][3]["user"] == "u" and calls[2][2]["preferTimestampNTZ"] == "true"


def test_load_check_finds_repeated_rows():
    jdbc.check_loaded(5, 10, 15)
    with pytest.raises(RuntimeError, match="sent 10 rows but the table grew by 12"):
        jdbc.check_loaded(5, 10, 17)
