"""Replacing folders and tables with a driver that is lost at every step."""

import os

import pytest
from pyspark.sql import functions as F

from sluice import session
from sluice.sinks import folders, tables
from sluice.sinks.folders import Folders, read_folder, recover, remove_working_files, replace_folder


class Lost(BaseException):
    pass


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("first", [True, False])
@pytest.mark.parametrize("step", range(8))
def test_a_driver_lost_at_any_step_leaves_old_rows_or_new(spark, tmp_path, monkeypatch, first, step):
    path, old, new = str(tmp_path / "out.parquet"), spark.range(3).toDF("v"), spark.range(10, 15).toDF("v")
    if not first:
        replace_folder(old, path)
    done = []

    def counting(name):
        call = getattr(Folders, name)

        def counted(self, *args):
            if len(done) == step:
                raise Lost
            done.append(name)
            return call(self, *args)

        return counted

    with monkeypatch.context() as lost:
        for name in ("rename", "delete", "exists"):
            lost.setattr(Folders, name, counting(name))
        try:
            replace_folder(new, path)
        except Lost:
            pass
    recover(spark, path)
    if os.path.exists(path):
        assert rows(read_folder(spark, path)) in ([rows(new)] if first else [rows(old), rows(new)])
    else:
        assert first
    replace_folder(new, path)
    assert rows(spark.read.parquet(path)) == rows(new)
    assert os.listdir(tmp_path) == ["out.parquet"]


def test_a_write_that_is_not_complete_is_undone(spark, tmp_path):
    path = str(tmp_path / "out")
    replace_folder(spark.range(3), path)
    os.rename(path, tmp_path / ".out.old-a1")
    os.makedirs(tmp_path / ".out.new-a1")  # without the mark of a complete write
    assert read_folder(spark, path).count() == 3 and os.listdir(tmp_path) == ["out"]


def test_a_bad_cell_leaves_the_folder(spark, tmp_path):
    path = str(tmp_path / "out")
    replace_folder(spark.range(3), path)
    with pytest.raises(Exception):
        replace_folder(spark.range(3).select(F.raise_error(F.lit("bad")).cast("bigint").alias("id")), path)
    assert spark.read.parquet(path).count() == 3
    replace_folder(spark.range(4), path)
    assert os.listdir(tmp_path) == ["out"] and read_folder(spark, path).count() == 4


def test_rows_are_replaced_by_rows_made_from_them(spark, tmp_path):
    path = str(tmp_path / "out")
    replace_folder(spark.range(5), path)
    replace_folder(read_folder(spark, path).where("id > 2"), path)
    assert rows(read_folder(spark, path)) == [(3,), (4,)]


def test_a_table_set_aside_comes_back(spark, tmp_path):
    spark.sql("CREATE TABLE torn (a bigint, b bigint) USING orc")
    spark.sql("INSERT INTO torn VALUES (1, 2)")
    spark.sql(f"ALTER TABLE torn RENAME TO torn{tables.ASIDE}{'0a' * 16}")
    tables.recover_table(spark, "torn")
    assert rows(spark.table("torn")) == [(1, 2)]
    spark.sql(f"CREATE TABLE torn{tables.ASIDE}{'0b' * 16} (a bigint) USING orc")
    tables.replace_table(spark.range(2), "torn", str(tmp_path))
    assert rows(spark.table("torn")) == [(0,), (1,)]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("torn")] == ["torn"]
    spark.sql("DROP TABLE torn")


def test_old_versions_go(spark, tmp_path):
    for n in (1, 2, 3):
        tables.replace_table(spark.range(n), "versions", str(tmp_path))
    assert len(os.listdir(tmp_path / "versions")) == 3
    assert tables.remove_old_versions(spark, "versions", str(tmp_path), older_than=3600) == []
    assert len(tables.remove_old_versions(spark, "versions", str(tmp_path))) == 2
    assert spark.table("versions").count() == 3 and len(os.listdir(tmp_path / "versions")) == 1
    spark.sql("DROP TABLE versions")


def test_working_files_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    assert folders.remove_working_files(spark, 3600) == []
    spark.range(2).write.parquet(session.fresh_dir(spark, "pieces"))
    assert remove_working_files(spark, 3600) == [] and len(os.listdir(tmp_path)) == 1
    assert len(remove_working_files(spark, -10)) == 1 and os.listdir(tmp_path) == []
