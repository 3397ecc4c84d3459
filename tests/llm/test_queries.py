"""The operators' queries against their SQL, and the entry with and without the subpackage."""

import os
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from sluice.llm import queries

SF_DIR = "/root/testdata/sf0.01"
ROOT = Path(entry.__file__).resolve().parent


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    df = queries.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs = Counter(tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall())
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == theirs


def test_one_query_for_each_operator():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names


@pytest.mark.parametrize("missing", [["corpus_pipeline.py", "sluice/llm"], ["corpus_pipeline.py"], ["sluice/llm"]])
def test_entry_without_the_subpackage(tmp_path, missing):
    left_out = {str(ROOT / m) for m in missing}
    shutil.copytree(ROOT, tmp_path / "copy", ignore=lambda folder, names: [n for n in names if n.startswith(".") or n == "__pycache__" or os.path.join(folder, n) in left_out])
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), *e.queries())"
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", env=os.environ | {"PYTHONPATH": "."}, capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stderr
    assert found.stdout.split() == [str(len(entry.own_queries()))] * 2 + list(entry.own_queries())
