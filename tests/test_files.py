"""Folders of text files, literal rows and month addressing."""

import os

import pytest

from sluice.functions.contract import Contract
from sluice.sources import literals
from sluice.sources.files import file_inventory
from sluice.sources.months import TRIPS_FILE, month_paths, months_between, read_months

KV = Contract.of({"k": "bigint", "v": "string"})


def test_inventory(spark, put, tmp_path):
    put("box/file1.txt", "Hello from host")
    put("box/é ü.txt", "naïve\nlines\n")
    put("box/empty.txt", "")
    put("box/script.py", "print()")
    put("box/sub/inner.txt", "not listed")
    put("box/_hidden", "x")
    put("box/.hidden", "y")
    put("box/packed.txt.gz", "z")
    want = {
        ("file1.txt", True, 15, "Hello from host"), ("é ü.txt", True, 13, "naïve\nlines\n"), ("empty.txt", True, 0, ""),
        ("sub", False, None, None), ("_hidden", True, 1, "x"), (".hidden", True, 1, "y"),
    }
    df = file_inventory(spark, str(tmp_path / "box"), exclude="script.py").where("name <> 'packed.txt.gz'")
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    names = file_inventory(spark, f"file://{tmp_path}/box", contents=False)
    assert names.count() == 8 and names.where("content IS NOT NULL").count() == 0
    assert names.rdd.getNumPartitions() > 1
    os.makedirs(tmp_path / "none")
    assert file_inventory(spark, str(tmp_path / "none")).collect() == []
    with pytest.raises(Exception, match="not a folder"):
        file_inventory(spark, str(tmp_path / "box" / "file1.txt")).collect()


def test_content_must_be_utf8(spark, tmp_path):
    os.makedirs(tmp_path / "bad")
    (tmp_path / "bad" / "latin.txt").write_bytes(b"caf\xe9")
    df = file_inventory(spark, str(tmp_path / "bad"))
    assert df.select("name").count() == 1
    with pytest.raises(Exception, match="MALFORMED_CHARACTER_CODING"):
        df.select("content").collect()


def test_literal_rows_and_constant(spark):
    df = literals.with_constant(literals.literal_frame(spark, {"day": [1, 2], "num_passengers": [3, 4]}), "month", 7)
    assert df.dtypes == [("day", "bigint"), ("num_passengers", "bigint"), ("month", "bigint")]
    assert sorted(tuple(r) for r in df.collect()) == [(1, 3, 7), (2, 4, 7)]
    with pytest.raises(ValueError):
        literals.literal_frame(spark, {"a": [1], "b": [1, 2]})


def test_month_addresses():
    assert month_paths("s3a://b/" + TRIPS_FILE, (2021, 1)) == ["s3a://b/yellow_tripdata_2021-01.csv.gz"]
    assert months_between((2020, 11), (2021, 2)) == [(2020, 11), (2020, 12), (2021, 1), (2021, 2)]


def test_only_the_asked_months_are_read(spark, put, tmp_path):
    for month, n in [(1, 3), (2, 2), (3, 9)]:
        put(f"t/trips_2021-{month:02d}.csv.gz", "k,v\n" + "".join(f"{i},m{month}\n" for i in range(n)))
    put("t/trips_2021-04.csv.gz", "not,a\nvalid,month,at all\n")
    df = read_months(spark, str(tmp_path / "t" / "trips_{year}-{month:02d}.csv.gz"), (2021, 1), (2021, 2), contract=KV)
    assert df.columns == ["year", "month", "index", "k", "v"]
    assert sorted(tuple(r) for r in df.collect()) == [
        (2021, 1, 0, 0, "m1"), (2021, 1, 1, 1, "m1"), (2021, 1, 2, 2, "m1"), (2021, 2, 0, 0, "m2"), (2021, 2, 1, 1, "m2"),
    ]


def test_months_in_paths_with_odd_characters(spark, put, tmp_path):
    put("a+b (x)/t r+%20_2021-07.csv", "k,v\n0,a\n")
    template = str(tmp_path / "a+b (x)" / "t r+%20_{year}-{month:02d}.csv")
    assert [tuple(r) for r in read_months(spark, template, (2021, 7), contract=KV).collect()] == [(2021, 7, 0, 0, "a")]


def test_a_missing_month_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_months(spark, str(tmp_path / "none_{year}-{month:02d}.csv"), (2021, 1), contract=KV)
