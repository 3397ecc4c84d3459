"""The stream load: restart after a failure, replace on a fresh checkpoint, audit."""

import pytest
from pyspark.sql import functions as F

from sluice.functions.contract import Contract
from sluice.streaming import chunk_load

KV = Contract.of({"k": "bigint", "v": "string"})


@pytest.fixture
def load(put, tmp_path):
    for name, n in [("a", 25), ("b", 10), ("c", 31)]:
        put(f"in/{name}/part.csv.gz", "k,v\n" + "".join(f'{i},"{name}\n"\n' for i in range(n)))

    def make(work="w", **options):
        base = tmp_path / work
        return chunk_load.StreamLoad(
            source=str(tmp_path / "in"), contract=KV, target=str(base / "rows"), audit=str(base / "audit"),
            checkpoint=str(base / "checkpoint"), chunk_size=10, **options,
        )

    return make


def loaded(spark, load):
    df = spark.read.parquet(load.target)
    assert df.where(F.col("index") != F.col("k")).count() == 0
    return {r.v.strip(): r["count"] for r in df.groupBy("v").count().collect()}


def chunks(spark, load):
    name = F.regexp_extract("source_file", r"in/(\w)/", 1)
    return sorted(tuple(r) for r in spark.read.parquet(load.audit).select(name, "chunk_id", "inserted").collect())


ALL = {"a": 25, "b": 10, "c": 31}
ALL_CHUNKS = [("a", 0, 10), ("a", 1, 10), ("a", 2, 5), ("b", 0, 10), ("c", 0, 10), ("c", 1, 10), ("c", 2, 10), ("c", 3, 1)]


def test_all_files_once_with_index_and_audit(spark, load):
    it = load()
    chunk_load.start(spark, it).awaitTermination()
    assert loaded(spark, it) == ALL and chunks(spark, it) == ALL_CHUNKS
    assert spark.read.parquet(it.target).select("batch_id").distinct().count() == 3
    batches = chunk_load.progress(spark, it).orderBy("batch_id").collect()
    assert [r.batch_id for r in batches] == [0, 1, 2] and all(r.milliseconds > 0 for r in batches)
    assert sorted(r.inserted for r in batches) == [10, 25, 31]


def test_every_batch_has_a_time(spark, load, put, setting):
    """However many batches the query remembers itself."""
    setting("spark.sql.streaming.numRecentProgressUpdates", "2")
    for i in range(9):
        put(f"in/x{i}/part.csv.gz", "k,v\n0,y\n")
    it = load()
    query = chunk_load.start(spark, it)
    query.awaitTermination()
    assert len(query.recentProgress) <= 2
    batches = chunk_load.progress(spark, it).collect()
    assert len(batches) == 12 and all(r.milliseconds > 0 and r.inserted > 0 for r in batches)


def test_new_files_are_added_and_a_fresh_checkpoint_replaces(spark, load, put):
    it = load()
    chunk_load.start(spark, it).awaitTermination()
    put("in/d/part.csv.gz", "k,v\n0,d\n")
    chunk_load.start(spark, it).awaitTermination()
    assert loaded(spark, it) == ALL | {"d": 1}
    chunk_load.start(spark, it).awaitTermination()  # nothing new
    assert loaded(spark, it) == ALL | {"d": 1}

    fresh = chunk_load.StreamLoad(**{**it.__dict__, "checkpoint": it.checkpoint + "2", "max_files": 10})
    chunk_load.start(spark, fresh).awaitTermination()
    assert loaded(spark, it) == ALL | {"d": 1} and len(chunks(spark, it)) == 9


@pytest.mark.parametrize("batch", [0, 1])
@pytest.mark.parametrize("after", ["rows", "audit"])
def test_a_batch_that_fails_after_its_write_is_repeated_without_effect(spark, load, monkeypatch, batch, after):
    it, write, failed = load(), chunk_load.write_batch, []

    def write_then_fail(df, path, batch_id):
        write(df, path, batch_id)
        if batch_id == batch and path.endswith(after) and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(chunk_load, "write_batch", write_then_fail)
    with pytest.raises(Exception, match="lost after the write"):
        chunk_load.start(spark, it).awaitTermination()
    chunk_load.start(spark, it).awaitTermination()
    assert failed and loaded(spark, it) == ALL and chunks(spark, it) == ALL_CHUNKS


def test_a_file_with_a_header_only_loads_nothing(spark, load, put):
    put("in/e/part.csv.gz", "k,v\n")
    it = load()
    chunk_load.start(spark, it).awaitTermination()
    assert loaded(spark, it) == ALL and chunks(spark, it) == ALL_CHUNKS


def test_a_file_with_another_header_stops_the_stream(spark, load, put):
    it = load()
    put("in/z/part.csv.gz", "v,k\nz,0\n")
    with pytest.raises(Exception):
        chunk_load.start(spark, it).awaitTermination()
    assert "z" not in loaded(spark, it)


def test_plain_files_can_be_split(spark, load, put, setting, tmp_path):
    setting("spark.sql.files.maxPartitionBytes", "4096")
    put("plain/x.csv", "k,v\n" + "".join(f"{i},x\n" for i in range(5000)))
    it = chunk_load.StreamLoad(**{**load("p").__dict__, "source": str(tmp_path / "plain"), "multi_line": False})
    chunk_load.start(spark, it).awaitTermination()
    assert loaded(spark, it) == {"x": 5000}
