from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sluice.llm import queries, sharding

DATA = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, source string, text string"


def check(rows, shards):
    """Counts at most one apart, slots without gaps, each source spread as evenly as whole rows allow."""
    by_shard = defaultdict(list)
    for row in rows:
        by_shard[row.shard].append(row.slot)
    counts = [len(by_shard[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    of_source, held = Counter(r.source for r in rows), Counter((r.source, r.shard) for r in rows)
    for source, n in of_source.items():
        for s in range(shards):
            assert abs(held[source, s] - n * counts[s] / len(rows)) <= 1 + n * len(of_source) / len(rows), (source, s)


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_every_shard_matches_the_mixture(spark, setting, shards):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(i, "hot" if i % 3 == 0 else None if i % 50 == 1 else f"s{i % 7}", f"t{i}") for i in range(2000)]
    check(sharding.assigned(spark.createDataFrame(rows, SCHEMA).repartition(5), shards).collect(), shards)


def test_rows_do_not_depend_on_how_they_lie(spark):
    docs = spark.createDataFrame([(i, f"s{i % 4}", "t") for i in range(500)], SCHEMA)
    one, other = (sorted(map(tuple, sharding.assigned(d, 4).collect())) for d in (docs.repartition(7), docs.coalesce(1).orderBy(F.col("doc_id").desc())))
    assert one == other
    assert one != sorted(map(tuple, sharding.assigned(docs, 4, seed=1).collect()))


def test_edges(spark):
    rows = [(None, None, None)] * 5 + [(1, "a", "same")] * 40 + [(1, "a", "other"), (2, "", ""), (3, "b", "x" * 300_000)]
    found = sharding.assigned(spark.createDataFrame(rows, SCHEMA), 4).collect()
    check(found, 4)
    assert Counter(tuple(r)[:3] for r in found) == Counter(rows)
    assert sharding.assigned(spark.createDataFrame([], SCHEMA), 4).collect() == []
    assert [(r.shard, r.slot) for r in sharding.assigned(spark.createDataFrame(rows[-1:], SCHEMA), 8).collect()] == [(0, 0)]
    with pytest.raises(ValueError, match="shard"):
        sharding.assigned(spark.createDataFrame(rows, SCHEMA), 0)


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a", "x", 5, {"k": 1}, "r")], "doc_id long, source string, Shard string, slot int, key map<string,int>, rank string")
    found = sharding.assigned(docs, 2)
    assert found.columns == ["doc_id", "source", "Shard_", "slot_", "key", "rank", "shard", "slot"]
    assert tuple(found.first())[2:] == ("x", 5, {"k": 1}, "r", 0, 0)


def test_written_shards_hold_whole_rows(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"s{i % 3}", f"text {i}") for i in range(100)], SCHEMA)
    back = sharding.write(docs, str(tmp_path / "shards"), 4)
    assert sorted(p.name for p in (tmp_path / "shards").glob("shard=*")) == [f"shard={i}" for i in range(4)]
    check(back.collect(), 4)
    assert sorted(map(tuple, back.select(*docs.columns).collect())) == sorted(map(tuple, docs.collect()))


def test_query(spark):
    rows = queries.op11_sharding(spark, DATA).collect()
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    sources = dict(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "source").collect())
    assert len(rows) == len(sources) and {r.doc_id for r in rows} == set(sources)
