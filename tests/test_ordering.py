"""Positions and running totals on two levels, against one sorted list."""

import random

import pytest
from pyspark.sql import functions as F

from sluice.operators.ordering import in_order, running_total


def frame(spark, n=600, seed=1):
    pick = random.Random(seed)
    rows = [(i, pick.choice(["hot", "hot", None, "a", "b"]), pick.randrange(50), pick.randrange(9)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, `a.b` string, key int, size long").repartition(7)


@pytest.mark.parametrize("within", [[], ["a.b"]])
def test_positions(spark, setting, within):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows, df = frame(spark)
    found = in_order(df, ["key", F.col("id").desc()], within)
    assert sorted(found.columns) == sorted([*df.columns, "position", "total"])
    groups = {}
    for r in rows:
        groups.setdefault(r[1] if within else 0, []).append(r)
    want = {r[0]: (i, len(g)) for g in groups.values() for i, r in enumerate(sorted(g, key=lambda r: (r[2], -r[0])))}
    assert {r.id: (r.position, r.total) for r in found.collect()} == want


@pytest.mark.parametrize("within", [[], ["a.b"]])
def test_totals(spark, setting, within):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows, df = frame(spark, seed=2)
    groups = {}
    for r in rows:
        groups.setdefault(r[1] if within else 0, []).append(r)
    want = {}
    for g in groups.values():
        before = 0
        for r in sorted(g, key=lambda r: (r[2], r[0])):
            want[r[0]], before = before, before + r[3]
    assert {r.id: r.before for r in running_total(df, "size", ["key", "id"], within).collect()} == want


def test_rows_that_tie_and_empty_tables(spark):
    same = spark.createDataFrame([(1, "x")] * 40, "k int, t string")
    assert sorted(r.position for r in in_order(same, ["k"]).collect()) == list(range(40))
    assert in_order(same.limit(0), ["k"]).collect() == [] == running_total(same.limit(0), "k", ["t"]).collect()


def test_one_key_does_not_go_to_one_task(spark, setting):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    setting("spark.sql.shuffle.partitions", "8")
    hot = spark.range(8000).select(F.lit("hot").alias("source"), F.xxhash64("id").alias("key"))
    dealt = hot.repartitionByRange("source", "key").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in dealt) < 2000
    assert in_order(hot, ["key"], ["source"]).agg(F.max("position")).first()[0] == 7999
