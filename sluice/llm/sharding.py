"""Shards that each hold the corpus in small: sources interleaved in proportion, then cut.

The rows of each source are shuffled by a seed and ranked: the row of rank r
among n has the place (r + 1/2) / n. In the order of places all sources run side
by side, each at its own even pace, so every stretch of the sequence holds the
mixture. It is cut into shards whose counts differ by one at most (the law
`rows`).

A null source is a source. Rows that repeat are each placed; rows with equal ids
are told apart by their other columns, and rows that are equal in all are
interchangeable. Texts of any length count as one row. An empty table gives no
rows. Columns of the input named as a result are kept with `_` behind the name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.work import making_room, unused
from sluice.operators.ordering import in_order

LAW = "rows"


def shuffled(seed: int, id: Column) -> Column:
    """A key whose order is a shuffle of the ids, the same for a seed wherever it runs."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), id.cast("string")).cast("binary"))


def assigned(docs: DataFrame, shards: int, source: str = "source", id: str = "doc_id", seed: int = 0, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """`docs` with the shard of each row, and its slot: its place in the shard, from 0 without gaps."""
    if shards < 1:
        raise ValueError("there must be a shard")
    docs = making_room(docs, shard, slot)
    source, id = (c if c in docs.columns else c + "_" for c in (source, id))
    key, rest, tie, rank, n, place, at, rows = unused(docs, "key", "rest", "tie", "rank", "n", "place", "at", "rows")
    plain = [f"`{f.name}`" for f in docs.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    keyed = (
        docs.withColumn(key, shuffled(seed, F.col(id)))
        .withColumn(rest, F.xxhash64(*plain))
        .withColumn(tie, F.monotonically_increasing_id())  # spreads rows that are equal in all columns
    )
    ranked = in_order(keyed, [key, id, rest, tie], [source], rank, n)
    placed = ranked.withColumn(place, (2 * F.col(rank) + 1) / (2 * F.col(n)))
    whole = in_order(placed, [place, source, key, id, rest, tie], (), at, rows)
    number = f"((`{at}` * {shards}L) div `{rows}`)"
    begins = F.expr(f"({number} * `{rows}` + {shards - 1}L) div {shards}L")
    return whole.withColumn(shard, F.expr(number).cast("int")).withColumn(slot, F.col(at) - begins).drop(key, rest, tie, rank, n, place, at, rows)


def write(docs: DataFrame, folder: str, shards: int, source: str = "source", id: str = "doc_id", seed: int = 0) -> DataFrame:
    """Write whole rows, one folder `shard=N` each with its rows in the order of slots; gives the written rows."""
    placed = assigned(docs, shards, source, id, seed)
    dealt = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").parquet(folder)
    return docs.sparkSession.read.schema(placed.schema).parquet(folder)
