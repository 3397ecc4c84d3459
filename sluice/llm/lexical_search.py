"""The best documents for each of many text items, by integer scores, searched in buckets of vector length.

A document is a vector of impacts, one for each term that some item has; an item
is a vector of how often it holds a term. Both sides are scaled by the root of
the term's weight, so their inner product is the score. Vectors are ordered by
length and cut into buckets. The longest ones are searched first and give each
item a first threshold: the score of its k-th best document so far. By the
inequality of Cauchy and Schwarz no document of a bucket can reach a score above
the item's length times the longest vector, so whole buckets are skipped. In
those left an item's heaviest terms are taken until the rest of it, times the
longest vector, falls short of the threshold: only documents with one of these
terms can reach it, and each of them only if what these terms give, plus the
product of the two remaining lengths, does. Survivors are scored anew in whole
numbers. Bounds in doubles are widened by more than their rounding, so none is lost.

Null texts and texts without a term match nothing and do not count; each row of
either table stands for itself, so repeated ids give repeated rows. Documents
without an id come after others of the same score. Ids of documents are whole
numbers. An empty table on either side gives no rows. Texts are read whole, a
bounded stretch at a time.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.work import ship, stored

#: Bytes that belong to a term, A to Z as a to z; every other byte is a space.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
STRETCH = 1 << 20
ITEM_BYTES = 8 << 20  # text of the items that are searched for together, and so of what each task is sent
BUCKET = 4096  # vectors
FIRST_SHARE = 1 / 16  # of the vectors, the longest, that give the first thresholds
SLACK = 1 + 1e-9
VECTORS = "id bigint, n bigint, terms array<int>, counts array<bigint>"
IMPACTS = "id bigint, length double, terms array<int>, impacts array<bigint>"
FOUND = "item int, id bigint, score bigint"


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a stretch at a time."""
    data, at = text.translate(TABLE), 0
    while at < len(data):
        end = data.find(b" ", at + STRETCH)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def counted(text: bytes | None) -> tuple[int, Counter]:
    """How many terms a text has, and how often each."""
    n, counts = 0, Counter()
    for some in tokens(text or b""):
        n += len(some)
        counts.update(some)
    return n, counts


# --- items -----------------------------------------------------------------------------------


@dataclass
class Items:
    """Some items, by number: their terms by number, and how often each holds a term."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    terms: list[np.ndarray] = field(default_factory=list)
    counts: list[np.ndarray] = field(default_factory=list)

    def add(self, text: bytes | None) -> None:
        _, found = counted(text)
        self.terms.append(np.array([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in found], np.int64))
        self.counts.append(np.array(list(found.values()), np.int64))


# --- vectors ---------------------------------------------------------------------------------


def vectors(docs: DataFrame, items: Items, id: str, text: str) -> DataFrame:
    """For each document that has terms: how many, and the number and count of those that items have."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(items.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            keys, ids, ns, terms, counts, ends = batch.column(0), [], [], [], [], [0]
            for i, value in enumerate(batch.column(1).cast(pa.binary())):
                n, found = counted(value.as_py())
                if not n:
                    continue
                hits = sorted((known[t], c) for t, c in found.items() if t in known)
                ids.append(i)
                ns.append(n)
                terms += [t for t, _ in hits]
                counts += [c for _, c in hits]
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(ids, pa.int64())), pa.array(ns, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))],
                names=["id", "n", "terms", "counts"],
            )

    return docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text")).mapInArrow(run, VECTORS)


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def impacts_of(counts: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Impact of each term by its count and the terms in its document; 64-bit, divisions rounding down."""
    if 75 * int(n.max(initial=0)) * documents < 1 << 63:
        m = 25 + (75 * n * documents) // total
    else:
        m = np.array([25 + (75 * int(x) * documents) // total for x in n], np.int64)
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


def lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values and ends of a list column, one more end than rows."""
    column = batch.column(batch.schema.get_field_index(name))
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def impacts(found: DataFrame, weights: np.ndarray, documents: int, total: int) -> DataFrame:
    """Vectors of impacts and their lengths; documents without a term of the items have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            terms, ends = lists(batch, "terms")
            counts, _ = lists(batch, "counts")
            sizes = np.diff(ends)
            n = np.repeat(batch.column(1).to_numpy(), sizes)
            values = impacts_of(counts, n, documents, total)
            squares = weights[terms] * values.astype(float) ** 2
            length = np.sqrt(np.add.reduceat(squares, ends[:-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(length, pa.float64()), batch.column(2), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))],
                names=["id", "length", "terms", "impacts"],
            )

    return found.where("size(terms) > 0").mapInArrow(run, IMPACTS)


# --- search ----------------------------------------------------------------------------------


@dataclass
class Best:
    """The k best documents of an item so far, and the score that a better one must reach."""

    k: int
    threshold: int
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    nameless: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def add(self, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        scores, ids, nameless = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.nameless, nameless)))
        order = np.lexsort((ids, nameless, -scores))[: self.k]
        self.scores, self.ids, self.nameless = scores[order], ids[order], nameless[order]
        if len(order) == self.k:
            self.threshold = max(self.threshold, int(self.scores[-1]))


class Search:
    """Items against buckets of vectors; thresholds rise as documents are found."""

    def __init__(self, items: Items, weights: np.ndarray, thresholds: list[int], k: int):
        self.weights, self.root = weights, np.sqrt(weights.astype(float))
        self.best = [Best(k, t) for t in thresholds]
        self.terms, self.scaled, self.rest, self.whole = [], [], [], []
        for terms, counts in zip(items.terms, items.counts, strict=True):
            scaled = self.root[terms] * counts
            heaviest = np.argsort(-scaled, kind="stable")
            self.terms.append(terms[heaviest])
            self.scaled.append(scaled[heaviest])
            left = np.concatenate((np.cumsum(scaled[heaviest][::-1] ** 2)[::-1], [0.0]))
            self.rest.append(np.sqrt(left))  # length of an item without its first terms
            self.whole.append((weights[terms] * counts)[heaviest])
        self.lengths = np.array([r[0] for r in self.rest])
        self.of_term = np.zeros(len(weights), np.int64)  # what an item gives for each term, while it is rescored

    def bucket(self, ids: np.ndarray, nameless: np.ndarray, length: np.ndarray, terms: np.ndarray, values: np.ndarray, ends: np.ndarray) -> None:
        longest = float(length.max())
        reach = self.lengths * longest * SLACK
        alive = [i for i, best in enumerate(self.best) if reach[i] >= best.threshold and self.lengths[i] > 0]
        if not alive:
            return
        rows, sizes = len(ids), np.diff(ends)
        order = np.argsort(terms, kind="stable")
        document = np.repeat(np.arange(rows), sizes)[order]
        scaled = self.root[terms[order]] * values[order]
        first = np.searchsorted(terms[order], np.arange(len(self.weights) + 1))
        for i in alive:
            best, rest = self.best[i], self.rest[i]
            short = rest * longest * SLACK < best.threshold
            focus = int(np.argmax(short)) if short.any() else len(rest) - 1
            wanted = self.terms[i][:focus]
            many = first[wanted + 1] - first[wanted]
            at = np.repeat(first[wanted] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            given, by = scaled[at], document[at]
            got = np.bincount(by, given * np.repeat(self.scaled[i][:focus], many), rows)
            used = np.bincount(by, given**2, rows)
            bound = got + rest[focus] * np.sqrt(np.maximum(length**2 - used, 0) + 1e-9 * length**2)
            keep = np.flatnonzero((bound * SLACK >= best.threshold) & (got > 0))
            if len(keep):
                scores = self.rescored(i, keep, terms, values, ends)
                reached = scores >= best.threshold
                best.add(scores[reached], ids[keep[reached]], nameless[keep[reached]])

    def rescored(self, i: int, keep: np.ndarray, terms: np.ndarray, values: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Exact scores of some documents of a bucket, in whole numbers."""
        self.of_term[self.terms[i]] = self.whole[i]
        sizes = ends[keep + 1] - ends[keep]
        begins = np.cumsum(sizes) - sizes
        at = np.repeat(ends[keep] - begins, sizes) + np.arange(sizes.sum())
        scores = np.add.reduceat(self.of_term[terms[at]] * values[at], begins)
        self.of_term[self.terms[i]] = 0
        return scores


def searched(vectors: DataFrame, items: Items, weights: np.ndarray, thresholds: list[int], k: int) -> DataFrame:
    """The k best documents of each item in each task."""
    shared = vectors.sparkSession.sparkContext.broadcast((items.terms, items.counts, weights, thresholds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts, each_weight, least = shared.value
        search = Search(Items({}, terms, counts), each_weight, least, k)
        for batch in batches:
            longest_first = np.argsort(-batch.column(1).to_numpy(), kind="stable")
            batch = batch.take(pa.array(longest_first))
            for start in range(0, batch.num_rows, BUCKET):
                part = batch.slice(start, BUCKET)
                of_terms, ends = lists(part, "terms")
                values, _ = lists(part, "impacts")
                ids = part.column(0)
                search.bucket(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), part.column(1).to_numpy(), of_terms, values, ends)
        for number, best in enumerate(search.best):
            if len(best.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best.ids), number), pa.int32()), pa.array(best.ids, pa.int64(), mask=best.nameless), pa.array(best.scores, pa.int64())],
                    names=["item", "id", "score"],
                )

    return vectors.mapInArrow(run, FOUND)


def best_of(found: DataFrame, k: int) -> DataFrame:
    by_score = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)


def search_block(docs: DataFrame, block: DataFrame, k: int, id: str, text: str) -> DataFrame:
    """The best documents of the items of one block: (item_id, rank, doc_id, score)."""
    spark, items = docs.sparkSession, Items()
    rows = block.orderBy("item", "text").collect()  # at most about ITEM_BYTES of text, see `search`
    for row in rows:
        items.add(None if row["text"] is None else row["text"].encode())
    names = spark.createDataFrame([(i, row["item"]) for i, row in enumerate(rows)], f"item int, name {block.schema['item'].dataType.simpleString()}")
    nothing = names.limit(0).selectExpr("name AS item_id", "0 AS rank", "0L AS doc_id", "0L AS score")
    known = stored(vectors(docs, items, id, text), "terms")
    stats = known.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("total")).first()
    if not stats.documents or not items.vocabulary:
        return nothing
    weights = np.array([weight(stats.documents, 0)] * len(items.vocabulary), np.int64)
    for row in known.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[row["term"]] = weight(stats.documents, row["count"])
    by_length = impacts(known, weights, stats.documents, stats.total).repartitionByRange(F.col("length").desc(), "id")
    ordered = stored(by_length.sortWithinPartitions(F.col("length").desc()), "impacts")
    cut = ordered.approxQuantile("length", [1 - FIRST_SHARE], 0.01)
    if not cut:
        return nothing
    longest = stored(searched(ordered.where(F.col("length") >= cut[0]), items, weights, [1] * len(rows), k), "longest")
    thresholds = [1] * len(rows)
    for row in best_of(longest, k).where(F.col("rank") == k).collect():
        thresholds[row["item"]] = row["score"]
    others = searched(ordered.where(F.col("length") < cut[0]), items, weights, thresholds, k)
    found = best_of(longest.unionByName(others), k).join(F.broadcast(names), "item")
    return found.select(F.col("name").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item that score above 0, equal scores by id.

    Items go in blocks of about `ITEM_BYTES` of text, since each task holds the
    terms of a block; every block is searched for in all documents.
    """
    if k < 1:
        raise ValueError("k must be positive")
    ship(docs.sparkSession)
    items = items.select(F.col(item).alias("item"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-2 * size // ITEM_BYTES) if size > ITEM_BYTES else 1
    block_of = F.pmod(F.xxhash64("item", "text", F.lit(12)), F.lit(blocks))
    parts = [search_block(docs, items.where(block_of == b) if blocks > 1 else items, k, id, text) for b in range(blocks)]
    return reduce(DataFrame.unionByName, parts)
