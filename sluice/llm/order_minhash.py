"""Near-duplicate texts by Order MinHash, candidates verified by banded alignment.

A text's k-mers are its runs of `k` words, each labelled with how often it has
occurred before. Each of the sketch's hash functions takes the `least` smallest
labelled k-mers and keeps them in text order, so two texts agree on an entry
only if they share those k-mers in the same order: sensitive to edits, not to
the bag of words alone. Entries are joined in bands of `rows`.

Texts that meet in a band are compared by alignment: with M the longest common
subsequence of their k-mer sequences, similarity is M / (n1 + n2 - M). Where no
order changes and nothing repeats this is the Jaccard similarity of the shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import textbytes
from sluice.llm.graph import components
from sluice.llm.work import ship, stored, unused


@dataclass(frozen=True)
class OrderMinHash:
    """Two texts of similarity s share a band with probability s**6, about.

    Those of similarity 0.8 share none of the 32 with a probability below 1 in
    10 000, more similar ones still less often. `block` bounds the texts, and
    `block_chars` about their characters, that are compared with another such lot at a time.
    """

    k: int = 5
    similarity: float = 0.8
    least: int = 3
    rows: int = 2
    bands: int = 32
    seed: int = 7
    block: int = 256
    block_chars: int = 4_000_000


CELLS = 1 << 21  # of the matrix of hash values at a time
COLUMNS = 2048  # of the matrix of k-mers at a time


def kmers(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k words; a shorter text is one k-mer, an empty one has none."""
    if not len(words):
        return words
    k = min(k, len(words))
    weights = textbytes.mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    n = len(words) - k + 1
    total = np.full(n, np.uint64(k))
    for i in range(k):
        total += words[i : i + n] * weights[i]
    return textbytes.mix(total)


def labelled(x: np.ndarray) -> np.ndarray:
    """Each k-mer joined with the number of its earlier occurrences; a first occurrence is the k-mer itself, whatever else repeats."""
    order = np.argsort(x, kind="stable")
    same = np.concatenate(([False], x[order][1:] == x[order][:-1]))
    if not same.any():
        return x
    at = np.arange(len(x))
    earlier = at - np.maximum.accumulate(np.where(same, 0, at))
    label = np.empty(len(x), np.uint64)
    label[order] = earlier
    return np.where(label == 0, x, textbytes.mix(x + label * np.uint64(0xD6E8FEB86659FD93)))


class Sketcher:
    def __init__(self, how: OrderMinHash):
        rng = np.random.default_rng(how.seed)
        self.how, n = how, how.rows * how.bands
        draw = lambda size: rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.masks, self.factors = draw(n), draw(n)
        self.places, self.in_band, self.band = draw(how.least), draw(how.rows), draw(how.bands)

    def entries(self, x: np.ndarray) -> np.ndarray:
        """One value per hash function: its smallest labelled k-mers in text order."""
        take = min(self.how.least, len(x))
        step, parts = max(1, CELLS // len(x)), []
        for i in range(0, len(self.masks), step):
            values = (x[None, :] ^ self.masks[i : i + step, None]) * self.factors[i : i + step, None]
            row, found = np.arange(len(values)), []
            for _ in range(take):
                at = values.argmin(axis=1)
                found.append(at)
                values[row, at] = np.iinfo(np.uint64).max
            parts.append((x[np.sort(np.stack(found, 1), axis=1)] * self.places[:take]).sum(axis=1, dtype=np.uint64))
        return np.concatenate(parts)

    def keys(self, words: np.ndarray) -> np.ndarray:
        """One key per band; none for a text without words."""
        x = kmers(words, self.how.k)
        if not len(x):
            return np.zeros(0, np.int64)
        entries = textbytes.mix(self.entries(labelled(x))).reshape(self.how.bands, self.how.rows)
        return textbytes.mix((entries * self.in_band).sum(axis=1, dtype=np.uint64) + self.band).view(np.int64)


def sketches(texts: DataFrame, how: OrderMinHash) -> DataFrame:
    """(node, text) to (node, keys)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(how)
        for batch in batches:
            keys = []
            for block in textbytes.blocks(batch.column("text")):
                starts, ends, first = block.words()
                hashes = block.word_hashes(starts, ends)
                keys += [sketcher.keys(hashes[first[i] : first[i + 1]]) for i in range(block.n)]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in keys]))).astype(np.int32)
            values = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.ListArray.from_arrays(offsets, values)], ["node", "keys"]
            )

    return texts.select("node", "text").mapInArrow(run, "node bigint, keys array<bigint>")


def common_in_band(a: list, b: list, width: int) -> int:
    """Longest common subsequence of a and b over places that differ by at most `width`.

    One bit per place of `a` inside the band, one step of whole-number
    arithmetic per element of `b`: a zero bit stands for a matched place. The
    window moves along with the band; places that leave it at the bottom are
    settled, those that enter at the top are still free.
    """
    places: dict = {}
    for i, x in enumerate(a):
        places.setdefault(x, []).append(i)
    found, size = 0, min(len(a), width + 1)
    base, state = 0, (1 << size) - 1
    first_seen: dict = {}
    for j, x in enumerate(b):
        low, high = max(0, j - width), min(len(a), j + width + 1)
        if low > base:  # at most one place leaves at a time
            found += 1 - (state & 1)
            state >>= 1
            base, size = base + 1, size - 1
        if high > base + size:
            state |= 1 << size
            size += 1
        at, mask = places.get(x), 0
        if at:
            i = first_seen.get(x, 0)
            while i < len(at) and at[i] < base:
                i += 1
            first_seen[x] = i
            while i < len(at) and at[i] < high:
                mask |= 1 << (at[i] - base)
                i += 1
        if mask:
            hit = state & mask
            state = ((state + hit) | (state - hit)) & ((1 << size) - 1)
    return found + size - state.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Similarity of two k-mer sequences; 0 where it is certain to be below `least`."""
    if not len(a) or not len(b):
        return 0.0
    both = len(a) + len(b)
    enough = least * both / (1 + least) - 1e-9  # common k-mers that make the pair similar
    if min(len(a), len(b)) < enough:
        return 0.0
    if len(a) == len(b) and (a == b).all():
        return 1.0
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if np.minimum(n[i], m[j]).sum() < enough:
        return 0.0
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
    tail = int(differ[0]) if len(differ) else short
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    width = int(both - 2 * enough) + 1  # more k-mers unmatched than this, and the pair is not similar
    common = head + tail + common_in_band(a.tolist(), b.tolist(), width)
    return common / (both - common)


def sequences(column: pa.Array | pa.ChunkedArray, k: int) -> Iterator[np.ndarray]:
    """The k-mers of each text."""
    for block in textbytes.blocks(column):
        starts, ends, first = block.words()
        hashes = block.word_hashes(starts, ends)
        for i in range(block.n):
            yield kmers(hashes[first[i] : first[i + 1]], k)


def verify(pairs: DataFrame, texts: DataFrame, how: OrderMinHash) -> DataFrame:
    """Pairs (a, b) of nodes whose texts are similar, with the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                similarity(x, y, how.similarity)
                for x, y in zip(sequences(batch.column("a_text"), how.k), sequences(batch.column("b_text"), how.k), strict=True)
            ]
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], ["a", "b", "similarity"])
            yield out.filter(pa.array([x >= how.similarity for x in found], pa.bool_()))

    with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
    both = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
    return both.select("a", "b", "a_text", "b_text").mapInArrow(run, "a bigint, b bigint, similarity double")


def near_duplicates(docs: DataFrame, how: OrderMinHash = OrderMinHash(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """(node, class_node): each distinct text that has words, and the smallest text of its class.

    A node is a 64-bit hash of a text, so equal texts are one node however many rows
    repeat them. Classes are the connected components of similar pairs. The
    work is done in two passes over the bands:

    1. In each bucket the smallest node is compared with every other one:
       linear in the bucket, and enough for a bucket of copies.
    2. In buckets whose nodes are not all of one class by then, every node outside
       the largest class is compared with all nodes of other classes, a block
       with a block: no pair becomes a row, and no link between nodes that met in
       a bucket is lost.

    Texts are read where pairs need them only, one row for each node.
    Null and empty texts, and texts of separators alone, belong to no class.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    rows = rows.withColumn("node", node_of("text"))
    sketched = stored(sketches(rows, how).where(F.size("keys") > 0).dropDuplicates(["node"]), "sketches")
    keyed = sketched.select(F.explode("keys").alias("key"), "node")
    least = keyed.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z")
    met = stored(keyed.join(least.select("key", "a"), "key"), "buckets")  # nodes of buckets with two or more
    pairs = stored(met.where("a <> node").select("a", F.col("node").alias("b")).distinct(), "pairs")
    texts = node_texts(rows, met.select("node").distinct())
    links = stored(verify(pairs, texts, how), "similar")
    classes = stored(components(links), "classes")

    member = mixed_buckets(classed(met.select("key", "node"), classes, "node"))
    more = stored(compared(dealt(member.join(texts, "node"), how), how), "similar")
    return grown(sketched, classes, more).select("node", F.col("component").alias("class_node"))


def grown(nodes: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) of all nodes after more links (a, b) have joined some of the classes."""
    ends = classed(classed(links.select("a", "b"), classes, "a", "x"), classes, "b", "y")
    top = components(ends, "x", "y").select(F.col("node").alias("class"), F.col("component").alias("top"))
    found = classed(nodes.select("node"), classes, "node").join(top, "class", "left")
    return stored(found.select("node", F.coalesce("top", "class").alias("component")), "classes")


def classed(rows: DataFrame, classes: DataFrame, node: str, out: str = "class") -> DataFrame:
    """`rows` with the class of a column of nodes; a node without links is its own."""
    known = classes.select(F.col("node").alias(node), F.col("component").alias("known"))
    return rows.join(known, node, "left").withColumn(out, F.coalesce("known", node)).drop("known")


def mixed_buckets(member: DataFrame) -> DataFrame:
    """Rows (key, node, class) of the buckets that hold more than one class."""
    mixed = member.groupBy("key").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x <> y").select("key")
    return stored(member.join(mixed, "key"), "mixed")


def dealt(member: DataFrame, how: OrderMinHash) -> DataFrame:
    """Rows (key, node, class, text) as blocks to compare: (key, one, two, part, node, class, text).

    A bucket's largest class and the nodes outside it are cut into blocks by
    hash. Blocks outside meet each other and those of the class, whose own
    blocks never meet. `one` and `two` name the blocks, `part` the node's own.
    """
    sizes = member.groupBy("key", "class").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))
    total = sizes.groupBy("key").agg(
        F.max_by(F.struct("class", "n", "chars"), F.struct("n", "class")).alias("top"), F.sum("n").alias("n"), F.sum("chars").alias("chars")
    )
    count = lambda n, chars: F.greatest(F.ceil(n / how.block), F.ceil(chars / how.block_chars), F.lit(1)).cast("int")
    plan = total.select(
        "key",
        F.col("top.class").alias("largest"),
        count(F.col("top.n"), F.col("top.chars")).alias("inside"),
        count(F.col("n") - F.col("top.n"), F.col("chars") - F.col("top.chars")).alias("outside"),
    )
    rows = member.join(plan, "key").withColumn("out", F.col("class") != F.col("largest"))
    own = F.pmod(F.xxhash64("node", "key"), F.when(F.col("out"), F.col("outside")).otherwise(F.col("inside"))).cast("int")
    rows = rows.withColumn("part", F.when(F.col("out"), own).otherwise(-1 - own))  # blocks inside have negative numbers
    others = F.sequence(F.lit(0), F.col("outside") - 1)
    inside = F.sequence(F.lit(-1), -F.col("inside"), F.lit(-1))
    rows = rows.withColumn("other", F.explode(F.when(F.col("out"), F.concat(others, inside)).otherwise(others)))
    pair = [F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two")]
    return rows.select("key", *pair, "part", "node", "class", "text")


def compared(blocks: DataFrame, how: OrderMinHash) -> DataFrame:
    """(a, b): similar nodes of different classes in each pair of blocks, as many as it takes to connect those classes."""

    def run(table: pa.Table) -> pa.Table:
        part, node, klass = (table.column(c).to_numpy() for c in ("part", "node", "class"))
        x = list(sequences(table.column("text"), how.k))
        found = connecting(x, part, klass, how.similarity)
        return pa.table({"a": pa.array([int(node[i]) for i, _ in found], pa.int64()), "b": pa.array([int(node[j]) for _, j in found], pa.int64())})

    return blocks.groupBy("key", "one", "two").applyInArrow(run, "a bigint, b bigint")


def connecting(x: list[np.ndarray], part: np.ndarray, klass: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Links between texts of different classes, across parts if there are two, that connect all classes which links connect.

    Common k-mers are counted for all pairs at once, by products of matrices
    with a row per text; pairs that could be similar by them are aligned, most
    common first, unless their classes are connected by then.
    """
    sizes = np.array([len(s) for s in x])
    bags = [labelled(s) for s in x]
    row = np.repeat(np.arange(len(x)), sizes)
    _, column, n = np.unique(np.concatenate(bags), return_inverse=True, return_counts=True)
    shared = n[column] > 1
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    common = np.zeros((len(x), len(x)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, (first, first + COLUMNS))
        some = np.zeros((len(x), COLUMNS), np.float32)
        some[row[lo:hi], column[lo:hi] - first] = 1
        common += some @ some.T
    enough = least * (sizes[:, None] + sizes[None, :]) / (1 + least) - 1e-3
    possible = np.triu(common >= enough, 1) & (klass[:, None] != klass[None, :])
    if part.min() != part.max():
        possible &= part[:, None] != part[None, :]
    i, j = np.nonzero(possible)
    order = np.argsort(-(common[i, j] / (sizes[i] + sizes[j])), kind="stable")
    name = {c: c for c in klass.tolist()}
    out = []
    for a, b in zip(i[order].tolist(), j[order].tolist(), strict=True):
        p, q = root(name, int(klass[a])), root(name, int(klass[b]))
        if p != q and similarity(x[a], x[b], least) >= least:
            name[q] = p
            out.append((a, b))
    return out


def root(name: dict[int, int], x: int) -> int:
    while name[x] != x:
        name[x] = name[name[x]]
        x = name[x]
    return x


def node_of(text: str) -> F.Column:
    return F.xxhash64(F.col(text))


def node_texts(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """One text for each of the nodes. Copies of a text stay behind: only the rows with its smallest id are moved."""
    first = rows.groupBy("node").agg(F.min("id").alias("id")).join(nodes, "node", "left_semi")
    first = first.withColumnRenamed("node", "n").withColumnRenamed("id", "i")
    same = (F.col("node") == F.col("n")) & F.col("id").eqNullSafe(F.col("i"))
    return stored(rows.join(first, same, "left_semi").select("node", "text").dropDuplicates(["node"]), "texts")


def duplicate_classes(docs: DataFrame, how: OrderMinHash = OrderMinHash(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id), one row per row of `docs`: the smallest id of the documents in its class.

    Rows that repeat an id or a text get a row each. An id that is null names no
    class; a class without any other id has a null class_id. Documents without
    words are a class of their own.
    """
    rows = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("doc_id", node_of("text").alias("node"))
    nodes = near_duplicates(docs, how, id, text)
    ids = rows.groupBy("node").agg(F.min("doc_id").alias("least")).join(nodes, "node")
    named = ids.join(
        ids.groupBy("class_node").agg(F.min("least").alias("class_id")).withColumnRenamed("class_node", "c"),
        F.col("class_node") == F.col("c"),
    ).select("node", "class_id")
    return (
        rows.join(named.withColumn("found", F.lit(True)), "node", "left")
        .select("doc_id", F.when(F.col("found"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))
    )


def keep_one(docs: DataFrame, how: OrderMinHash = OrderMinHash(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` with one row left of each class: that with the smallest id.

    Every column is kept. Of rows that repeat both id and text one stays. Ids
    that are null come last. Documents without words all stay.
    """
    node, unit = unused(docs, "node", "unit")
    best = stored(best_rows(docs, near_duplicates(docs, how, id, text), id, text), "kept")
    rows = docs.withColumn(node, node_of(text))
    same = (F.col(node) == F.col(f"{unit}.node")) & F.col(id).eqNullSafe(F.col(f"{unit}.id"))
    alone, repeated = (best.where(x).select(F.struct("node", "id").alias(unit)) for x in ("n = 1", "n > 1"))
    kept = rows.join(alone, same, "left_semi")
    kept = kept.unionByName(rows.join(repeated, same, "left_semi").dropDuplicates([node]))
    wordless = docs.where(F.col(text).isNull() | F.col(text).rlike(r"\A[ \t\n\x0B\f\r]*\z"))
    return kept.drop(node).unionByName(wordless)


def best_rows(docs: DataFrame, nodes: DataFrame, id: str, text: str) -> DataFrame:
    """(node, id, n): for each class its smallest id, a text that has it, and the number of rows with both."""
    rows = docs.select(node_of(text).alias("node"), F.col(id).alias("id"))
    first = rows.groupBy("node", "id").count().groupBy("node").agg(
        F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", F.col("count").alias("n"))).alias("least")
    )
    of_class = nodes.join(first, "node").groupBy("class_node").agg(
        F.min(F.struct("least.unknown", "least.id", "node", "least.n")).alias("b")
    )
    return of_class.select("b.node", "b.id", "b.n")
