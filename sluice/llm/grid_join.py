"""Near-duplicate embeddings by an epsilon grid order join.

Unit vectors are projected on leading principal directions and put in the
order of their grid cells, cut into intervals of the sequence, and intervals
are joined with each other. Cosine c means distance sqrt(2 - 2c), so intervals
whose boxes are further apart than that are skipped. Within a pair of intervals
the join goes on recursively, halving them and skipping distant halves; small
parts are compared through the projection first: with q the projection and r
the length of what it leaves out, cosine <= qa.qb + ra*rb. What passes is
computed from the whole vectors in double precision.

Equal vectors are one node, and a pair of intervals gives a spanning forest of
its links and a sum of links per node, never the links themselves: a large group
of near copies costs time, not rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.graph import components
from sluice.llm.work import joined_back, ship, stored
from sluice.operators.ordering import in_order


@dataclass(frozen=True)
class GridJoin:
    """Principal directions are a guide only, so `sample` rows are enough to find them; results do not depend on them."""

    cosine: float = 0.9
    directions: int = 24
    interval: int = 2048
    leaf: int = 512
    sample: int = 20_000
    runs: int = 8
    run_bytes: int = 32 << 20

    @property
    def epsilon(self) -> float:
        return float(np.sqrt(max(0.0, 2 - 2 * self.cosine)))


SLACK = 1e-4  # for single precision in projections and boxes; the final test is exact


# --- vectors ---------------------------------------------------------------------------------


def matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows of a matrix, shorter ones padded with zeros, and which of them can link.

    Null, zero and empty vectors and those with a null or non-finite component cannot.
    """
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    good = np.ones(len(column), bool)
    flat = column.flatten()
    missing = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    width = int(lengths.max()) if len(lengths) else 0
    out = np.zeros((len(column), width))
    begin = np.concatenate(([0], np.cumsum(lengths)))
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(values)) - begin[row]] = values
    bad = missing | ~np.isfinite(values)
    good[row[bad]] = False
    with np.errstate(all="ignore"):
        top = np.abs(out).max(axis=1, initial=0)
    good &= np.isfinite(top) & (top > 0)
    return out, good


def nodes(vectors: DataFrame, id: str, embedding: str) -> DataFrame:
    """(id, node, vector): the vector in double precision as bytes, and the node that equal vectors share; null where none can link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, good = matrix(batch.column("vector"))
            data = [np.trim_zeros(v + 0.0, "b").tobytes() if ok else None for v, ok in zip(x, good, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(data, pa.binary())], ["id", "vector"])

    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("vector"))
    return rows.mapInArrow(run, "id bigint, vector binary").withColumn("node", F.unhex(F.md5("vector")))


def unit_rows(data: list[bytes], width: int) -> np.ndarray:
    """Unit vectors of length `width`; scaled by the largest component first, so that squares neither overflow nor vanish."""
    out = np.zeros((len(data), width))
    for i, x in enumerate(data):
        v = np.frombuffer(x, float)
        out[i, : len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True, initial=1e-300)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def principal(vectors: DataFrame, how: GridJoin) -> np.ndarray:
    """Leading directions, as columns, of the `sample` vectors with the smallest hashes."""
    rows = vectors.orderBy(F.xxhash64("node"), "node").limit(how.sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((0, 0))
        for batch in batches:
            data = batch.column("vector").to_pylist()
            width = max((len(v) // 8 for v in data), default=0)
            x = unit_rows(data, max(width, len(total)))
            grown = np.zeros((x.shape[1], x.shape[1]))
            grown[: len(total), : len(total)] = total
            total = grown + x.T @ x
        i, j = np.divmod(np.arange(total.size), max(len(total), 1))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "x"])

    found = rows.select("vector").mapInArrow(run, "i bigint, j bigint, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    width = max((r["i"] for r in found), default=-1) + 1
    gram = np.zeros((width, width))
    for r in found:
        gram[r["i"], r["j"]] = r["x"]
    values, directions = np.linalg.eigh(gram)
    return directions[:, np.argsort(-values)[: how.directions]]


def projected(x: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Coordinates on the leading directions, and last the length of the rest."""
    n = min(x.shape[1], len(directions))
    q = x[:, :n] @ directions[:n]
    rest = np.sqrt(np.maximum(1 - (q * q).sum(axis=1), 0))
    return np.concatenate([q, rest[:, None]], 1)


# --- intervals of the sequence ---------------------------------------------------------------


def intervals(vectors: DataFrame, directions: np.ndarray, how: GridJoin) -> DataFrame:
    """(block, low, high, nodes, sizes, data): the sequence of vectors in grid order, cut into intervals with their boxes.

    Cells are compared from the first direction on, ties by node, so a full cell
    is dealt to several tasks.
    """

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("vector").to_pylist()
            x = unit_rows(data, max(len(v) // 8 for v in data)) if data else np.zeros((0, 0))
            cell = np.floor(projected(x, directions)[:, :-1] / how.epsilon).astype(np.int32) if data else np.zeros((0, 1), np.int32)
            offsets = pa.array(np.arange(len(data) + 1) * cell.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("vector"), batch.column("size"), pa.ListArray.from_arrays(offsets, pa.array(cell.ravel()))],
                ["node", "vector", "size", "cell"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, seq = [], TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            held += zip(batch.column("node").to_pylist(), batch.column("vector").to_pylist(), batch.column("size").to_pylist(), strict=True)
            while len(held) >= how.interval:
                yield block(held[: how.interval], at + seq)
                held, seq = held[how.interval :], seq + 1
        if held:
            yield block(held, at + seq)

    def block(rows: list, number: int) -> pa.RecordBatch:
        data = [v for _, v, _ in rows]
        width = max(len(v) // 8 for v in data)
        q = projected(unit_rows(data, width), directions)[:, :-1]
        packed = np.zeros((len(data), width))
        for i, v in enumerate(data):
            packed[i, : len(v) // 8] = np.frombuffer(v, float)
        small = packed.astype(np.float32)
        same = bool((small == packed).all())  # single precision holds them: half the bytes to move
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number]),
                pa.array([q.min(axis=0).tolist()], pa.list_(pa.float64())),
                pa.array([q.max(axis=0).tolist()], pa.list_(pa.float64())),
                pa.array([len(data)], pa.int32()),
                pa.array([b"".join(n for n, _, _ in rows)], pa.binary()),
                pa.array([np.array([s for _, _, s in rows], np.int64).tobytes()], pa.binary()),
                pa.array([same]),
                pa.array([(small if same else packed).tobytes()], pa.binary()),
            ],
            ["block", "low", "high", "n", "nodes", "sizes", "single", "data"],
        )

    schema = "block bigint, low array<double>, high array<double>, n int, nodes binary, sizes binary, single boolean, data binary"
    placed = vectors.mapInArrow(cells, "node binary, vector binary, size bigint, cell array<int>")
    return placed.repartitionByRange("cell", "node").sortWithinPartitions("cell", "node").mapInArrow(cut, schema)


def grouped(blocks: DataFrame, how: GridJoin, width: int) -> DataFrame:
    """The intervals with `run`: the number of the run of neighbouring intervals that each is in.

    A task joins two runs and is sent each of their intervals once. Runs are an
    eighth of the sequence, so what is sent in all is a fixed number of times
    the vectors, as long as a run stays below `how.run_bytes`.
    """
    order = in_order(blocks.select("block"), ["block"], (), "at", "intervals")
    most = max(1, how.run_bytes // max(8 * width * how.interval, 1))
    size = F.least(F.ceil(F.col("intervals") / how.runs), F.lit(most))
    return blocks.join(order.select("block", F.floor(F.col("at") / size).alias("run")), "block")


def near_pairs(blocks: DataFrame, how: GridJoin, directions: int) -> DataFrame:
    """(a, b): pairs of runs, a <= b, whose boxes are within epsilon.

    Runs meet through the strips of the first direction that they touch,
    each strip as wide as epsilon; their boxes settle the rest.
    """
    side = lambda f, name: F.array(*[f(F.get(name, i)) for i in range(directions)]).alias(name)
    boxes = blocks.groupBy("run").agg(side(F.min, "low"), side(F.max, "high"))
    strip = lambda c: F.floor(F.get(c, 0) / how.epsilon)
    boxes = boxes.select("run", "low", "high", F.sequence(strip(F.col("low")), strip(F.col("high"))).alias("own"))
    one = boxes.select(F.col("run").alias("a"), F.col("low").alias("a_low"), F.col("high").alias("a_high"), F.explode("own").alias("strip"))
    two = boxes.select(
        F.col("run").alias("b"), F.col("low").alias("b_low"), F.col("high").alias("b_high"),
        F.explode(F.array_distinct(F.flatten(F.transform("own", lambda x: F.array(x - 1, x, x + 1))))).alias("strip"),
    )
    gap = F.zip_with(
        F.zip_with("a_low", "b_high", lambda x, y: F.greatest(x - y, F.lit(0.0))),
        F.zip_with("b_low", "a_high", lambda x, y: F.greatest(x - y, F.lit(0.0))),
        lambda x, y: F.greatest(x, y),
    )
    distance = F.aggregate(gap, F.lit(0.0), lambda total, x: total + x * x)
    return one.join(two, "strip").where("a <= b").where(distance <= (how.epsilon + SLACK) ** 2).select("a", "b").distinct()


# --- joining two intervals -------------------------------------------------------------------


@dataclass
class Interval:
    x: np.ndarray  # unit vectors, in double precision
    q: np.ndarray  # projections, in single precision


def sides(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return q[:, :-1].min(axis=0), q[:, :-1].max(axis=0)


def join(a: Interval, b: Interval, same: bool, how: GridJoin) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in a and b of linked vectors, in parts; within one interval each pair once."""
    reach = (how.epsilon + SLACK) ** 2

    def parts(i: int, j: int, k: int, m: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if same and m <= i:
            return
        (a_low, a_high), (b_low, b_high) = sides(a.q[i:j]), sides(b.q[k:m])
        gap = np.maximum(np.maximum(a_low - b_high, b_low - a_high), 0)
        if (gap * gap).sum() > reach:
            return
        if j - i <= how.leaf and m - k <= how.leaf:
            yield from leaf(i, j, k, m)
        elif j - i >= m - k:
            half = (i + j) // 2
            yield from parts(i, half, k, m)
            yield from parts(half, j, k, m)
        else:
            half = (k + m) // 2
            yield from parts(i, j, k, half)
            yield from parts(i, j, half, m)

    def leaf(i: int, j: int, k: int, m: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        at, to = np.nonzero(a.q[i:j] @ b.q[k:m].T >= np.float32(how.cosine - SLACK))
        at, to = at + i, to + k
        if same:
            later = to > at
            at, to = at[later], to[later]
        for s in range(0, len(at), 1 << 15):
            x, y = at[s : s + (1 << 15)], to[s : s + (1 << 15)]
            linked = np.einsum("ij,ij->i", a.x[x], b.x[y]) >= how.cosine
            if linked.any():
                yield x[linked], y[linked]

    if len(a.x) and len(b.x):
        yield from parts(0, len(a.x), 0, len(b.x))


def forest(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The smallest place each of n places is connected with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compared(pairs: DataFrame, blocks: DataFrame, directions: np.ndarray, how: GridJoin) -> DataFrame:
    """(node, other, links): rows of a spanning forest of links (other not null), and links counted per node.

    A task has two runs, or one with itself, and joins their intervals pair by
    pair; pairs of distant intervals are skipped by their boxes.
    """

    def opened(rows: pa.Table, i: int) -> tuple[Interval, np.ndarray, np.ndarray]:
        get = lambda name: rows.column(name)[i].as_py()
        n = get("n")
        data = np.frombuffer(get("data"), np.float32 if get("single") else np.float64).astype(float).reshape(n, -1)
        x = unit_rows([v.tobytes() for v in data], data.shape[1]) if n else data
        names = np.frombuffer(get("nodes"), "V16")
        return Interval(x, projected(x, directions).astype(np.float32)), names, np.frombuffer(get("sizes"), np.int64)

    def widened(x: np.ndarray, width: int) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        order, of_run = rows.column("block").to_pylist(), rows.column("run").to_pylist()
        a_run, b_run = rows.column("a")[0].as_py(), rows.column("b")[0].as_py()
        held = [opened(rows, i) for i in range(rows.num_rows)]
        width = max(x.x.shape[1] for x, _, _ in held)
        for x, _, _ in held:
            x.x = widened(x.x, width)
        names = np.concatenate([n for _, n, _ in held])
        begins = np.concatenate(([0], np.cumsum([len(n) for _, n, _ in held])))
        label, links = np.arange(len(names)), np.zeros(len(names), np.int64)
        for i in range(len(order)):
            for j in range(i, len(order)):
                if {of_run[i], of_run[j]} != {a_run, b_run}:
                    continue  # within one of two runs: another task joins that
                (a, _, a_sizes), (b, _, b_sizes) = held[i], held[j]
                for x, y in join(a, b, i == j, how):
                    np.add.at(links, x + begins[i], b_sizes[y])
                    np.add.at(links, y + begins[j], a_sizes[x])
                    # of the links of this part, only those that join something yet unjoined change the labels
                    u, v = label[x + begins[i]], label[y + begins[j]]
                    new = u != v
                    if new.any():
                        label = forest(u[new], v[new], len(names))[label]
        own = np.flatnonzero(label != np.arange(len(names)))
        counted = np.flatnonzero(links)
        raw = lambda at: [names[k].tobytes() for k in at]
        return pa.table(
            {
                "node": pa.array(raw(own) + raw(counted), pa.binary()),
                "other": pa.array(raw(label[own]) + [None] * len(counted), pa.binary()),
                "links": pa.array(np.concatenate([np.zeros(len(own), np.int64), links[counted]]), pa.int64()),
            }
        )

    wide = blocks.select("block", "run", "n", "nodes", "sizes", "single", "data")
    both = pairs.join(wide, pairs["a"] == wide["run"]).unionByName(pairs.where("a <> b").join(wide, pairs["b"] == wide["run"]))
    return both.groupBy("a", "b").applyInArrow(run, "node binary, other binary, links bigint")


def near_duplicates(vectors: DataFrame, how: GridJoin = GridJoin(), id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of `vectors`.

    n_links counts the other rows of cosine at least `how.cosine`; component_id
    is the smallest id reachable by links, itself included; kept marks rows that
    carry it. Rows with equal vectors link with each other. Vectors that are null,
    zero, empty or hold null or non-finite components link with nothing; shorter
    vectors count as padded with zeros. An id that is null names no component.
    """
    ship(vectors.sparkSession)
    members = stored(nodes(vectors, id, embedding), "vectors")
    sizes = members.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("least"))
    sizes = stored(sizes, "nodes")
    distinct = members.where("node is not null").select("node", "vector").dropDuplicates(["node"]).join(sizes.select("node", "size"), "node")
    distinct = stored(distinct, "distinct")
    directions = principal(distinct, how)
    blocks = grouped(stored(intervals(distinct, directions, how), "intervals"), how, len(directions))
    pairs = stored(near_pairs(blocks, how, max(1, directions.shape[1])), "pairs")
    found = stored(compared(pairs, blocks, directions, how), "found")
    counted = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.where("other is not null"), "node", "other")
    named = sizes.join(classes, "node", "left").join(counted, "node", "left")
    named = named.withColumn("class", F.coalesce("component", "node")).withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("size") - 1)
    named = stored(named.select("node", "class", "n_links", "least"), "named")
    smallest = stored(named.groupBy("class").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members")), "classes")
    named = joined_back(named, smallest, "class", "members", named.count()).select("node", "n_links", "component_id")
    linked = members.select("id", "node").join(named, "node", "left")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return linked.select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
