"""Whitened vectors: decorrelated along principal components, each distinct vector worked out once.

Vectors are whole numbers. Equal ones are grouped, and a group's size (or one) is
its weight in the fit. Sums, then the weighted products of centred vectors, are
taken in each task by a matrix product and added up; a matrix of dimensions by
dimensions is all that reaches the driver, which finds the eigenvectors. Each
distinct vector is whitened once and joined back to its rows: vectors that hold
1/1024 of all rows or more, at most 1024 of them, by broadcast, so that a common
vector stays where its rows are; the others by shuffle.

Rows whose vector is null or holds null or non-finite entries are dropped, and so
are those whose vector is of another length than most (of equally many, the
longer). Rows that repeat each give their result. Directions without variance
(an eigenvalue of at most 1e-12 of the total) cannot be whitened and are left
out; an empty table, or one whose vectors are all equal, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.work import joined_back, ship, stored

FLAT = 1e-12


def finite(entry: Column) -> Column:
    number = entry.cast("double")
    return entry.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))


def usable(vector: Column) -> Column:
    """Whether a vector has no null and no non-finite entry."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, finite), F.lit(False))


def whole(vector: Column, scale: int = 64, shift: int = 1_000_000) -> Column:
    """Entries as whole numbers: floor(scale * entry) + shift; null for those that are null or not finite."""
    number = lambda c: F.floor(c.cast("double") * float(scale)).cast("bigint") + F.lit(shift).cast("bigint")
    return F.transform(vector, lambda c: F.when(finite(c), number(c)))


# --- sums over distinct vectors --------------------------------------------------------------


def entries(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """The vectors of a column as rows of a matrix."""
    values = batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1)


def sums(distinct: DataFrame, column: str) -> list[int]:
    """Exact sums of whole numbers, by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, weight = entries(batch, column), batch.column(batch.schema.get_field_index("weight")).to_numpy()
            if float(np.abs(x.astype(float)).max()) * float(weight.sum()) >= 2**62:
                x, weight = x.astype(object), weight.astype(object)
            total = weight @ x
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([str(t) for t in total])], names=["dimension", "total"])

    parts = distinct.select("weight", column).mapInArrow(run, "dimension int, total string")
    found = parts.groupBy("dimension").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    return [int(row["total"]) for row in sorted(found, key=lambda r: r["dimension"])]


@dataclass(frozen=True)
class Centre:
    """The mean as a whole number and a rest, so that little is lost when it is taken from whole numbers."""

    n: int
    sums: tuple[int, ...]

    @property
    def base(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([(s % self.n) / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base) - self.rest

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - sum) squared, exactly; fails where it is no 64-bit number."""
        rest = np.array([s % self.n for s in self.sums], np.int64)
        away = (x - self.base).astype(np.int64)
        largest = self.n * (float(np.abs(away).max(initial=0)) + 1)
        if largest**2 * x.shape[1] < 2**62:
            return ((self.n * away - rest) ** 2).sum(axis=1).tolist()
        exact = ((self.n * away.astype(object) - rest.astype(object)) ** 2).sum(axis=1).tolist()
        if max(exact) >= 2**63:
            raise OverflowError("a deviation is beyond 64 bits")
        return exact


def covariance(distinct: DataFrame, column: str, n: int, centre) -> np.ndarray:
    """Weighted covariance, divisor n: one matrix product of centred vectors a batch, added up by row of the matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            if batch.num_rows:
                centred = centre(entries(batch, column))
                total = total + (centred * batch.column(batch.schema.get_field_index("weight")).to_numpy()[:, None]).T @ centred
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["line", "products"])

    def add(parts: pa.Table) -> pa.Table:
        lines = parts.combine_chunks()
        total = lines.column("products").combine_chunks().flatten().to_numpy().reshape(lines.num_rows, -1).sum(axis=0)
        return pa.table({"line": lines.column("line").slice(0, 1), "products": pa.array([total], pa.list_(pa.float64()))})

    schema = "line int, products array<double>"
    found = distinct.select("weight", column).mapInArrow(run, schema).groupBy("line").applyInArrow(add, schema).collect()
    return np.array([row["products"] for row in sorted(found, key=lambda r: r["line"])]) / n


# --- the fit ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fit:
    centre: Centre
    eigenvalues: np.ndarray  # of the components kept, falling
    components: np.ndarray  # unit vectors, one in a column
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.components / np.sqrt(self.eigenvalues)


def fitted(distinct: DataFrame, n: int, components: int, column: str = "x") -> Fit:
    centre = Centre(n, tuple(sums(distinct, column)))
    matrix = covariance(distinct, column, n, centre.centred)
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    trace = float(np.trace(matrix))
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > FLAT * trace] if trace > 0 else order[:0]
    return Fit(centre, values[order], vectors[:, order], trace)


def whitened(rows: DataFrame, id: str, x: str, components: int = 32, weights: str = "counts") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of each row and component, numbered from 1.

    `x` holds vectors of whole numbers. With `weights` "counts" the fit is over
    all rows, with "one" over the distinct vectors; n is the number fitted.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights must be counts or one")
    spark = rows.sparkSession
    ship(spark)
    rows = rows.select(F.col(id).alias("id"), F.col(x).alias("x")).where(usable(F.col("x")))
    kind = rows.schema["id"].dataType.simpleString()
    result = f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    empty = spark.createDataFrame([], result).withColumnRenamed("id", id)
    lengths = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.col("count").desc(), F.col("length").desc()).first()
    if lengths is None or not lengths["length"]:
        return empty
    rows = rows.where(F.size("x") == lengths["length"])
    weight = F.col("copies") if weights == "counts" else F.lit(1).cast("bigint")
    distinct = stored(rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")).withColumn("weight", weight), "distinct")
    many, n = distinct.agg(F.sum("copies").alias("many"), F.sum("weight").alias("n")).first()
    fit = fitted(distinct, n, components)
    if not len(fit.eigenvalues):
        return empty

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = entries(batch, "x")
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(fit.centre.deviation(at), pa.int64()), pa.array(list(fit.whitened(at)), pa.list_(pa.float64()))],
                    names=["x", "copies", "weight", "deviation", "whitened"],
                )

    schema = "x array<bigint>, copies bigint, weight bigint, deviation bigint, whitened array<double>"
    each = stored(distinct.mapInArrow(run, schema), "whitened")
    mean = average(each, "whitened", n, len(fit.eigenvalues))
    error = float(np.abs(covariance(each, "whitened", n, lambda y: y - mean) - np.eye(len(fit.eigenvalues))).max())

    back = joined_back(rows, each.select("x", "copies", "deviation", "whitened"), "x", "copies", many)
    shares = F.lit([float(e / fit.trace) for e in fit.eigenvalues])
    return (
        back.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .select(
            F.col("id").alias(id),
            (F.col("at") + 1).cast("int").alias("component"),
            F.lit(n).cast("bigint").alias("n"),
            "deviation",
            "whitened",
            F.get(shares, F.col("at")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )


def average(distinct: DataFrame, column: str, n: int, size: int) -> np.ndarray:
    """Weighted mean of doubles, by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                total = batch.column(batch.schema.get_field_index("weight")).to_numpy() @ entries(batch, column)
                yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["dimension", "total"])

    parts = distinct.select("weight", column).mapInArrow(run, "dimension int, total double")
    found = {r["dimension"]: r["total"] for r in parts.groupBy("dimension").agg(F.sum("total").alias("total")).collect()}
    return np.array([found[i] for i in range(size)]) / n
