"""Exact quantiles of many columns without a sort and without collecting a column.

A quantile is one or two ranks of the sorted column. Each round cuts the value
range around every wanted rank at values ``percentile_approx`` proposes, counts
the rows below and up to each cut exactly, and keeps the one open interval the
rank falls in. A round shrinks an interval about a thousandfold, so a few scans
are enough at any size; every aggregate is combined before its (tiny) shuffle.
A value that holds a large part of the rows becomes a cut and settles at once.
The approximation only steers the search: a poor cut costs a round, never the
result. When few rows are left in all open intervals, their values are counted.
"""

from __future__ import annotations

import math
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice import session

PROBABILITIES = (0.25, 0.5, 0.75)
ACCURACY = 10_000
FEW_ROWS = 20_000

Number = int | float


@dataclass(frozen=True)
class Summary:
    n: int
    mean: float | None
    std: float | None
    min: Number | None
    max: Number | None
    quantiles: tuple[float | None, ...]


@dataclass(frozen=True)
class Gap:
    """An open interval of one column that still hides wanted ranks."""

    column: int
    low: Number | None  # None: no bound
    high: Number | None
    below: int  # rows up to and including low
    rows: int  # rows strictly inside
    ranks: tuple[int, ...]

    def holds(self, value: Column) -> Column:
        inside = value.isNotNull()
        if self.low is not None:
            inside = inside & (value > F.lit(self.low))
        if self.high is not None:
            inside = inside & (value < F.lit(self.high))
        return inside

    def targets(self, accuracy: int) -> list[float]:
        """Relative ranks just outside every wanted rank."""
        found = set()
        for rank in self.ranks:
            at = (rank - self.below + 0.5) / self.rows
            found.update(min(1.0, max(0.0, at + side * 2 / accuracy)) for side in (-1, 1))
        return sorted(found)

    def narrow(self, cuts: Sequence[tuple[Number, int, int]], found: dict) -> list[Gap]:
        """Settle the ranks that sit on a cut; give back the gaps that hide the others.

        A cut is a value inside the gap, the rows below it and the rows up to it.
        """
        left: list[Gap] = []
        low, below = self.low, self.below
        for value, less, up_to in [*cuts, (self.high, self.below + self.rows, self.below + self.rows)]:
            hidden = tuple(r for r in self.ranks if below <= r < less)
            if hidden:
                left.append(replace(self, low=low, high=value, below=below, rows=less - below, ranks=hidden))
            found.update({(self.column, r): value for r in self.ranks if less <= r < up_to})
            low, below = value, up_to
        return left


def _propose(df: DataFrame, values: Sequence[Column], gaps: Sequence[Gap], accuracy: int) -> list[list[Number]]:
    cuts = [
        F.percentile_approx(F.when(g.holds(values[g.column]), values[g.column]), g.targets(accuracy), accuracy)
        for g in gaps
    ]
    row = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(cuts)]).first()
    return [sorted(set(c)) for c in row]


CHANGED = "the source changed between two scans: the quantiles of its columns cannot be told"


def _positions(df: DataFrame, values: Sequence[Column], gaps: Sequence[Gap], cuts: Sequence[Sequence[Number]], sizes: Mapping[int, int]) -> list:
    """For every gap its cuts, each with the rows of the column below it and up to it; fails if a column has other rows than before."""
    counts = [
        count.alias(f"n{g}_{i}_{k}")
        for g, gap in enumerate(gaps)
        for i, cut in enumerate(cuts[g])
        for k, count in enumerate(
            (F.count_if(values[gap.column] < F.lit(cut)), F.count_if(values[gap.column] <= F.lit(cut)))
        )
    ]
    columns = sorted({gap.column for gap in gaps})
    row = df.agg(*counts, *[F.count(values[c]).alias(f"all{c}") for c in columns]).first()
    if any(row[f"all{c}"] != sizes[c] for c in columns):
        raise RuntimeError(CHANGED)
    return [
        [(cut, row[f"n{g}_{i}_0"], row[f"n{g}_{i}_1"]) for i, cut in enumerate(cuts[g])] for g in range(len(gaps))
    ]


def _settle(df: DataFrame, values: Sequence[Column], gaps: Sequence[Gap], found: dict) -> None:
    """Read the values of the few rows left, counted per value; one scan for columns of both types."""
    doubles = [f.dataType.simpleString() == "double" for f in df.schema]
    inside = [gap.holds(values[gap.column]) for gap in gaps]

    def pick(i: int, gap: Gap) -> Column:
        value = F.when(inside[i], values[gap.column])
        none = [F.lit(None).cast("bigint"), F.lit(None).cast("double")]
        whole, real = (none[0], value) if doubles[gap.column] else (value, none[1])
        return F.struct(F.lit(i).alias("gap"), whole.alias("whole"), real.alias("real"))

    rows = (
        df.where(reduce(lambda a, b: a | b, inside))
        .select(F.explode(F.array(*[pick(i, gap) for i, gap in enumerate(gaps)])).alias("p"))
        .where("p.whole IS NOT NULL OR p.real IS NOT NULL")
        .groupBy("p.gap", "p.whole", "p.real")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    at = [gap.below for gap in gaps]
    for i, value, n in sorted((r["gap"], r["real"] if r["whole"] is None else r["whole"], r["n"]) for r in rows):
        for rank in gaps[i].ranks:
            if at[i] <= rank < at[i] + n:
                found[gaps[i].column, rank] = value
        at[i] += n
    if any(at[i] != gap.below + gap.rows for i, gap in enumerate(gaps)):
        raise RuntimeError(CHANGED)


def summarize(
    df: DataFrame,
    values: Mapping[str, Column],
    probabilities: Sequence[float],
    *,
    approx: bool = False,
    exact_mean: Collection[str] = (),
    accuracy: int = ACCURACY,
    few_rows: int = FEW_ROWS,
) -> dict[str, Summary]:
    """Count, mean, sample deviation, extremes and quantiles of bigint or double expressions.

    Runs jobs at once: one for the aggregates and the first cuts, then one or
    two per round, each for all columns whatever their types. At most
    ``few_rows`` distinct values reach the driver. ``exact_mean`` names bigint
    columns that are added up as decimals instead of doubles. A source that
    gives other rows to a later scan fails.
    """
    if not values:
        return {}
    session.prefer_compiled_methods(df.sparkSession)
    columns = list(values.values())
    df = df.select(*[v.alias(f"v{i}") for i, v in enumerate(columns)])
    columns = [F.col(f"v{i}") for i in range(len(columns))]

    first_cuts = sorted(set(probabilities) if approx else {
        min(1.0, max(0.0, p + side * 2 / accuracy)) for p in probabilities for side in (-1, 1)
    })
    aggregates = []
    for i, v in enumerate(columns):
        aggregates += [
            F.count(v).alias(f"n{i}"),
            F.avg(v.cast("decimal(20,0)") if list(values)[i] in exact_mean else v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"std{i}"),
            F.min(v).alias(f"min{i}"),
            F.max(v).alias(f"max{i}"),
            F.percentile_approx(v, first_cuts, accuracy).alias(f"cuts{i}"),
        ]
    stats = df.agg(*aggregates).first()

    wanted: dict[int, list[float]] = {}  # fractional ranks per column
    found: dict[tuple[int, int], Number] = {}
    gaps, cuts = [], []
    for i in range(len(columns)):
        n = stats[f"n{i}"]
        wanted[i] = [p * (n - 1) for p in probabilities] if n else []
        ranks = sorted({int(f(h)) for h in wanted[i] for f in (math.floor, math.ceil)})
        if n and not approx:
            gaps.append(Gap(i, None, None, 0, n, tuple(ranks)))
            cuts.append(sorted(set(stats[f"cuts{i}"])))

    while gaps:
        if sum(g.rows for g in gaps) <= few_rows:
            _settle(df, columns, gaps, found)
            break
        if cuts is None:
            cuts = _propose(df, columns, gaps, accuracy)
        positions = _positions(df, columns, gaps, cuts, {i: stats[f"n{i}"] for i in range(len(columns))})
        gaps = [left for gap, at in zip(gaps, positions) for left in gap.narrow(at, found)]
        cuts = None

    result = {}
    for i, name in enumerate(values):
        if not stats[f"n{i}"]:
            quantiles: tuple[float | None, ...] = (None,) * len(probabilities)
        elif approx:
            at = dict(zip(first_cuts, stats[f"cuts{i}"]))
            quantiles = tuple(at[p] for p in probabilities)
        else:
            quantiles = tuple(_between(found, i, h) for h in wanted[i])
        result[name] = Summary(*(stats[f"{s}{i}"] for s in ("n", "mean", "std", "min", "max")), quantiles)
    return result


def _between(found: Mapping[tuple[int, int], Number], column: int, rank: float) -> Number:
    low, high = found[column, math.floor(rank)], found[column, math.ceil(rank)]
    if low == high:
        return low
    return low + (high - low) * (rank - math.floor(rank))
