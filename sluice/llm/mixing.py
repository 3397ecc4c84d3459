"""Mixing documents to target weights of domains that they belong to in part.

1. A classifier (multinomial Bayes over hashed words) is counted from a labelled
   table and gives every text its posterior over the domains.
2. Rates r >= 0, one per document, are fitted so that the expected tokens of each
   domain, the sum over documents of tokens * posterior * rate, meet the targets:
   least squares of the relative misfits by projected gradient steps from rates of
   1, with Nesterov's momentum. A document's step is divided by its domains' share
   of the curvature, so that small and large domains move alike. Each step is one
   pass over a compact table of (tokens, posterior) that brings one number a domain
   to the driver; steps end when the targets are met, or when the duality gap shows
   that no rates do better by more than a stated misfit.

The steps are a short list of gradients by domain, and a document's rate follows
from that list and its posterior alone. So no rate is ever stored: each pass
computes it again, the last one beside the text.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from sluice.llm import textbytes
from sluice.llm.work import ship, stored, unused, where_computed

BUCKET_BITS = 14
SLOW = 6  # steps over which the value must fall by a fifth, once the gap is small enough
STALL = 25  # steps without a better value or bound by a hundredth that end the fit


@dataclass(frozen=True)
class Classifier:
    """Log-probabilities of hashed words by domain. At most `evidence` words' worth of a text counts, so posteriors stay soft."""

    domains: tuple[str, ...]
    prior: np.ndarray
    weights: np.ndarray  # buckets x domains
    evidence: float = 3.0

    def posteriors(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words of each text, and its posterior; a text without words has the prior."""
        counts, logits = [], []
        for block in textbytes.blocks(column):
            starts, ends, first = block.words()
            buckets = bucket(block.word_hashes(starts, ends))
            n = np.diff(first)
            text = np.repeat(np.arange(block.n), n)
            total = np.stack([np.bincount(text, w[buckets], block.n) for w in self.weights.T], 1)
            counts.append(n)
            logits.append(self.prior + total * (np.minimum(n, self.evidence) / np.maximum(n, 1))[:, None])
        if not counts:
            return np.zeros(0, np.int64), np.zeros((0, len(self.domains)))
        z = np.concatenate(logits)
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return np.concatenate(counts), z / z.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class Steps:
    """The steps so far: a momentum and a gradient by domain each, and the curvature by domain that they are divided by."""

    curvature: np.ndarray
    taken: tuple[tuple[float, np.ndarray], ...] = ()

    def rates(self, posterior: np.ndarray, least: float, most: float) -> np.ndarray:
        rate = before = np.clip(np.ones(len(posterior)), least, most)
        if self.taken:
            gradients = posterior @ np.stack([u for _, u in self.taken], 1)
            gradients /= np.maximum(posterior @ self.curvature, 1e-300)[:, None]
            for k, (momentum, _) in enumerate(self.taken):
                ahead = rate + momentum * (rate - before)
                before, rate = rate, np.clip(ahead - gradients[:, k], least, most)
        return rate


@dataclass(frozen=True)
class Fit:
    """The result of a fit. `expected` are the domains' tokens that the rates give, `targets` what was asked for.

    `gap` bounds how much smaller half the sum of squared relative misfits can be
    with any rates within the bounds, and `optimal` tells whether that is as
    little as was asked for; a misfit that is left then cannot be avoided.
    """

    domains: tuple[str, ...]
    least: float
    most: float
    targets: tuple[float, ...]
    expected: tuple[float, ...]
    optimal: bool
    gap: float
    steps: Steps

    def rates(self, posterior: np.ndarray) -> np.ndarray:
        return self.steps.rates(posterior, self.least, self.most)

    def misfit(self) -> float:
        """The largest difference of expected and target tokens, as a share of the target; of all tokens where that is 0."""
        whole = max(sum(self.targets), 1e-300)
        return max((abs(e - t) / (t or whole) for e, t in zip(self.expected, self.targets, strict=True)), default=0.0)


@dataclass(frozen=True)
class Mixture:
    """Target weights by domain, and bounds of the rates; there is no upper one unless `most` is given.

    The fit ends when all targets are met to a tenth of `tolerance`, when no
    rates can bring the root of the summed squares of the misfits further down
    than `gap` and steps gain little, when they gain nothing, or after `steps` of
    them if given. A misfit above `tolerance` is warned of.

    `tokens` is the total to reach; None takes the present total or, if rates may
    not fall below `least`, the smallest total at which no domain has to.
    """

    weights: dict[str, float] = field(default_factory=dict)
    least: float = 0.0
    most: float = math.inf
    tokens: float | None = None
    steps: int | None = None
    tolerance: float = 1e-4
    gap: float = 2.5e-3


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


# --- classifier ------------------------------------------------------------------------------


def train(labelled: DataFrame, domains: list[str]) -> Classifier:
    """A classifier from rows (text, domain); rows of other domains or without one are left out.

    Counts are summed on the executors; the driver gets one number for each
    domain and bucket of words, 16384 for each domain at most. Without any rows
    every text has equal posteriors.
    """
    ship(labelled.sparkSession)
    names = tuple(sorted(domains))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(names), 1 << BUCKET_BITS), np.int64)
        for batch in batches:
            at = batch.column("at").to_numpy()
            for block in textbytes.blocks(batch.column("text")):
                starts, ends, first = block.words()
                buckets = bucket(block.word_hashes(starts, ends))
                domain = np.repeat(at[block.first : block.first + block.n], np.diff(first))
                np.add.at(counts, (domain, buckets), 1)
        d, b = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(d.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(counts[d, b])], ["domain", "bucket", "n"])

    at = F.array_position(F.lit(list(names)), F.col("domain")) - 1
    rows = labelled.select(F.col("text"), at.cast("int").alias("at")).where("at >= 0")
    found = rows.mapInArrow(run, "domain int, bucket int, n bigint").groupBy("domain", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((1 << BUCKET_BITS, len(names)))
    for r in found.collect():
        counts[r["bucket"], r["domain"]] = r["n"]
    words = counts.sum(axis=0)
    smooth = 0.1
    weights = np.log((counts + smooth) / (words + smooth * len(counts)))
    prior = np.log((words + 1) / (words + 1).sum())
    return Classifier(names, prior, weights)


def memberships(classifier: Classifier) -> Column:
    """A user function of the text: struct of words and the posterior."""
    kind = pa.struct([("tokens", pa.int64()), ("posterior", pa.list_(pa.float64()))])

    def run(text: pa.Array) -> pa.Array:
        n, p = classifier.posteriors(text)
        offsets = pa.array(np.arange(len(n) + 1) * p.shape[1], pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(p.ravel()))
        return pa.StructArray.from_arrays([pa.array(n.astype(np.int64)), lists], fields=list(kind))

    return arrow_udf(run, "struct<tokens:bigint,posterior:array<double>>")


# --- fit -------------------------------------------------------------------------------------


def fit(members: DataFrame, mixture: Mixture, domains: tuple[str, ...]) -> Fit:
    """Rates for rows (tokens, posterior) by accelerated projected gradient steps; sums by domain are combined on the executors.

    The objective is half the sum of the squared relative misfits. A rate's
    curvature is at most the sum over domains of posterior * tokens present /
    scale squared, times the document's tokens, which is the step's divisor.
    Momentum starts anew where the objective rises. The gap is that to the dual
    value of the last gradient, made feasible by one shift common to all domains.
    """
    weights = np.array([mixture.weights.get(d, 0.0) for d in domains])
    weights = weights / weights.sum()
    n, least, most = len(domains), mixture.least, mixture.most

    def totals(steps: Steps, gradient: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
        """Tokens reached; tokens at rate 1; least slope of a document along a gradient; lowest sum of tokens * slope * rate."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reached, present, lowest, bound = np.zeros(n), np.zeros(n), math.inf, 0.0
            for batch in batches:
                if not batch.num_rows:
                    continue
                tokens = batch.column("tokens").to_numpy().astype(float)
                p = batch.column("posterior").flatten().to_numpy().reshape(len(tokens), n)
                reached += (tokens * steps.rates(p, least, most)) @ p
                present += tokens @ p
                slope = p @ gradient
                lowest = min(lowest, float(slope.min()))
                if most < math.inf:
                    bound += float((tokens * np.where(slope > 0, least, most) * slope).sum())
            yield pa.RecordBatch.from_pylist([{"reached": reached.tolist(), "present": present.tolist(), "lowest": lowest, "bound": bound}], schema=kind)

        kind = pa.schema([("reached", pa.list_(pa.float64())), ("present", pa.list_(pa.float64())), ("lowest", pa.float64()), ("bound", pa.float64())])
        sums = [F.sum(F.get(c, i)).alias(f"{c}{i}") for c in ("reached", "present") for i in range(n)]
        row = members.mapInArrow(run, "reached array<double>, present array<double>, lowest double, bound double").agg(*sums, F.min("lowest").alias("lowest"), F.sum("bound").alias("bound")).first()
        reached, present = (np.array([row[f"{c}{i}"] or 0.0 for i in range(n)]) for c in ("reached", "present"))
        return reached, present, row["lowest"] if row["lowest"] is not None else math.inf, row["bound"] or 0.0

    steps = Steps(np.ones(n))
    reached, present, _, _ = totals(steps, np.zeros(n))
    if mixture.tokens is not None:
        budget = mixture.tokens
    elif least > 0:
        budget = max((least * have / w for have, w in zip(present, weights, strict=True) if w > 0), default=0.0)
    else:
        budget = present.sum()
    targets = budget * weights
    scale = np.where(targets > 0, targets, 0.01 * max(budget, 1.0))  # a domain to be left out: its misfit in hundredths of all tokens
    steps = Steps(present / scale**2)

    def value(at: np.ndarray) -> float:
        return float((((at - targets) / scale) ** 2).sum() / 2)

    def dual(gradient: np.ndarray, lowest: float, bound: float) -> float:
        """A lower bound of the objective over all rates within the bounds."""
        if most < math.inf:
            return float(-((scale * gradient) ** 2).sum() / 2 - gradient @ targets + bound)
        shifted = gradient + max(0.0, -lowest)
        return float(-((scale * shifted) ** 2).sum() / 2 - shifted @ targets + least * (shifted @ present))

    before, now, lower, speed, quiet, values = reached, value(reached), 0.0, 1.0, 0, [math.inf] * SLOW
    wanted = (mixture.tolerance / 10) ** 2 / 2

    def done() -> bool:
        return now <= wanted or (now - lower <= mixture.gap**2 / 2 and now > values[-SLOW] * 0.8)

    while present.sum() > 0 and budget > 0 and not done() and quiet < STALL and (mixture.steps is None or len(steps.taken) < mixture.steps):
        faster = (1 + math.sqrt(1 + 4 * speed * speed)) / 2
        momentum = (speed - 1) / faster
        gradient = (reached + momentum * (reached - before) - targets) / scale**2
        steps = Steps(steps.curvature, (*steps.taken, (momentum, gradient)))
        new, _, lowest, bound = totals(steps, gradient)
        values.append(now)
        better, higher = value(new), max(lower, dual(gradient, lowest, bound))
        quiet = 0 if now - better > 0.01 * (now - lower) or higher - lower > 0.01 * (now - lower) else quiet + 1
        speed = 1.0 if better > now else faster
        before, reached, now, lower = reached, new, better, higher
    met = now <= wanted or not (present.sum() > 0 and budget > 0)
    return Fit(domains, least, most, tuple(targets.tolist()), tuple(reached.tolist()), met or done(), max(now - lower, 0.0), steps)


# --- use -------------------------------------------------------------------------------------


def mixed(docs: DataFrame, classifier: Classifier, mixture: Mixture, id: str = "doc_id", text: str = "text", out: str = "mix") -> DataFrame:
    """`docs` with a struct column `out`: tokens, posterior, rate, copies, targets, expected.

    `targets` and `expected` are the fit's tokens by domain, the same in every row.

    `copies` is the rate rounded up or down by a hash of id and text, so that
    its mean is the rate and a rerun gives the same. Texts that are null or
    empty have no tokens and the rate of the prior. Rows that repeat are treated
    alike. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    member = memberships(classifier)
    compact = docs.select(member(F.col(text)).alias("m")).select("m.tokens", "m.posterior")
    fitted = fit(stored(compact, "members"), mixture, classifier.domains)
    if fitted.misfit() > mixture.tolerance:
        warnings.warn(f"targets {fitted.targets} of {fitted.domains} are missed: {fitted.expected}, half the squared misfits can fall by at most {fitted.gap:.1e}", stacklevel=2)

    def run(posterior: pa.Array) -> pa.Array:
        p = posterior.flatten().to_numpy().reshape(len(posterior), len(fitted.domains))
        return pa.array(fitted.rates(p))

    m, rate = unused(docs, "member", "rate")
    whole = [F.array(*[F.lit(float(x)) for x in xs]).alias(c) for c, xs in (("targets", fitted.targets), ("expected", fitted.expected))]
    draw = F.pmod(F.xxhash64(F.lit("mix"), F.col(id), F.col(text)), F.lit(1 << 53)) / float(1 << 53)
    copies = F.floor(rate) + (draw < F.col(rate) - F.floor(rate)).cast("long")
    return (
        docs.withColumn(m, member(F.col(text)))
        .withColumn(rate, F.round(arrow_udf(run, "double")(F.col(f"{m}.posterior")), 9))
        .withColumn(out, F.struct(f"{m}.tokens", f"{m}.posterior", F.col(rate).alias("rate"), copies.alias("copies"), *whole))
        .drop(m, rate)
    )


def repeated(docs: DataFrame, classifier: Classifier, mixture: Mixture, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, each as often as its copies say; no other column is added."""
    mix, copy = unused(docs, "mix", "copy")
    rows = where_computed(mixed(docs, classifier, mixture, id, text, mix), F.col(f"{mix}.copies") > 0)
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(f"{mix}.copies").cast("int")))).drop(mix, copy)
