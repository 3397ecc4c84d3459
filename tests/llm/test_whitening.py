import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import queries, whitening, work

DATA = "/root/testdata/sf0.01"
NAN, INF = float("nan"), float("inf")


def brute(vectors, keys, components=32):
    """Each row whitened on its own, from the covariance of all rows."""
    x = np.array(vectors, dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    centred = ((n * x - sums) / n).astype(float)
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    return deviation, centred @ axes[:, order] / np.sqrt(values[order]), values[order] / np.trace(cov)


def check(rows, ids, vectors, components=32):
    deviation, white, explained = brute(vectors, ids, components)
    by_row = {}
    for r in rows:
        by_row.setdefault(r.vec_id, {})[r.component] = r
    assert len(by_row) == len(set(ids)) and len(rows) == len(ids) * white.shape[1]
    assert max(r.identity_error for r in rows) < 1e-9 and len({r.identity_error for r in rows}) == 1
    signs = None
    for i, id in enumerate(ids):
        found = by_row[id]
        assert sorted(found) == list(range(1, white.shape[1] + 1))
        assert {r.deviation for r in found.values()} == {deviation[i]} and {r.n for r in found.values()} == {len(ids)}
        ours = np.array([found[c].whitened for c in sorted(found)])
        if signs is None or not signs.all():
            fresh = np.sign(ours * white[i]) * (np.abs(white[i]) > 1e-3)
            signs = fresh if signs is None else np.where(signs == 0, fresh, signs)
        assert np.allclose(ours * np.where(signs == 0, 1, signs), white[i], atol=1e-6)
        assert np.allclose([found[c].explained for c in sorted(found)], explained, rtol=1e-9)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, x array<bigint>, n int, copies string")


def test_equals_brute_force_with_a_hot_vector(spark):
    rng = random.Random(3)
    vectors = [[rng.randrange(-50, 50) * (d + 1) + 10**6 for d in range(6)] for _ in range(300)]
    vectors += [vectors[5]] * 200 + [vectors[6]] * 3
    rows = whitening.whitened(frame(spark, [(i, v, 1, "c") for i, v in enumerate(vectors)]).repartition(4), "vec_id", "x").collect()
    check(rows, list(range(len(vectors))), vectors)
    first = whitening.whitened(frame(spark, [(i, v, 1, "c") for i, v in enumerate(vectors)]), "vec_id", "x", components=2).collect()
    check(first, list(range(len(vectors))), vectors, 2)


def test_cold_vectors_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(work, "HOT", 4)
    vectors = [[i % 40, (i * i) % 17, (7 * i) % 11] for i in range(400)] + [[1, 2, 3]] * 200
    rows = whitening.whitened(frame(spark, [(i, v, 1, "c") for i, v in enumerate(vectors)]), "vec_id", "x").collect()
    check(rows, list(range(600)), vectors)


def test_query_on_whole_numbers_of_entries(spark):
    table = [r for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    good = [r for r in table if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)]
    vectors = [[math.floor(64 * c) + 1_000_000 for c in r.embedding] for r in good]
    check(queries.op13_whitening(spark, DATA).collect(), [r.vec_id for r in good], vectors)


def test_weight_of_one(spark):
    vectors = [[0, 1], [4, 2], [1, 7], [5, 5]]
    rows = [(i, vectors[i % 4], 1, "c") for i in range(4)] + [(9, vectors[0], 1, "c")] * 1
    found = whitening.whitened(frame(spark, rows), "vec_id", "x", weights="one").collect()
    once = {(r.component): r.whitened for r in found if r.vec_id == 0}
    again = {(r.component): r.whitened for r in found if r.vec_id == 9}
    assert once == again and {r.n for r in found} == {4}
    check([r for r in found if r.vec_id != 9], list(range(4)), vectors)
    with pytest.raises(ValueError, match="weights"):
        whitening.whitened(frame(spark, rows), "vec_id", "x", weights="two")


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, [0.5, 1.0]), (2, None), (3, [None, 1.0]), (4, [NAN, 1.0]), (5, [INF, 1.0]), (6, [0.25, -1.0]), (None, [3.0, 0.1]), (6, [0.25, -1.0]), (7, [1.0]), (8, [])],
        "vec_id long, embedding array<float>",
    )
    used = docs.where(whitening.usable(F.col("embedding")))
    rows = whitening.whitened(used.select("vec_id", whitening.whole(F.col("embedding")).alias("x")), "vec_id", "x").collect()
    assert sorted((r.vec_id or 0, r.component) for r in rows) == [(0, 1), (0, 2), (1, 1), (1, 2), (6, 1), (6, 1), (6, 2), (6, 2)]
    assert {r.n for r in rows} == {4}
    for few in ([], [(1, None, 1, "c")], [(1, [], 1, "c")], [(1, [3, 4], 1, "c")] * 5):
        assert whitening.whitened(frame(spark, few), "vec_id", "x").collect() == []
    flat = whitening.whitened(frame(spark, [(i, [i, 2 * i, 7], 1, "c") for i in range(9)]), "vec_id", "x").collect()
    assert {r.component for r in flat} == {1} and flat[0].identity_error < 1e-9


def test_deviations_are_exact_or_fail():
    centre = whitening.Centre(3, (3 * 10**9 + 1, 0))
    x = np.array([[10**9 + 5, -2], [10**9, 1]])
    assert centre.deviation(x) == [(3 * (10**9 + 5) - 3 * 10**9 - 1) ** 2 + 36, 1 + 9]
    big = whitening.Centre(10**9, (0,))
    assert big.deviation(np.array([[3]])) == [9 * 10**18]
    with pytest.raises(OverflowError):
        big.deviation(np.array([[4]]))
