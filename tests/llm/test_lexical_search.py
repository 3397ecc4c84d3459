import math
import random
import re
from collections import Counter

import pytest

from sluice.llm import lexical_search
from sluice.llm.lexical_search import search

DOCS, ITEMS = "doc_id long, text string, rank int, score string", "item_id long, text string, id int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    """Every document scored for every item, as the contract words it."""
    split = [(i, terms(t)) for i, t, *_ in docs]
    split = [(i, t) for i, t in split if t]
    n_docs, total = len(split), sum(len(t) for _, t in split)
    df = Counter(x for _, t in split for x in set(t))
    rows = []
    for item, text, *_ in items:
        scores = []
        for doc, found in split:
            tf, m = Counter(found), 100 - 75 + (75 * len(found) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10**9 * tf[x]) // (1000 * tf[x] + 8 * m)) for x in terms(text) if tf[x])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        scores.sort()
        rows += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(scores[:k], 1)]
    return Counter(rows)


def found(spark, docs, items, k=10):
    docs = [(*d, 1, "x") for d in docs]
    return Counter(map(tuple, search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame([(*i, 1) for i in items], ITEMS), k).collect()))


def prose(rng, words, n):
    return " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=n))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bucket", [3, 64])
def test_equals_brute_force(spark, monkeypatch, seed, bucket):
    monkeypatch.setattr(lexical_search, "BUCKET", bucket)
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)] + ["É", "straße", "漢字", "A-b"]
    docs = [(i, prose(rng, words, rng.choice([0, 1, 5, 40, 300]))) for i in range(300)]
    docs += [(1000 + i, docs[17][1]) for i in range(120)]  # copies: ties beyond k
    items = [(i, prose(rng, words, rng.choice([1, 3, 30]))) for i in range(25)] + [(99, docs[17][1])]
    assert found(spark, docs, items) == brute(docs, items, 10)
    assert found(spark, docs, items, 3) == brute(docs, items, 3)


def test_edges(spark):
    docs = [(None, "alpha beta"), (None, None), (1, None), (2, ""), (3, " .,;\u0000\n"), (4, "alpha"), (4, "alpha"), (5, "Alpha ALPHA beta" + " x" * 200_000), (6, "beta\x7falpha`é")]
    items = [(1, "alpha"), (1, "alpha"), (2, None), (3, ""), (None, "beta alpha beta"), (4, "nowhere"), (5, "é x")]
    assert found(spark, docs, items) == brute(docs, items, 10)
    assert found(spark, [], items) == found(spark, docs, []) == found(spark, docs[1:5], items) == Counter()
    with pytest.raises(ValueError, match="k must"):
        found(spark, docs, items, 0)


def test_items_in_blocks(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, prose(rng, words, 30)) for i in range(80)]
    items = [(i, prose(rng, words, 8)) for i in range(30)]
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 300)
    assert found(spark, docs, items) == brute(docs, items, 10)


def test_buckets_and_documents_are_skipped(spark):
    """Bounds do their work: with a threshold set, few vectors of a bucket are rescored, and short buckets are left out."""
    import numpy as np

    items = lexical_search.Items()
    items.add(b"rare common")
    weights = np.array([9000, 10], np.int64)
    rescored = []

    class Counting(lexical_search.Search):
        def rescored(self, i, keep, *rest):
            rescored.append(len(keep))
            return super().rescored(i, keep, *rest)

    def bucket(impacts):
        """One vector for each (impact of rare, impact of common)."""
        pairs = [[(t, v) for t, v in enumerate(p) if v] for p in impacts]
        ends = np.cumsum([0, *map(len, pairs)])
        flat = np.array([x for p in pairs for x in p], np.int64).reshape(-1, 2)
        length = np.array([math.sqrt(sum(weights[t] * v * v for t, v in p)) for p in pairs])
        n = len(pairs)
        searched.bucket(np.arange(n), np.zeros(n, bool), length, flat[:, 0], flat[:, 1], ends)

    searched = Counting(items, weights, [1], 2)
    bucket([(5000, 100), (4000, 100)] + [(0, 900)] * 50)
    assert searched.best[0].threshold == 9000 * 4000 + 10 * 100
    rescored.clear()
    bucket([(4500, 0)] + [(0, 900)] * 50 + [(100, 900)] * 50)  # common alone cannot reach the threshold, nor a little of rare
    assert rescored == [1] and searched.best[0].threshold == 9000 * 4500
    rescored.clear()
    bucket([(10, 900)] * 50)
    assert rescored == []


def test_long_texts_are_read_in_stretches(monkeypatch):
    monkeypatch.setattr(lexical_search, "STRETCH", 10)
    text = "one two-three " * 50 + "x" * 100 + " ÜBER end"
    n, counts = lexical_search.counted(text.encode())
    assert n == len(terms(text)) and {k.decode(): v for k, v in counts.items()} == Counter(terms(text))
