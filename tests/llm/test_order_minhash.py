import itertools
import random
import re

import numpy as np
import pytest

from sluice.llm import graph, order_minhash
from sluice.llm.order_minhash import OrderMinHash, common_in_band, similarity

SCHEMA = "doc_id long, text string, node string, unit long"
DATA = "/root/testdata/sf0.001/documents.parquet"


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)] or ([tuple(words)] if words else [])


def longest_common(a, b):
    before = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
        before = row
    return before[-1]


def brute_similarity(a, b):
    m = longest_common(a, b)
    return m / (len(a) + len(b) - m) if a and b else 0.0


def brute_classes(rows):
    """Class of each row by comparing all pairs of texts."""
    texts = sorted({t for _, t in rows if shingles(t)})
    name = {t: t for t in texts}

    def root(t):
        while name[t] != t:
            t = name[t]
        return t

    cut = {t: shingles(t) for t in texts}
    sets = {t: set(s) for t, s in cut.items()}
    for a, b in itertools.combinations(texts, 2):
        if sets[a] & sets[b] and brute_similarity(cut[a], cut[b]) >= 0.8:
            name[max(root(a), root(b))] = min(root(a), root(b))
    ids = {}
    for i, t in rows:
        if t in name and i is not None:
            ids[root(t)] = min(ids.get(root(t), i), i)
    return sorted(((i, ids.get(root(t)) if t in name else i) for i, t in rows), key=str)


def prose(rng, n, words=400):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def test_band_equals_full_alignment():
    rng = random.Random(3)
    for _ in range(300):
        a = [rng.randrange(8) for _ in range(rng.randrange(1, 30))]
        b = list(a)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = [rng.randrange(8)] * rng.randrange(2)
        whole = longest_common(a, b)
        unmatched = len(a) + len(b) - 2 * whole
        assert common_in_band(a, b, max(unmatched, abs(len(a) - len(b))) + 1) == whole


def test_similarity_is_exact_from_the_threshold():
    rng = random.Random(5)
    for _ in range(200):
        a = [rng.randrange(1 << 40) for _ in range(60)]
        b = list(a)
        for _ in range(rng.randrange(12)):
            b[rng.randrange(len(b))] = rng.randrange(1 << 40)
        want = brute_similarity(a, b)
        got = similarity(np.array(a, np.uint64), np.array(b, np.uint64), 0.8)
        assert got == pytest.approx(want) if want >= 0.8 else got < 0.8


def test_classes_equal_brute_force(spark):
    docs = spark.read.parquet(DATA)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(((r.doc_id, r.class_id) for r in order_minhash.duplicate_classes(docs).collect()), key=str)
    assert got == brute_classes(rows)


def test_group_of_copies_chain_and_edges(spark):
    rng = random.Random(11)
    base = prose(rng, 300)
    rows = [(i, " ".join(base)) for i in range(40)]
    for i in range(40, 120):  # near copies of a hot text
        near = list(base)
        for _ in range(3):
            near[rng.randrange(300)] = f"x{rng.randrange(99)}"
        rows.append((i, " ".join(near)))
    chain = prose(rng, 200)
    for i in range(200, 212):  # each like the one before, the last unlike the first
        rows.append((i, " ".join(chain)))
        chain = chain[6:] + prose(rng, 6)
    passage = prose(rng, 60)
    rows += [(i, " ".join(prose(rng, 150) + passage + prose(rng, 150))) for i in range(300, 330)]  # a shared passage only
    rows += [(400, None), (401, ""), (402, " \n"), (None, " ".join(base)), (None, None), (403, "one two"), (404, "one  two")]
    rows += [(404, "one  two"), (405, "word " * 3000), (406, "word " * 2990), (407, "x" * 200_000)]
    docs = spark.createDataFrame([(i, t, "extra", 1) for i, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.class_id) for r in order_minhash.duplicate_classes(docs).collect()), key=str)
    assert got == brute_classes(rows)

    kept = order_minhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    firsts = {c for i, c in got if c is not None and i == c}
    want = [i for i, t in rows if not shingles(t)] + [i for i in firsts if i not in (400, 401, 402)]
    assert ids == sorted(want, key=str)


def test_a_repeated_line_hides_no_copy(spark):
    rng, rows = random.Random(17), []
    for i in range(12):
        once = [f"t{i}w{j}" for j in range(100)]
        twice = once + once[40:48] if i % 2 else once[:60] + once[20:28] + once[60:]
        assert len(set(shingles(" ".join(once)))) == len(shingles(" ".join(once)))
        rows += [(2 * i, " ".join(once)), (2 * i + 1, " ".join(twice))]
        x = list(order_minhash.sequences(order_minhash.pa.array([" ".join(once), " ".join(twice)]), 5))
        assert order_minhash.connecting(x, np.array([0, 1]), np.array([5, 6]), 0.8) == [(0, 1)]
        kept = order_minhash.labelled(np.concatenate([x[0], x[0][:3]]))
        assert (kept[: len(x[0])] == x[0]).all() and len(set(kept.tolist())) == len(kept)
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "extra", 1) for i, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.class_id) for r in order_minhash.duplicate_classes(docs).collect()), key=str)
    assert got == brute_classes(rows)
    assert all(c == i - i % 2 for i, c in got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert order_minhash.duplicate_classes(docs).collect() == []
    assert order_minhash.keep_one(docs).collect() == []


def test_recall_at_the_threshold():
    how = OrderMinHash()
    rng, found = np.random.default_rng(2), 0
    sketcher = order_minhash.Sketcher(how)
    for _ in range(60):
        a = rng.integers(0, 1 << 62, 450).astype(np.uint64)
        b = a.copy()
        b[rng.choice(450, 50, replace=False)] = rng.integers(0, 1 << 62, 50).astype(np.uint64)  # 400 / 500 = 0.8

        def keys(x):
            entries = order_minhash.textbytes.mix(sketcher.entries(x)).reshape(how.bands, how.rows)
            return (entries * sketcher.in_band).sum(axis=1, dtype=np.uint64)

        found += bool((keys(a) == keys(b)).any())
    assert found >= 59


def test_components(spark):
    links = [("a", "b"), ("c", "b"), ("x", "y"), ("z", "y"), ("q", "q"), (None, "a")]
    links += [(f"n{i:03}", f"n{i + 1:03}") for i in range(60)]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a string, b string")).collect()}
    want = {x: "a" for x in "abc"} | {x: "x" for x in "xyz"} | {f"n{i:03}": "n000" for i in range(61)}
    assert found == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []
