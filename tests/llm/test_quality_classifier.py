import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import quality_classifier, queries, textbytes
from sluice.llm.quality_classifier import Training

DATA = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score string, label string"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = queries.op5_quality_classifier(spark, DATA).collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    right = {q: np.mean([p == q for p, want in judged if want == q]) for q in (0, 1)}
    assert len(judged) > 60 and min(right.values()) >= 0.9, right


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").limit(300)
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    how = Training(epochs=3)
    scores = []
    for flipped in (False, True):
        changed = labels.withColumn("label", F.when(queries.held_out("doc_id") & F.lit(flipped), 1 - F.col("label")).otherwise(F.col("label")))
        sample = quality_classifier.labelled_sample(docs, changed.where(~queries.held_out("doc_id")), how)
        model = quality_classifier.train(sample, how)
        scores.append(sorted((r.doc_id, r.score) for r in quality_classifier.score(model, docs).collect()))
    assert scores[0] == scores[1]


def test_scores_equal_plain_averages(spark):
    how = Training(bits=8, epochs=2)
    rng = random.Random(3)
    texts = [None, "", " \n", "a", "ab ab", "é\tü", "x" * 50_000, *[" ".join(rng.choice(["spam", "ham", "egg!"]) for _ in range(n)) for n in (3, 30, 3000)]]
    docs = spark.createDataFrame([(i, t, "s", "l") for i, t in enumerate(texts)] + [(None, "ab ab", None, None)] * 2, SCHEMA)
    model = quality_classifier.Model(how, np.random.default_rng(1).normal(size=256), 0.25)

    def brute(text):
        import pyarrow as pa

        effects = []
        for block in textbytes.blocks(pa.array([text])):
            for _, buckets in quality_classifier.features(block, how):
                effects += model.effect[buckets].tolist()
        words = (text or "").split()
        twice = sum(a == b for a, b in zip(words, words[1:], strict=False))
        threes = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        again = len(threes) - len(set(threes))
        assert len(effects) == twice + again + sum(1 + sum(max(len(w.encode()) + 2 - n + 1, 0) for n in how.grams) for w in words)
        z = (sum(effects) / len(effects) if effects else 0) + 0.25
        return 1 / (1 + np.exp(-z))

    rows = quality_classifier.score(model, docs).collect()
    assert len(rows) == len(texts) + 2
    assert all(abs(r.score - brute(r.text)) < 1e-9 for r in rows)
    assert quality_classifier.score(model, docs.limit(0)).collect() == []


def test_missing_labels(spark):
    schema = "doc string, label int, text string"
    none = quality_classifier.train(spark.createDataFrame([], schema))
    ones = quality_classifier.train(spark.createDataFrame([("1", 1, "a b")] * 8, schema))
    docs = spark.createDataFrame([(1, "any text", "s", "l")], SCHEMA)
    assert [quality_classifier.score(m, docs).first().score for m in (none, ones)] == pytest.approx([0.5, 0.9])


def test_sample_is_bounded_and_clean(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("score"), F.lit("x").alias("label"))
    labels = spark.createDataFrame([(i, i % 3) for i in range(100)] + [(None, 1), (5, None)], "doc_id long, label int")
    sample = quality_classifier.labelled_sample(docs, labels, Training(max_rows=20)).collect()
    assert len(sample) == 20 and {r.label for r in sample} <= {0, 1}
