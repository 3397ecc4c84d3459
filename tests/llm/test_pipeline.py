from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice import session
from sluice.llm import order_minhash, quality_rules, queries, secret_scan

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents, then what each stage makes of them, written and read again."""
    frames = [spark.read.parquet(f"{DATA}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        path = session.fresh_dir(spark, name)
        stage(spark, frames[-1], DATA).write.parquet(path)
        frames.append(spark.read.parquet(path))
    return frames


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "order_minhash", "secret_scan", "mixing", "sentencepiece"]
    assert all(sorted(f.dtypes) == sorted(stages[0].dtypes) for f in stages[:-1])


def test_decisions_take_effect(spark, stages):
    docs, good, single, clean, mixed, tokens = stages
    kept = {r.doc_id for r in quality_rules.judged(docs).where("quality.kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept and len(kept) < docs.count()
    classes = order_minhash.duplicate_classes(good).collect()
    assert sorted(r.doc_id for r in single.collect()) == sorted({r.class_id for r in classes})
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in single.collect())
    again = secret_scan.scanned(clean, queries.secret_models(clean)).where("size(secrets.base) > 0").count()
    assert again == 0 and clean.where(F.col("n_chars") != F.char_length("text")).count() == 0
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) == {r.doc_id for r in clean.collect()} and max(copies.values()) > 1
    assert Counter(r.doc_id for r in tokens.collect()) == copies
    assert all(len(r.ids) == r.n_tokens > 0 for r in tokens.collect())


def test_secrets_go_and_the_text_around_them_stays(spark):
    """The smallest tables hold no secret, so these are planted."""
    words = " ".join(f"the word{i} of" for i in range(40))
    odd = [(1, f"{words} password = hunter2horse {words}", "en", "s", 0), (2, f"key AKIA{'B7' * 10} and {'0f' * 16}", "en", "s", 0), (3, words, "en", "s", 7)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    clean = {r.doc_id: r for r in corpus_pipeline.secrets(spark, docs, DATA).collect()}
    assert clean[1].text == f"{words} [SECRET] {words}" and clean[2].text == "key [SECRET] and [SECRET]"
    assert clean[3].text == words and clean[3].n_chars == 7
    assert all(clean[i].n_chars == len(clean[i].text) for i in (1, 2))


def test_round_trip_is_told(spark, stages):
    assert all(r.round_trip for r in stages[-1].collect())
    odd = [(1, "a plain text", "en", "s", 12), (2, "a ▁ marked one", "en", "s", 14), (3, None, "en", "s", 0)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    told = {r.doc_id: r.round_trip for r in corpus_pipeline.tokens(spark, docs, DATA).collect()}
    assert told == {1: True, 2: False, 3: True}


def test_run(spark, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, DATA).collect())) == sorted(map(str, stages[-1].collect()))


def test_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    words = " ".join(f"the word{i} of" for i in range(40))
    odd = [(None, words, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, words, "en", "s", 1), (3, words, "en", "s", 1)]
    for rows, ids in (([], []), (odd, [3])):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, DATA)
        assert sorted({r.doc_id for r in docs.collect()}) == ids
