import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from sluice import session
from sluice.llm import queries, sentencepiece_codec
from sluice.llm.sentencepiece_codec import Codec, Model, parse, tokenizer

DATA = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, tokens string, ids int"
TEXTS = [
    "", " ", "  ", "\n", "a", " a", "a ", "  two  spaces   three    ", "tab\there", "line\r\nend", "𝒳 é ü ñ ß 漢字 🎉👩‍👩‍👧", "▁marked ▁▁ text▁",
    "<s> </s> <unk> <0x41>", "aaaaaaaaaaaaaaaaaaa", "x" * 3000, "word " * 5000, "\u0000 � ​", "ÉTÉ!! ### $$$", "1234567890" * 30,
]


@pytest.fixture(scope="module")
def data():
    with open(queries.TOKENIZER, "rb") as file:
        return file.read()


def test_model_file(data):
    model, other = parse(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    assert len(model.pieces) == other.vocab_size()
    assert all(text == other.id_to_piece(i) and abs(score - other.get_score(i)) < 1e-6 for i, (text, score, _) in enumerate(model.pieces))
    assert model.kind == sentencepiece_codec.BPE and model.byte_fallback and model.dummy_prefix and not model.remove_extra_spaces


def test_parity_on_all_documents(spark, data):
    codec, other = Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()] + TEXTS
    want = other.encode(texts)
    for text, ids, expected in zip(texts, codec.encode(texts), want, strict=True):
        assert ids.tolist() == expected, text[:80]
        assert codec.decode(ids) == back(text)


def back(text):
    """A text as it is decoded: the mark for spaces is one itself."""
    return text.replace("▁", " ")


def test_random_texts(data):
    codec, other = Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab cdeéñ\n\t  THe.,漢🎉▁") for _ in range(rng.randrange(60))) for _ in range(2000)]
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert ids.tolist() == other.encode(text), text


@pytest.mark.parametrize("remembered", [0, 2000, 1 << 23])
def test_different_words_are_encoded_once(data, monkeypatch, remembered):
    monkeypatch.setattr(sentencepiece_codec, "KNOWN_BYTES", remembered)
    monkeypatch.setattr(sentencepiece_codec, "WORDS_BATCH_CHARS", 4000)
    monkeypatch.setattr(sentencepiece_codec, "WORDS_AT_ONCE", 7)
    codec, other, encoded, rng = Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data), [], random.Random(3)
    core = codec.known.core
    codec.known.core = SimpleNamespace(tokenize=lambda word: encoded.append(word) or core.tokenize(word))
    some = ["the", "é", "漢字", "", "", "▁x", "a\nb", "\u0000", *(f"word{i}" for i in range(200))]
    texts = [" ".join(rng.choices(some, k=rng.randrange(40))) for _ in range(500)]
    assert [x.tolist() for x in codec.encode(texts)] == other.encode(texts)
    assert len(set(encoded)) < len(encoded) < sum(map(len, map(str.split, texts))) if remembered < 1 << 23 else len(set(encoded)) == len(encoded)


def test_words_and_where_texts_begin():
    found, begins = sentencepiece_codec.words(pa.array(["", " a  b ", "", "c", "  ", "é d"], pa.large_string()))
    assert found.to_pylist() == [" a", "  b", " ", "c", "  ", "é", " d"] and begins.tolist() == [0, 0, 3, 3, 4, 5, 7]
    found, begins = sentencepiece_codec.words(pa.array(["", ""], pa.large_string()))
    assert found.to_pylist() == [] and begins.tolist() == [0, 0, 0]


def test_models_that_rewrite_texts_get_them_whole():
    pieces = (("<unk>", 0.0, 2), ("▁", -3.0, 1), ("a", -2.0, 1))
    plain = Model(pieces, sentencepiece_codec.UNIGRAM, False, b"", True, False, True)
    assert sentencepiece_codec.only_words(plain)
    assert not sentencepiece_codec.only_words(Model((*pieces, ("a▁a", -1.0, 1)), *list(vars(plain).values())[1:]))
    assert not sentencepiece_codec.only_words(Model((*pieces, ("b", 0.0, 4)), *list(vars(plain).values())[1:]))
    assert not sentencepiece_codec.only_words(Model(pieces, sentencepiece_codec.UNIGRAM, False, b"", True, True, True))
    assert not sentencepiece_codec.only_words(Model(pieces, sentencepiece_codec.UNIGRAM, False, b"map", True, False, True))


def test_unigram_models_keep_scores_and_bytes():
    pieces = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("▁ab", -1.0, 1), ("a", -2.0, 1), ("b", -2.5, 1)]
    pieces += [(f"<0x{i:02X}>", -9.0, 6) for i in range(256)]
    built = tokenizer(Model(tuple(pieces), sentencepiece_codec.UNIGRAM, True, b"", True, True, True))
    tokens = [built.id_to_token(i) for i in built.encode("  ab  ba é ", add_special_tokens=False).ids]
    assert tokens == ["▁ab", "▁", "b", "a", "▁", "<0xC3>", "<0xA9>"]


def test_query_verifies_every_text(spark):
    rows = queries.op7_sentencepiece(spark, DATA).collect()
    assert len(rows) == 1000 and all(r.parity and r.round_trip for r in rows)


def test_columns_and_edges(spark):
    name = sentencepiece_codec.send(spark, queries.TOKENIZER)
    docs = spark.createDataFrame([(i, t, "t", 1) for i, t in enumerate(TEXTS)] + [(None, None, None, None), (1, "same", "t", 1), (1, "same", "t", 1)], SCHEMA)
    coded = docs.withColumn("coded", sentencepiece_codec.encode(F.col("text"), name))
    rows = coded.withColumn("back", sentencepiece_codec.decode(F.col("coded"), name)).collect()
    assert len(rows) == len(TEXTS) + 3
    assert all(r.back == back(r.text or "") for r in rows)
    found = sentencepiece_codec.checked(docs, name, out="found").collect()
    assert all(r.found.parity and r.found.round_trip == ("▁" not in (r.text or "")) for r in found)
    assert sentencepiece_codec.checked(docs.limit(0), name).collect() == []
    assert spark.createDataFrame([(None,), ([],)], "ids array<int>").select(sentencepiece_codec.decode(F.col("ids"), name)).collect() == [("",), ("",)]


def test_bytes_that_make_no_character(data):
    codec = Codec(data)
    bad = [i for i, (_, _, kind) in enumerate(codec.model.pieces) if kind == sentencepiece_codec.BYTE][0xFF]
    assert codec.decode(np.array([bad])) == "�"


def test_a_column_named_as_the_result_is_kept(spark):
    name = sentencepiece_codec.send(spark, queries.TOKENIZER)
    docs = spark.createDataFrame([("a b", 1, 2)], "text string, Tokens int, tokens_ int")
    found = sentencepiece_codec.checked(docs, name)
    assert found.columns == ["text", "Tokens__", "tokens_", "tokens"] and found.first().Tokens__ == 1


def test_long_texts_reach_workers_in_small_batches(spark, setting):
    rows_together = arrow_udf(lambda column: pa.array([len(column)] * len(column), pa.int32()), "int")
    docs = spark.range(0, 100, 1, 1).select(F.repeat(F.lit("a "), 100_000).alias("text"))
    setting(session.BATCH_BYTES, "1m")
    sentencepiece_codec.send(spark, queries.TOKENIZER)
    assert spark.conf.get(session.BATCH_BYTES) == "1m"  # the user's own
    spark.conf.unset(session.BATCH_BYTES)
    sentencepiece_codec.send(spark, queries.TOKENIZER)
    sizes = [r[0] for r in docs.select(rows_together("text")).collect()]
    assert len(sizes) == 100 and max(sizes) <= 22
