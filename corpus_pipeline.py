"""Documents to training rows: five stages, each written as Parquet and read again as the next one's documents.

All but the last give the columns of documents. Every stage works on all rows
that the one before it kept, and an empty table passes through all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import mixing, order_minhash, quality_rules, queries as llm_queries, secret_scan, sentencepiece_codec
from sluice.llm.work import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule go."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: that with the smallest id."""
    return order_minhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark, and n_chars follows the text; no document goes."""
    clean = secret_scan.redacted(docs, llm_queries.secret_models(docs), out="clean_text_")
    changed = ~F.col("clean_text_").eqNullSafe(F.col("text"))
    return clean.select(
        *[
            F.col("clean_text_").alias(c)
            if c == "text"
            else F.when(changed, F.char_length("clean_text_").cast("long")).otherwise(F.col(c)).alias(c)
            if c == "n_chars"
            else F.col(c)
            for c in docs.columns
        ]
    )


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of languages below their target are repeated; rates do not fall below 1, so none goes."""
    classifier = llm_queries.language_classifier(spark, sf_dir)
    return mixing.repeated(docs, classifier, mixing.Mixture(llm_queries.LANGUAGES, least=1.0))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, as a training job reads them, and whether they decode to the text itself."""
    name = sentencepiece_codec.send(spark, llm_queries.TOKENIZER)
    coded = sentencepiece_codec.encode_and_compare(F.col("text"), name)
    rows = docs.select("doc_id", "lang", "source", coded.alias("coded"))
    return rows.select("doc_id", "lang", "source", "coded.ids", F.size("coded.ids").cast("long").alias("n_tokens"), "coded.round_trip")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("order_minhash", near_duplicates),
    ("secret_scan", secrets),
    ("mixing", mixture),
    ("sentencepiece", tokens),
]

ORACLE_SQL: str | None = None  # alignment, training and tokenizing are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
