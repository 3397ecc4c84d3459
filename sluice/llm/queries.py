"""Each operator applied to its whole table with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import session
from sluice.llm import (
    grid_join,
    lexical_search,
    license_scan,
    mixing,
    oracle,
    order_minhash,
    quality_classifier,
    quality_rules,
    secret_scan,
    sentencepiece_codec,
    sharding,
    url_filter,
    warc,
    whitening,
)
from sluice.llm.work import stored

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"

#: Target weights of the languages, between their natural shares and equal ones.
LANGUAGES = {"en": 0.5, "fr": 0.18, "de": 0.17, "es": 0.15}

# The rules that page URLs are judged by.
URL_RULES = (
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.duplicate_classes(table(spark, sf_dir, "documents"))


def secret_models(docs: DataFrame) -> secret_scan.Models:
    spark = docs.sparkSession
    made = secret_scan.random_strings(spark).unionByName(secret_scan.ordinary_strings(spark))
    return secret_scan.train(secret_scan.labelled_strings(docs).unionByName(made))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scanned(docs, secret_models(docs))
    of_kind = lambda kind: F.size(
        F.filter("secrets.base", lambda s: s["kind"] == secret_scan.KINDS.index(kind))
    ).cast("long")
    return found.select(
        "doc_id",
        *[of_kind(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secret_scan.written(F.col("secrets.base")), 256).alias("base_sha256"),
        secret_scan.written(F.col("secrets.spans")).alias("spans"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[f"quality.{c}" for c in counts], F.array_join("quality.failed", ",").alias("failed"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = session.fresh_dir(spark, "archives")
    warc.write(table(spark, sf_dir, "pages"), folder)
    records = stored(warc.summaries(warc.read(spark, folder)), "records")  # read the archives once
    found = warc.digests(warc.captures(records))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def held_out(id: str) -> F.Column:
    return F.crc32(F.col(id).cast("string")) % 4 == 2


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id")).select("doc_id", F.col("quality").alias("label"))
    how = quality_classifier.Training()
    model = quality_classifier.train(quality_classifier.labelled_sample(docs, labels, how), how)
    return quality_classifier.score(model, docs).select(
        "doc_id",
        F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    each = lambda x: F.concat_ws(":", x["name"], x["start"].cast("string"), x["end"].cast("string"), x["differences"])
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join(F.transform("licenses", each), ",").alias("licenses"),
    )


def op7_sentencepiece(spark: SparkSession, sf_dir: str, model: str = TOKENIZER) -> DataFrame:
    name = sentencepiece_codec.send(spark, model)
    checked = sentencepiece_codec.checked(table(spark, sf_dir, "documents").select("doc_id", "text"), name)
    return checked.select("doc_id", "tokens.*")


def listed_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: canonical URLs of the pages whose number is that of a document labelled toxic."""
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("page_id")).distinct()
    pages = table(spark, sf_dir, "pages").join(toxic, "page_id", "left_semi")
    return pages.select(url_filter.canonical(F.col("url")).alias("url"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = stored(listed_urls(spark, sf_dir), "listed")
    return url_filter.judged(pages, URL_RULES, listed).select(
        "page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict", "judged.listed"
    )


def language_classifier(spark: SparkSession, sf_dir: str, max_rows: int = 20_000) -> mixing.Classifier:
    """Domains are languages, learned from the documents that the label table marks good.

    Of those the `max_rows` with the smallest hashes are read: a bounded table, so it is broadcast.
    """
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
    chosen = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    labelled = table(spark, sf_dir, "documents").join(F.broadcast(chosen), "doc_id", "left_semi")
    return mixing.train(labelled.select("text", F.col("lang").alias("domain")), list(LANGUAGES))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    classifier = language_classifier(spark, sf_dir)
    mixed = mixing.mixed(docs, classifier, mixing.Mixture(LANGUAGES))
    shares = [F.round(F.get("mix.posterior", i), 9).alias(f"p_{d}") for i, d in enumerate(classifier.domains)]
    totals = [F.get(f"mix.{c}", i).alias(f"{c}_{d}") for c in ("targets", "expected") for i, d in enumerate(classifier.domains)]
    return mixed.select("doc_id", F.col("mix.tokens").alias("n_tokens"), *shares, "mix.rate", "mix.copies", *totals)


def op10_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.near_duplicates(table(spark, sf_dir, "embeddings"))


SHARDS = 8


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = sharding.assigned(stored(docs, "sizes"), SHARDS)  # texts are read once and not moved
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").where(whitening.usable(F.col("embedding")))
    return whitening.whitened(vectors.select("vec_id", whitening.whole(F.col("embedding")).alias("x")), "vec_id", "x")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_order_minhash": op1_order_minhash,
        "op2_secret_scan": op2_secret_scan,
        "op3_quality_rules": op3_quality_rules,
        "op4_warc": op4_warc,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_license_scan": op6_license_scan,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_url_filter": op8_url_filter,
        "op9_mixing": op9_mixing,
        "op10_grid_join": op10_grid_join,
        "op11_sharding": op11_sharding,
        "op12_lexical_search": op12_lexical_search,
        "op13_whitening": op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_quality_rules": oracle.quality(),
        "op4_warc": oracle.WARC,
        "op8_url_filter": oracle.urls(URL_RULES),
        "op10_grid_join": oracle.EMBEDDINGS,
        "op11_sharding": oracle.sharding(SHARDS),
        "op12_lexical_search": oracle.SEARCH,
    }
