"""Quality scores from supervised subword embeddings.

Every word, every run of 3 to 5 bytes of a word with its ends marked, and two
kinds of repeated word n-grams have vectors in a hashed table. A text's vector is the mean over all of them; a
softmax layer turns it into the probability of label 1. Table and layer are
learned together by stochastic gradient descent in numpy on the driver, from a
bounded sample of labelled rows.

For scoring, the layer is folded into the table: a text's score is the mean of
one number per feature, so whole texts are read at the price of a lookup.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from sluice.llm import textbytes
from sluice.llm.work import ship


#: Features of their own, one each for two kinds of word n-grams: a word twice in a row, and three words that come again.
AGAIN = textbytes.mix(np.array([1, 2], np.uint64))


@dataclass(frozen=True)
class Training:
    """`max_rows` bounds the labelled sample, the one part of a job that does not grow with the corpus."""

    max_rows: int = 4000
    bits: int = 13
    grams: tuple[int, ...] = (3, 4, 5)
    dim: int = 8
    epochs: int = 30
    batch: int = 32
    rate: float = 0.5
    seed: int = 11


@dataclass(frozen=True)
class Model:
    """`effect` of each feature on the difference of the two logits, and what an empty text has."""

    how: Training
    effect: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        out = []
        for block in textbytes.blocks(column):
            total, n = np.zeros(block.n), np.zeros(block.n)
            for text, buckets in features(block, self.how):
                total += np.bincount(text, self.effect[buckets], block.n)
                n += np.bincount(text, minlength=block.n)
            out.append(1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + self.bias, -500, 500))))
        return np.concatenate(out) if out else np.zeros(0)


def features(block: textbytes.Block, how: Training) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of arrays: the number of a text in the block, and the bucket of one of its features."""
    starts, ends, first = block.words()
    if not len(starts):
        return
    shift = np.uint64(64 - how.bits)
    word_text = np.repeat(np.arange(block.n), np.diff(first))
    words = block.word_hashes(starts, ends)
    yield word_text, (words >> shift).astype(np.int64)
    for mark, again in zip(AGAIN >> shift, repeats(words, word_text), strict=True):
        yield word_text[again], np.full(int(again.sum()), mark, np.int64)
    # the words again, each between two marks
    length = ends - starts + 2
    begin = np.concatenate(([0], np.cumsum(length)[:-1]))
    marked = np.zeros(int(length.sum()), np.uint64)
    inside = np.ones(len(marked), bool)
    inside[begin] = inside[begin + length - 1] = False
    marked[begin], marked[begin + length - 1] = 257, 258
    marked[inside] = textbytes.BYTE_VALUE[block.data[textbytes.IS_WORD[block.data]]]
    left = np.repeat(begin + length, length) - np.arange(len(marked))  # bytes to the word's end
    text = np.repeat(word_text, length)
    for n in how.grams:
        weights = textbytes.mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(1000 * n)) | np.uint64(1)
        size = len(marked) - n + 1
        if size <= 0:
            continue
        value = np.zeros(size, np.uint64)
        for k in range(n):
            value += marked[k : k + size] * weights[k]
        whole = left[:size] >= n
        value = value[whole]
        yield text[:size][whole], ((value ^ (value >> np.uint64(29))) * textbytes.PRIME >> shift).astype(np.int64)


def repeats(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words are the word before once more, and which begin three words that their text has had already."""
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    size = max(len(words) - 2, 0)
    three = textbytes.mix(words[:size] + textbytes.mix(words[1 : size + 1] + textbytes.mix(words[2:])))
    whole = text[:size] == text[2:]
    keys = np.where(whole, textbytes.mix(three ^ textbytes.mix(text[:size].astype(np.uint64))), np.arange(size, dtype=np.uint64))
    order = np.argsort(keys, kind="stable")
    had = np.zeros(len(words), bool)
    had[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    had[:size] &= whole
    return same, had


def frequencies(rows: DataFrame, how: Training) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """(label, buckets, shares) of the texts of rows (doc, label, text), in the order of doc, label and content."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, shares = [], []
            for block in textbytes.blocks(batch.column("text"), 1 << 18):
                found = list(features(block, how))
                text = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
                at = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.int64)
                keys, n = np.unique((text << how.bits) | at, return_counts=True)
                cut = np.searchsorted(keys, np.arange(block.n + 1) << how.bits)
                for i in range(block.n):
                    part = slice(cut[i], cut[i + 1])
                    buckets.append((keys[part] & ((1 << how.bits) - 1)).astype(np.int32))
                    shares.append((n[part] / max(n[part].sum(), 1)).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("label"), pa.array([x.tobytes() for x in buckets], pa.binary()), pa.array([x.tobytes() for x in shares], pa.binary())],
                ["doc", "label", "buckets", "shares"],
            )

    found = rows.select("doc", "label", "text").mapInArrow(run, "doc string, label int, buckets binary, shares binary")
    kept = sorted((r["doc"] or "", r["label"], bytes(r["buckets"]), bytes(r["shares"])) for r in found.collect())
    return [(label, np.frombuffer(b, np.int32), np.frombuffer(s, np.float32)) for _, label, b, s in kept]


def train(rows: DataFrame, how: Training = Training()) -> Model:
    """A model from rows (doc, label, text), label 0 or 1; at most `max_rows` of them may be given.

    With no rows, or rows of one label only, every text scores the smoothed share of label 1.
    """
    sample = frequencies(rows, how)
    labels = np.array([label for label, _, _ in sample], int)
    size = 1 << how.bits
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(set(labels.tolist())) < 2:
        return Model(how, np.zeros(size), float(np.log(share / (1 - share))))
    x = np.zeros((len(sample), size), np.float32)
    for i, (_, buckets, shares) in enumerate(sample):
        x[i, buckets] = shares
    spread = 1 / np.sqrt((x * x).sum(axis=1).mean())  # steps as if mean vectors had length 1
    rng = np.random.default_rng(how.seed)
    table = rng.uniform(-1, 1, (size, how.dim)).astype(np.float32) / how.dim
    layer = rng.uniform(-1, 1, (how.dim, 2)).astype(np.float32) / np.sqrt(how.dim)
    bias = np.zeros(2, np.float32)
    wanted = np.eye(2, dtype=np.float32)[labels]
    updates, done = how.epochs * -(-len(x) // how.batch), 0
    for _ in range(how.epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(order), how.batch):
            rows_now = order[i : i + how.batch]
            rate = how.rate * (1 - done / updates)
            done += 1
            part = x[rows_now] * spread
            hidden = part @ table
            logits = hidden @ layer + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = (p / p.sum(axis=1, keepdims=True) - wanted[rows_now]) / len(rows_now)
            back = error @ layer.T
            layer -= rate * (hidden.T @ error)
            bias -= rate * error.sum(axis=0)
            table -= rate * (part.T @ back)
    effect = table.astype(float) @ (layer[:, 1] - layer[:, 0]).astype(float) * float(spread)
    return Model(how, effect, float(bias[1] - bias[0]))


def labelled_sample(docs: DataFrame, labels: DataFrame, how: Training, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, label, text) of at most `max_rows` rows of `labels` (id, label), those with the smallest hashes of their ids.

    The sample's size is bounded, so it is broadcast and no text is moved. Ids
    and labels that are null, and labels other than 0 and 1, are left out.
    """
    chosen = (
        labels.select(F.col(id).alias("labelled"), F.col("label").cast("int"))
        .where("labelled is not null and label in (0, 1)")
        .orderBy(F.xxhash64("labelled"), "labelled", "label")
        .limit(how.max_rows)
    )
    texts = docs.select(F.col(id).alias("doc"), F.col(text).alias("text"))
    found = texts.join(F.broadcast(chosen), F.col("doc") == F.col("labelled"))
    return found.select(F.col("doc").cast("string").alias("doc"), "label", "text").limit(how.max_rows)


def score(model: Model, docs: DataFrame, text: str = "text", out: str = "score") -> DataFrame:
    """`docs` with the probability of label 1 of each whole text; null and empty texts score the model's bias."""
    ship(docs.sparkSession)
    return docs.withColumn(out, arrow_udf(lambda column: pa.array(model.scores(column)), "double")(F.col(text)))
