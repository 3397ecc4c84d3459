"""SentencePiece models on the tokenizers library.

The model file's protobuf is read here, field by field, and the tokenizer built
anew from it: normaliser, the mark for spaces and the one put before a text,
scores (of a unigram model, or of a BPE model, whose merges follow from them)
and the bytes that stand for characters outside the vocabulary. Where no piece
reaches over the beginning of a word, a batch's different words are encoded once
each and put together; other models get whole texts. Decoding looks the pieces'
bytes up in a table.

`checked` has every text encoded by the reference library as well, to verify that
both give the same ids.
"""

from __future__ import annotations

import ctypes
import hashlib
import os
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import tee

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from sluice.llm.work import making_room, ship
from sluice.session import small_batches

SPACE = "▁"
# Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

BATCH_CHARS = 1 << 20
WORDS_BATCH_CHARS = 1 << 21  # where words are encoded once each
WORDS_AT_ONCE = 1 << 14
KNOWN_BYTES = 1 << 23  # beyond that, words and ids of the last batch alone are remembered


# --- the model file --------------------------------------------------------------------------


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; fixed-size values as their bytes."""
    at = 0
    while at < len(data):
        tag, at = varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(data, at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        elif kind == 2:
            size, at = varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {kind}")
        yield tag >> 3, value


@dataclass(frozen=True)
class Model:
    pieces: tuple[tuple[str, float, int], ...]  # text, score, kind
    kind: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    remove_extra_spaces: bool
    escape_spaces: bool

    @property
    def unknown(self) -> int:
        return next(i for i, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN)


def parse(data: bytes) -> Model:
    pieces, trainer, normalizer = [], {}, {}
    for number, value in message(data):
        if number == 1:
            found = dict(message(value))
            score = struct.unpack("<f", found[2])[0] if 2 in found else 0.0
            pieces.append((found[1].decode("utf-8"), score, found.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(message(value))
        elif number == 3:
            normalizer = dict(message(value))
    kind = trainer.get(3, UNIGRAM)
    if kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models can be rebuilt")
    if trainer.get(24, 0):
        raise ValueError("models that mark spaces behind a word are not supported")
    return Model(
        tuple(pieces),
        kind,
        bool(trainer.get(35, 0)),
        normalizer.get(2, b""),
        bool(normalizer.get(3, 1)),
        bool(normalizer.get(4, 1)),
        bool(normalizer.get(5, 1)),
    )


# --- encoding --------------------------------------------------------------------------------


def merges(model: Model) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, best score first: the order in which the model would join them."""
    usable = {text: i for i, (text, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED, UNUSED)}
    found = []
    for text, i in usable.items():
        for cut in range(1, len(text)):
            left, right = usable.get(text[:cut]), usable.get(text[cut:])
            if left is not None and right is not None:
                found.append((-model.pieces[i][1], i, left, right))
    found.sort()
    return [(model.pieces[left][0], model.pieces[right][0]) for _, _, left, right in found]


def by_words(model: Model) -> bool:
    """Whether no piece reaches over the beginning of a word, so that words can be encoded one by one."""
    return model.escape_spaces and not any(SPACE in text.lstrip(SPACE) for text, _, kind in model.pieces if kind == NORMAL)


def only_words(model: Model) -> bool:
    """Whether a text is its words as they stand: nothing else is rewritten or cut out before they are encoded."""
    kinds = {kind for _, _, kind in model.pieces}
    return by_words(model) and not model.charsmap and not model.remove_extra_spaces and USER_DEFINED not in kinds


def core(model: Model):
    """The model alone, for words with their spaces marked."""
    from tokenizers import models

    if model.kind == UNIGRAM:
        return models.Unigram([(t, s) for t, s, _ in model.pieces], model.unknown, model.byte_fallback)
    vocabulary = {text: i for i, (text, _, _) in enumerate(model.pieces)}
    return models.BPE(
        vocabulary, merges(model), unk_token=model.pieces[model.unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback
    )


def tokenizer(model: Model):
    from tokenizers import AddedToken, Regex, Tokenizer, normalizers, pre_tokenizers

    built = Tokenizer(core(model))
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra_spaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(SPACE if model.escape_spaces else " "))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", SPACE))
    if steps:
        built.normalizer = normalizers.Sequence(steps)
    if by_words(model):
        built.pre_tokenizer = pre_tokenizers.Split(Regex(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"), "isolated")
    given = [AddedToken(t, normalized=True, special=False) for t, _, kind in model.pieces if kind == USER_DEFINED]
    if given:
        built.add_tokens(given)
    return built


SLICE_ROWS = 256


def texts_of(column: pa.Array) -> Iterator[str]:
    """The texts of a column, null as the empty one, a few at a time: a column may hold many long ones."""
    for start in range(0, len(column), SLICE_ROWS):
        yield from column.slice(start, SLICE_ROWS).fill_null("").to_pylist()


def batches(texts: Iterable[str], chars: int = BATCH_CHARS) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def words(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The words of texts, each with the spaces before it, and where in them each text begins and the last one ends."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
    data = texts.buffers()[2] or pa.py_buffer(b"")
    space = np.frombuffer(data, np.uint8)[: ends[-1]] == ord(" ")
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[ends[:-1][ends[:-1] < ends[1:]]] = True
    at = np.flatnonzero(first)
    found = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, ends[-1])), data)
    return found, np.searchsorted(at, ends)


class Known:
    """Ids of words: those of a batch, and of former batches' words as long as they are few."""

    def __init__(self, core):
        self.core = core
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.list_(pa.int32()))

    def look_up(self, words: pa.LargeStringArray) -> pa.ListArray:
        """The ids of each word; a word that is not known yet is encoded once."""
        each = words.dictionary_encode()
        at = pc.index_in(each.dictionary, value_set=self.words)
        new = each.dictionary.filter(at.is_null())
        if len(new):
            parts = [self.encoded(new.slice(i, WORDS_AT_ONCE)) for i in range(0, len(new), WORDS_AT_ONCE)]
            self.words, self.ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, *parts])
            at = pc.replace_with_mask(at, at.is_null(), pa.array(np.arange(len(self.words) - len(new), len(self.words), dtype=np.int32)))
        ids = self.ids.take(at)
        if self.words.nbytes + self.ids.nbytes > KNOWN_BYTES:
            self.words, self.ids = each.dictionary, ids
        return ids.take(each.indices)

    def encoded(self, words: pa.LargeStringArray) -> pa.ListArray:
        marked = pc.replace_substring(words, " ", SPACE).to_pylist()
        return pa.array([[token.id for token in self.core.tokenize(word)] for word in marked], pa.list_(pa.int32()))


class Codec:
    """Encodes and decodes by one model; texts are taken in batches of one or two million characters."""

    def __init__(self, data: bytes, threads: int = 1):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        self.model, self.data = parse(data), data
        self.known = Known(core(self.model)) if only_words(self.model) else None
        self.tokenizer = None if self.known else tokenizer(self.model)
        self._reference = None
        texts = []
        for text, _, kind in self.model.pieces:
            if kind == BYTE:
                texts.append(bytes([int(text[3:5], 16)]))
            elif kind == CONTROL:
                texts.append(b"")
            elif kind == UNKNOWN:
                texts.append(" ⁇ ".encode())
            else:
                texts.append(text.replace(SPACE, " ").encode() if self.model.escape_spaces else text.encode())
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.begins = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        if self.known:
            for batch in batches(texts, WORDS_BATCH_CHARS):
                yield from self._by_words(batch)
            return
        run = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        for batch in batches(texts):
            yield from (np.array(x.ids, np.int32) for x in run(batch, add_special_tokens=False))

    def _by_words(self, batch: list[str]) -> Iterator[np.ndarray]:
        if self.model.dummy_prefix:
            batch = [" " + text if text else text for text in batch]
        found, begins = words(pc.replace_substring(pa.array(batch, pa.large_string()), SPACE, " "))  # the mark itself is a space
        ids = self.known.look_up(found)
        cuts, values = ids.offsets.to_numpy()[begins], ids.values.to_numpy()
        return (values[begin:end] for begin, end in zip(cuts[:-1], cuts[1:], strict=True))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the space that was put before it; bytes that make no character read as U+FFFD."""
        if not len(ids):
            return ""
        n = self.lengths[ids]
        first = np.cumsum(n) - n
        at = np.arange(int(n.sum())) + np.repeat(self.begins[ids] - first, n)
        text = self.bytes[at].tobytes().decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text

    def reference(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of each text by the reference library."""
        import sentencepiece

        if self._reference is None:
            self._reference = sentencepiece.SentencePieceProcessor(model_proto=self.data)
        for batch in batches(texts):
            yield from (np.array(ids, np.int32) for ids in self._reference.encode(batch, num_threads=1))


THREADS = 1  # a task has one core


@lru_cache(maxsize=2)
def codec(name: str) -> Codec:
    """The codec of a model file that was sent to the executors; built once in each worker, whatever it is used for."""
    with open(SparkFiles.get(name), "rb") as file:
        return Codec(file.read(), THREADS)


_sent: set[tuple[str, str]] = set()


def send(spark: SparkSession, path: str) -> str:
    """Send a model file to all executors; gives the name that they find it by. Batches of this session become small."""
    ship(spark)
    small_batches(spark)
    if (key := (spark.sparkContext.applicationId, path)) not in _sent:
        spark.sparkContext.addFile(path)
        _sent.add(key)
    return os.path.basename(path)


def lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int32), pa.int32()))


def released(array: pa.Array) -> pa.Array:
    """The array, with the memory that was freed on the way given back to the system: idle workers stay small."""
    pa.default_memory_pool().release_unused()
    if trim := c_library_trim():
        trim(0)
    return array


@lru_cache(maxsize=1)
def c_library_trim():
    """The C library's call for that, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return None


def encode(text: Column, name: str) -> Column:
    """Ids of a text as an array of int; null reads as the empty text, which has none."""

    def run(column: pa.Array) -> pa.Array:
        return released(lists(list(codec(name).encode(texts_of(column)))))

    return arrow_udf(run, "array<int>")(text)


def decode(ids: Column, name: str) -> Column:
    """The text of an array of ids; null reads as no ids."""

    def run(column: pa.Array) -> pa.Array:
        each = codec(name)
        return pa.array([each.decode(np.asarray(x.values.to_numpy() if x.is_valid else [], np.int64)) for x in column], pa.string())

    return arrow_udf(run, "string")(ids)


def encode_and_compare(text: Column, name: str) -> Column:
    """A struct of the ids of a text and `round_trip`: whether they decode to the text itself; null reads as the empty text."""
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_())])

    def run(column: pa.Array) -> pa.Array:
        each = codec(name)
        whole, read = tee(texts_of(column))  # holds the texts of one batch of the library
        ids, same = [], []
        for text, found in zip(whole, each.encode(read), strict=True):
            ids.append(found)
            same.append(each.decode(found) == text)
        return released(pa.StructArray.from_arrays([lists(ids).cast(kind[0].type), pa.array(same, pa.bool_())], fields=list(kind)))

    return arrow_udf(run, "struct<ids:array<int>,round_trip:boolean>")(text)


def checked(docs: DataFrame, name: str, text: str = "text", out: str = "tokens") -> DataFrame:
    """`docs` with a struct column `out`: n_tokens, ids_sha256, decoded_sha256, round_trip, parity.

    ids_sha256 is of the ids as 32-bit little-endian numbers, decoded_sha256 of
    the decoded text, and round_trip tells whether that is the text itself.
    Every text is encoded by the reference library too: parity tells whether it
    gives the same ids. A column of `docs` named as `out` is kept with `_` behind its name.
    """
    ship(docs.sparkSession)
    docs = making_room(docs, out)
    kind = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("round_trip", pa.bool_()), ("parity", pa.bool_())])

    def run(column: pa.Array) -> pa.Array:
        each = codec(name)
        texts, one, other = tee(texts_of(column), 3)
        parts: list[list] = [[] for _ in kind]
        for whole, ids, theirs in zip(texts, each.encode(one), each.reference(other), strict=True):
            back = each.decode(ids)
            row = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), back == whole, np.array_equal(ids, theirs))
            for part, value in zip(parts, row, strict=True):
                part.append(value)
        return released(pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(parts, kind, strict=True)], fields=list(kind)))

    schema = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string,round_trip:boolean,parity:boolean>"
    return docs.withColumn(out, arrow_udf(run, schema)(F.col(text)))
